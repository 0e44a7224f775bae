"""Entity tables on Spark.

Entities (id, props, refs, deleted/recorded flags) are read from tables through
configurable mappings, loaded into append-only log tables and newest-version
("latest") tables, and replaced wholesale by multi-batch full syncs.  All data
work is expressed as DataFrame / SQL / Structured Streaming operators.
"""

from entitylake.lake import Lake
from entitylake.model import (
    Construction,
    DatasetDefinition,
    IncomingMapping,
    IncomingPropertyMapping,
    OutgoingMapping,
    OutgoingPropertyMapping,
    SourceConfig,
    load_definitions,
)

__all__ = [
    "Construction",
    "DatasetDefinition",
    "IncomingMapping",
    "IncomingPropertyMapping",
    "Lake",
    "OutgoingMapping",
    "OutgoingPropertyMapping",
    "SourceConfig",
    "load_definitions",
]
