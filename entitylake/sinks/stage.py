"""Stage writer (K1): entities -> gzipped NDJSON files of at most 50,000 lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from entitylake.model import ENTITIES_PER_FILE
from entitylake.operators.outgoing import entity_json


def write_stage(
    entities: DataFrame,
    path: str,
    order_by: tuple[str, ...] | list[str] | None = None,
    per_file: int = ENTITIES_PER_FILE,
    compression: str = "gzip",
) -> None:
    """Write one batch.  Overwrites ``path`` so a retried batch is idempotent.

    ``order_by`` names arrival columns: the batch is then range-partitioned and
    sorted on them so part-file order plus line order is the arrival order.
    """
    df = entities
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    (
        df.select(entity_json(df).alias("value"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", per_file)
        .option("compression", compression)
        .text(path)
    )
