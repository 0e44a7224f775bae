"""URI helpers: templates (P5), base-URI prefixing, namespace expansion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_PLACEHOLDER = "{value}"  # fixed value: template placeholder


def is_absolute(name: str) -> bool:
    return "://" in name


def property_uri(base_uri: str, name: str) -> str:
    """``base_uri + name`` unless ``name`` already is an absolute URI."""
    return name if is_absolute(name) else f"{base_uri}{name}"


def fill_template(pattern: str, value: Column) -> Column:
    """Substitute ``{value}`` in a URI pattern with the column's text."""
    return F.replace(F.lit(pattern), F.lit(VALUE_PLACEHOLDER), value.cast("string"))


def expand(c: Column, namespaces: Column) -> Column:
    """``prefix:rest`` -> ``namespaces[prefix] + rest``; unknown prefix -> unchanged."""
    pos = F.instr(c, ":")
    prefix = F.substring_index(c, ":", 1)
    base = F.try_element_at(namespaces, prefix)
    rest = c.substr(pos + 1, F.lit(1 << 30))
    return F.when((pos > 0) & base.isNotNull(), F.concat(base, rest)).otherwise(c)
