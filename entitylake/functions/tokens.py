"""Continuation tokens: URL-safe base64 of a literal.

The literal is the since column's high-water mark rendered as text: integers
bare (``165565655567``), anything else single-quoted (``'2024-09-01T11:00:00'``).
Timestamps are rendered RFC 3339 with microseconds; an offset is only written
for zone-aware timestamps.  Encoding runs as a column expression next to the
MAX aggregate; decoding is done once on the driver for the request parameter
and turned into a typed literal, never pasted into SQL text.
"""

from __future__ import annotations

import base64
import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT64 = re.compile(r"^[+-]?[0-9]+$")


def _quote_unless_int(text: Column) -> Column:
    is_int = text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("bigint").isNotNull()
    return F.when(is_int, text).otherwise(F.concat(F.lit("'"), text, F.lit("'")))


def token_literal(c: Column, dtype: T.DataType) -> Column:
    """Literal text of a since value: bare if it parses as int64, else quoted."""
    return _quote_unless_int(value_text(c, dtype))


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a since value, of which ``token_literal`` (``literal_for`` on the driver) makes the literal."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")


def encode_column(text: Column) -> Column:
    """URL-safe base64 (with padding) of a string column."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "+/", "-_")


def token_column(c: Column, dtype: T.DataType) -> Column:
    return encode_column(token_literal(c, dtype))


def encode_token(text: str) -> str:
    return base64.urlsafe_b64encode(text.encode("utf-8")).decode("ascii")


def literal_for(value: object) -> str:
    """Driver-side twin of :func:`token_literal` for an already-rendered value."""
    text = str(value)
    if _INT64.match(text):
        try:
            if -(2**63) <= int(text) < 2**63:
                return text
        except ValueError:
            pass
    return f"'{text}'"


def literal_text(raw: str) -> str:
    """Value text of a literal: bare, or without its quotes."""
    return raw[1:-1] if len(raw) >= 2 and raw[0] == "'" and raw[-1] == "'" else raw


def decode_token(token: str) -> str | None:
    """Token -> literal value text (quotes stripped); ``""`` -> None.  Bad token = error."""
    if not token:
        return None
    try:
        raw = base64.urlsafe_b64decode(token.encode("ascii")).decode("utf-8")
    except Exception as exc:  # noqa: BLE001 - re-raised with context
        raise ValueError(f"failed to decode since token {token!r}") from exc
    if literal_text(raw) != raw:
        return literal_text(raw)
    if not _INT64.match(raw):
        raise ValueError(f"since token {token!r} holds neither an integer nor a quoted literal")
    return raw


def typed_literal(text: str, dtype: T.DataType) -> Column:
    """The decoded token as a literal of the since column's type."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)) and text.endswith("Z"):
        text = text[:-1] + "+00:00" if isinstance(dtype, T.TimestampType) else text[:-1]
    return F.lit(text).cast(dtype)


#: Types whose literals can be compared here as their values compare in Spark.
RANGED_TYPES = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


def ordered_value(text: str, dtype: T.DataType):
    """The value of a literal's text for comparisons on the driver; None where that is not certain."""
    try:
        if isinstance(dtype, T.IntegralType):
            return int(text)
        if isinstance(dtype, T.DateType):
            return date.fromisoformat(text)
        value = datetime.fromisoformat(text)
    except ValueError:
        return None
    if isinstance(dtype, T.TimestampType):
        return value if value.tzinfo else None
    return value if isinstance(dtype, T.TimestampNTZType) and not value.tzinfo else None
