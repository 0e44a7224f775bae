"""Windowed incremental reads (I1-I3) built from A1/A2, F1/F2 and L1.

One small action computes the window bound (a MAX: from Parquet footers or a
log's manifest where they have it, else partial + final aggregate) together
with the next token; the rows themselves stay a lazy
DataFrame whose ``since`` filters are pushed into the Parquet scan.  A bound
travels as the token's literal, which keeps the type's full precision and, for
zone-aware timestamps, the offset.
"""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.tokens import decode_token, literal_text, token_column, token_literal, typed_literal
from entitylake.model import DatasetDefinition
from entitylake.session import scratch_dir
from entitylake.sinks import fs
from entitylake.sources.tables import to_entities


@dataclass
class SinceWindow:
    rows: DataFrame  # source rows inside (since, bound]
    token: str  # continuation token for the next request


@dataclass
class EntityPage:
    entities: DataFrame
    token: str
    rejects: DataFrame | None = None


def resolve_column(rows: DataFrame, name: str) -> T.StructField:
    """The column a since name means: the exact name, else the one that differs in case only, as Spark resolves."""
    fields = rows.schema.fields
    found = [f for f in fields if f.name == name] or [f for f in fields if f.name.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"since column {name!r} is {'ambiguous' if found else 'missing'} in {rows.columns}")
    return found[0]


def footer_rows(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """Rows of Parquet files through the reader that answers a MAX from their footers; None for types that have none there.

    Integers and dates only: text statistics may be cut short, those of floats leave out NaN, and
    timestamps are not pushed.  The reader is chosen by settings, so it gets a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = own.read.parquet(path)
    return rows if isinstance(resolve_column(rows, column).dataType, (T.IntegralType, T.DateType)) else None


def newest_value(rows: DataFrame, column: str) -> DataFrame:
    """A1: one row ``_m``, the column's MAX (NULL: none)."""
    return rows.agg(F.max(F.col(f"`{resolve_column(rows, column).name}`")).alias("_m"))


def _after(newest: DataFrame, after: str | None, dtype: T.DataType) -> DataFrame:
    """A2 from A1: the largest value after the token is the largest value, if that is after it."""
    return newest if after is None else newest.select(F.when(F.col("_m") > typed_literal(after, dtype), F.col("_m")).alias("_m"))


def high_water_mark(rows: DataFrame, column: str, after: str | None = None, newest: DataFrame | None = None) -> DataFrame:
    """A1 / A2 (+X4-X6): one row ``(max_value text, token)``; empty -> NULLs.

    ``newest`` is the column's MAX where it is known without a scan (``footer_rows``, a log's manifest).
    """
    field = resolve_column(rows, column)
    col, dtype = F.col(f"`{field.name}`"), field.dataType
    if newest is not None:
        bound = _after(newest, after, dtype)
    else:
        bound = newest_value(rows if after is None else rows.where(col > typed_literal(after, dtype)), column)
    return bound.select(
        F.col("_m").cast("string").alias("max_value"),
        token_literal(F.col("_m"), dtype).alias("literal"),
        token_column(F.col("_m"), dtype).alias("token"),
    )


def since_window(rows: DataFrame, column: str, token: str = "", limit: int = 0, newest: DataFrame | None = None) -> SinceWindow:
    """I1 / I2 with L1: rows in ``(token, bound]`` and the next token.

    Without a limit the bound is the window's MAX, from ``newest`` if that is
    given and can be had.  With a limit the bound is the smallest since value up
    to which there are at least ``limit`` rows; every row up to the bound is
    returned, so ties stay on one page and the next page starts right after them.
    """
    field = resolve_column(rows, column)
    col, dtype = F.col(f"`{field.name}`"), field.dataType
    after = decode_token(token)
    lower = rows if after is None else rows.where(col > typed_literal(after, dtype))
    row = None
    if limit and limit > 0:
        row = _bound_row(page_bound(lower, column, limit), dtype)
    elif newest is not None:
        with suppress(PySparkException, Py4JJavaError):  # files without statistics: scan
            row = _bound_row(_after(newest, after, dtype), dtype)
    row = row or _bound_row(newest_value(lower, column), dtype)
    if row["m"] is None:  # I2: nothing new -> same token, no rows (D4: "" stays "")
        return SinceWindow(rows.where(F.lit(False)), token)
    return SinceWindow(lower.where(col <= typed_literal(literal_text(row["m"]), dtype)), row["t"])


def _bound_row(bound: DataFrame, dtype: T.DataType) -> Row:
    return bound.select(token_literal(F.col("_m"), dtype).alias("m"), token_column(F.col("_m"), dtype).alias("t")).first()


#: Size of the quantile sketches (a few KB each) and the error of rank they are taken to have; the sketch's own is half of it.
SKETCH_K, RANK_ERROR = 800, 0.007
#: Ranks at which a bound is read off a sketch.
RANKS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.4)


def _ordered_code(col: Column, dtype: T.DataType) -> tuple[Column, str] | None:
    """A number that never falls as the value rises, and its kind; None for types without one."""
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint"), "bigint"
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint"), "bigint"
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col), "bigint"
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, col), "bigint"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return col.cast("double"), "double"
    if isinstance(dtype, T.StringType):  # the first seven bytes as a number
        head = F.rpad(F.substring(F.hex(F.substring(col, 1, 7)), 1, 14), 14, "0")
        return F.conv(head, 16, 10).cast("bigint"), "bigint"
    return None


def _up_to(col: Column, dtype: T.DataType, code: Column, bound) -> Column:
    """``code <= bound`` on the column itself where the code has an inverse, so that it reaches the scan."""
    at = F.lit(bound)
    if isinstance(dtype, T.IntegralType):
        return col <= at.cast(dtype)
    if isinstance(dtype, T.DateType):
        return col <= F.date_from_unix_date(at.cast("int"))
    if isinstance(dtype, T.TimestampType):
        return col <= F.timestamp_micros(at)
    if isinstance(dtype, T.TimestampNTZType):
        return col <= F.timestamp_add("MICROSECOND", at, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col <= at.cast(dtype)
    return code <= at


def narrowed(rows: DataFrame, column: str, n: int) -> DataFrame:
    """The rows up to some since value with at least ``n`` rows up to it, few more than ``n`` of them if values differ.

    A quantile sketch of the since column (one of a few KB from each task) gives an upper bound, which goes
    down to the scan; the next sketch sees only the rows below it.  Each round leaves some hundredth of
    the rows, so a page of n among N rows takes about log(N / n) / log(100) + 1 rounds.  Every bound is
    checked by the count of the next round; one that cuts too deep is given up.
    """
    field = resolve_column(rows, column)
    col = F.col(f"`{field.name}`")
    coded = _ordered_code(col, field.dataType)
    if coded is None:
        return rows
    code, kind = coded
    agg, quantile = getattr(F, f"kll_sketch_agg_{kind}"), getattr(F, f"kll_sketch_get_quantile_{kind}")
    ranks = F.array(*[F.lit(r) for r in RANKS])
    kept, before = rows, None
    while True:
        sketched = rows.where(col.isNotNull()).agg(F.count(code).alias("m"), agg(code, F.lit(SKETCH_K)).alias("s"))
        m, bounds = sketched.select("m", F.when(F.col("m") > 0, quantile("s", ranks)).alias("b")).first()
        if m < n and before is not None:
            return kept
        kept = rows
        bound = next((b for r, b in zip(RANKS, bounds or ()) if (r - RANK_ERROR) * m >= n), None)
        if bound is None or m == before:  # near enough, or ties that no bound parts
            return kept
        rows, before = kept.where(_up_to(col, field.dataType, code, bound)), m


def value_ranks(rows: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Distinct non-null since values ``_v`` with ``_before``, the number of rows with a smaller value.

    Rows are counted per value with partial aggregation, the values are range
    partitioned and written once (to ``where``); running sums are taken inside each range and
    shifted by the totals of the ranges before it (one row per range).  No task
    sees more than its range, however many rows, values or ties there are.
    """
    field = resolve_column(rows, column)
    col = F.col(f"`{field.name}`")
    counts = rows.where(col.isNotNull()).groupBy(col.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    where = where or scratch_dir(rows.sparkSession, "ranks")
    fs.delete_on_exit(rows.sparkSession, where)
    counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()).write.parquet(where)
    ranged = rows.sparkSession.read.parquet(where)
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    totals = ranged.groupBy("_p").agg(F.sum("_c").alias("_t")).select("_p", F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_l", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    return local.join(totals, "_p").select("_v", (F.col("_l") + F.col("_o")).alias("_before"))


def page_bound(lower: DataFrame, column: str, n: int) -> DataFrame:
    """One row ``_m``: the smallest since value up to which there are ``n`` rows, else the largest (NULL: none).

    Exact counts are taken only of the narrowed rows; they are gone when this returns.
    """
    spark, dtype = lower.sparkSession, resolve_column(lower, column).dataType
    where = scratch_dir(spark, "ranks")
    ranks = value_ranks(narrowed(lower, column, n), column, where)
    row = ranks.where(F.col("_before") < n).agg(F.max("_v").alias("_m")).select(token_literal(F.col("_m"), dtype).alias("m")).first()
    fs.delete(spark, where)
    bound = F.lit(None).cast(dtype) if row["m"] is None else typed_literal(literal_text(row["m"]), dtype)
    return spark.range(1).select(bound.alias("_m"))


def read_entities(
    rows: DataFrame,
    ds: DatasetDefinition,
    token: str = "",
    limit: int = 0,
    newest: DataFrame | None = None,
    keep: tuple[str, ...] = (),
) -> EntityPage:
    """The ``entities`` request: window (if a since column is set), limit, map; ``keep`` columns stay beside the entity."""
    since = ds.source.since_column
    if since:
        win = since_window(rows, since, token, limit, newest)
        window_rows, next_token = win.rows, win.token
    else:  # token ignored, "" returned
        window_rows = rows.limit(limit) if limit and limit > 0 else rows
        next_token = ""
    entities, rejects = to_entities(window_rows, ds, keep=keep)
    return EntityPage(entities, next_token, rejects)


def changes(
    rows: DataFrame,
    ds: DatasetDefinition,
    token: str = "",
    limit: int = 0,
    latest_only: bool = False,
    newest: DataFrame | None = None,
) -> EntityPage:
    """The changes feed is the windowed read; ``latest_only`` is accepted and ignored.

    Deletions are not events of a table read: they arrive through a full sync.
    """
    del latest_only
    return read_entities(rows, ds, token, limit, newest)


def all_pages(rows: DataFrame, ds: DatasetDefinition, page_rows: int, token: str = "") -> DataFrame:
    """I3 + L1 for a whole feed: the entities of every page after ``token``, with ``page`` and the page's ``token``.

    The same result as following the tokens page by page, up to where pages are
    cut: page k starts at the first since value with at least ``k * page_rows``
    rows before it.  One pass ranks the since values, so the number of jobs
    does not grow with the number of pages.
    """
    field = resolve_column(rows, ds.source.since_column)
    col, dtype = F.col(f"`{field.name}`"), field.dataType
    after = decode_token(token)
    lower = rows if after is None else rows.where(col > typed_literal(after, dtype))
    ranks = value_ranks(lower, field.name).withColumn("_page", F.floor(F.col("_before") / page_rows).cast("bigint"))
    last = ranks.groupBy("_page").agg(F.max("_v").alias("_m")).withColumn("_token", token_column(F.col("_m"), dtype)).drop("_m")
    paged = lower.join(ranks.select("_v", "_page"), col == F.col("_v")).drop("_v").join(last, "_page")
    entities, _ = to_entities(paged, ds, keep=("_page", "_token"))
    return entities.withColumnsRenamed({"_page": "page", "_token": "token"})
