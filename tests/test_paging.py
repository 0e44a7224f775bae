"""Paging with limits returns every row exactly once, ties included."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from entitylake.plans.read import page_bound, since_window
from tests.conftest import SF


def _page_all(df, col, n):
    token, seen, pages = "", Counter(), 0
    while True:
        w = since_window(df, col, token, n)
        if w.token == token:
            assert w.rows.count() == 0
            return seen, pages
        rows = w.rows.collect()
        assert rows, "a new token must come with rows"
        seen.update(r.o_orderkey for r in rows)
        token, pages = w.token, pages + 1


def test_pages_cover_every_row_once_with_ties(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    n_dates = orders.select("o_orderdate").distinct().count()
    assert n_dates < orders.count()  # the since column has ties
    seen, pages = _page_all(orders, "o_orderdate", 200)
    assert len(seen) == orders.count() and set(seen.values()) == {1}
    assert pages > 5


def test_page_bound_keeps_ties_together(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 2), (5, 3)], "o_orderkey int, s int")
    w = since_window(df, "s", "", 2)
    assert sorted(r.o_orderkey for r in w.rows.collect()) == [1, 2, 3, 4]


def test_null_since_values_are_never_returned(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "o_orderkey int, s int")
    seen, _ = _page_all(df, "s", 1)
    assert set(seen) == {1}
    assert since_window(df, "s").rows.where(F.col("s").isNull()).count() == 0



def _plain_bound(spark, df, col, n):
    values = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).collect())
    return values[min(n, len(values)) - 1]


def test_page_bound_is_the_nth_smallest_value(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("tie", F.col("user_id") % 3)
    for col in ("ts", "event_id", "value", "event_type", "tie"):
        for n in (1, 7, 500, 10**9):
            assert page_bound(ev, col, n).first()[0] == _plain_bound(spark, ev, col, n), (col, n)


def test_all_pages_cover_the_feed_in_order(spark):
    from entitylake.model import DatasetDefinition, OutgoingMapping, OutgoingPropertyMapping, SourceConfig
    from entitylake.functions.tokens import decode_token
    from entitylake.plans.read import all_pages

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    out = OutgoingMapping(property_mappings=(OutgoingPropertyMapping("o_orderkey", is_identity=True), OutgoingPropertyMapping("o_orderdate", "d", "string")))
    ds = DatasetDefinition("o", SourceConfig(since_column="O_OrderDate"), outgoing=out)
    rows = all_pages(orders, ds, 200).select("id", "page", "token", F.variant_get("props", "$.d", "string").alias("d")).collect()
    assert Counter(r.id for r in rows) == Counter(str(r.o_orderkey) for r in orders.collect())
    by_page = {}
    for r in rows:
        by_page.setdefault(r.page, []).append(r)
    bounds = [(min(r.d for r in p), max(r.d for r in p), {r.token for r in p}) for _, p in sorted(by_page.items())]
    assert all(len(t) == 1 for _, _, t in bounds) and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    second = all_pages(orders, ds, 200, next(iter(bounds[0][2])))  # from the first page's token on
    assert second.count() == len(rows) - len(by_page[0]) and decode_token(next(iter(bounds[0][2])))


def test_since_column_in_another_case(spark):
    df = spark.createDataFrame([(1,), (2,)], "recorded bigint")
    assert since_window(df, "RECORDED").token == since_window(df, "recorded").token
    both = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing"):
        since_window(both, "c")


def test_since_bound_in_a_repeated_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        # 00:30 and 01:30 UTC are both 02:30 local time on that day
        df = spark.createDataFrame([(1729989000,), (1729992600,)], "s bigint").select("s", F.timestamp_seconds("s").alias("t"))
        first = since_window(df, "t")
        assert first.rows.count() == 2
        paged = since_window(df, "t", limit=1)
        assert [r.s for r in paged.rows.collect()] == [1729989000]
        assert [r.s for r in since_window(df, "t", paged.token).rows.collect()] == [1729992600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_limited_read_without_since_column_ignores_the_token(spark):
    from entitylake.model import DatasetDefinition
    from entitylake.plans.read import read_entities

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    page = read_entities(orders, DatasetDefinition("orders"), token="MTIz", limit=3)
    assert page.token == "" and page.entities.count() == 3


def test_a_page_shuffles_its_own_rows_only(spark):
    """The sketch's bound reaches the scan, and what is counted exactly follows the page."""
    from entitylake.plans import read

    n, total = 50, 200_000
    values = F.col("id") * 7919 % total
    types = {"bigint": values, "int": values.cast("int"), "double": values / 3, "decimal(20,2)": values, "string": F.lpad(values.cast("string"), 9, "0"),
             "date": F.date_from_unix_date((values / 10).cast("int")), "timestamp": F.timestamp_micros(values), "timestamp_ntz": F.timestamp_micros(values)}
    wide = spark.range(total).select(*[v.cast(t).alias(f"c{i}") for i, (t, v) in enumerate(types.items())])
    from entitylake.session import scratch_dir

    path = scratch_dir(spark, "page-test")
    wide.write.parquet(path)
    df = spark.read.parquet(path)
    for i, t in enumerate(types):
        kept = read.narrowed(df, f"c{i}", n)
        assert n <= kept.count() <= 40 * n, t
        pushed = kept._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [", 1)[1].split("]")[0]
        assert ("LessThanOrEqual" in pushed) == (t not in ("string", "decimal(20,2)")), (t, pushed)
    tied = spark.range(5_000).select(F.lit(7).alias("s"))
    assert read.narrowed(tied, "s", 3).count() == 5_000 and page_bound(tied, "s", 3).first()[0] == 7
    assert read.narrowed(df.where("c0 < 0"), "c0", 3).count() == 0 and page_bound(df.where("c0 < 0"), "c0", 3).first()[0] is None
    hidden = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).when(F.col("id") % 3 == 1, float("nan")).alias("s"))
    assert page_bound(hidden, "s", 10).first()[0] == 27.0 and str(page_bound(hidden, "s", 10**6).first()[0]) == "nan"
    skewed = spark.range(20_000).select(F.when(F.col("id") < 15_000, 5).otherwise(F.col("id")).alias("s"))
    assert page_bound(skewed, "s", 1).first()[0] == 5 and page_bound(skewed, "s", 15_001).first()[0] == 15_000


def test_a_limited_read_leaves_no_folder_behind(spark):
    import os

    from entitylake.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert since_window(orders, "o_orderdate", "", 100).rows.count() >= 100
    assert set(os.listdir(root)) == before


def test_bounds_come_from_footers_and_manifests(spark, tmp):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    from entitylake.functions.tokens import decode_token, encode_token
    from entitylake.lake import Lake
    from entitylake.model import DatasetDefinition, SourceConfig

    lake = Lake(spark, tmp + "/lake")
    days = [datetime.date(2024, 1, d) for d in (3, 1, 2)]
    for name, stats in (("with", True), ("without", False)):
        pq.write_table(pa.table({"k": [5, 9, 7], "d": days, "x": [1.0, float("nan"), 2.0]}), f"{tmp}/{name}.parquet", write_statistics=stats)
        for column, after, rows, literal in (("k", "5", 2, "9"), ("K", "9", 0, None), ("d", "2024-01-01", 2, "2024-01-03"), ("x", "1.5", 2, "NaN")):
            ds = lake.define(DatasetDefinition("f", SourceConfig(path=f"{tmp}/{name}.parquet", since_column=column)))
            newest = lake.newest_of(ds, lake.table(ds))
            pushed = "" if newest is None else newest._jdf.queryExecution().executedPlan().toString()
            assert ("PushedAggregation: [MAX(" in pushed) == (column != "x")
            token = encode_token(after if column in "kK" else f"'{after}'")
            page = lake.entities("f", since=token)
            assert page.entities.count() == rows and (decode_token(page.token) == literal if literal else page.token == token), (name, column)
