"""Log rows, replays, latest upserts with NULL ids and NULL recorded, commits and compaction."""

import json

from pyspark.sql import functions as F

from entitylake.lake import Lake
from entitylake.model import DatasetDefinition, IncomingMapping, IncomingPropertyMapping, SourceConfig
from entitylake.sources.entity_files import payload_entities
from tests.test_files import BATCH, expanded, write_batch

LIB = "urn:library:"
MAPPED = IncomingMapping(
    property_mappings=(
        IncomingPropertyMapping("title", LIB + "title", "varchar(80)"),
        IncomingPropertyMapping("pages", LIB + "pages", "integer"),
        IncomingPropertyMapping("price", LIB + "price", "number(8,2)"),
        IncomingPropertyMapping("tags", LIB + "tags", "variant"),
        IncomingPropertyMapping("authors", LIB + "by", "string", is_reference=True),
        IncomingPropertyMapping("gone", is_deleted=True),
        IncomingPropertyMapping("own", is_recorded=True),
    )
)


def _batch(spark, tmp):
    return payload_entities(spark, [write_batch(tmp, lead="\n")])


def test_unmapped_log(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    lake.write_incremental("night.books", _batch(spark, tmp), 42, "b1", ("_file", "_pos"))
    rows = lake.log("night.books").collect()
    assert {r.id for r in rows} == {expanded(e["id"]) if "id" in e else None for e in BATCH[1:]}
    assert {r.recorded for r in rows} == {42} and {r.dataset for r in rows} == {"DB.PUBLIC.night.books"}
    assert {r.id for r in rows if r.deleted} == {LIB + "book/8"}
    assert lake.log("night.books").columns == ["id", "recorded", "deleted", "dataset", "entity"]


def test_mapped_log_and_replay(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("books", incoming=MAPPED))
    for _ in range(2):  # the second is a replay
        lake.write_incremental("books", _batch(spark, tmp), 7, "b1", ("_file", "_pos"))
    rows = {r.id: r for r in lake.log("books").collect()}
    assert len(rows) == len(BATCH) - 1 and lake.state("books").version == 1
    r7, r8, r9 = (rows[f"{LIB}book/{k}"] for k in (7, 8, 9))
    assert (r7.title, r7.pages, r7.price, r7.gone, r7.own) == ("Dune: part one", 612, None, None, None)
    assert (r8.gone, r8.deleted, str(r8.price)) == (True, True, "9.50")
    assert json.loads(r8.tags.toJson()) == BATCH[2]["props"]["lib:tags"]
    assert json.loads(r9.authors) == [expanded(x) for x in BATCH[3]["refs"]["lib:by"]] and r9.own == BATCH[3]["recorded"]


def _ents(spark, rows):
    df = spark.createDataFrame(rows, "id string, recorded bigint, v string, pos bigint")
    return df.select(
        "id",
        "recorded",
        F.lit(False).alias("deleted"),
        F.parse_json(F.lit("{}")).alias("refs"),
        F.to_variant_object(F.create_map(F.lit("v"), F.col("v").cast("variant"))).alias("props"),
        F.col("pos").alias("_arrival"),
    )


MAP_V = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "v", "string"),))


def test_latest_newest_wins_nulls_first_and_null_ids(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    b1 = [("a", 5, "a5", 1), ("a", 9, "a9", 2), ("a", 7, "a7", 3), ("b", 1, "b1", 4), ("b", None, "bnull", 5),
          ("b", None, "bnull2", 6), ("c", 3, "c3", 7), (None, 1, "n1", 8), (None, 2, "n2", 9)]
    lake.write_incremental("t", _ents(spark, b1), 100, "b1", ("_arrival",))
    got = {(r.id, r.v, r.recorded) for r in lake.latest("t").collect()}
    # NULL recorded counts as newest; among equals the later arrival wins; NULL ids form one group
    assert got == {("a", "a9", 100), ("b", "bnull2", 100), ("c", "c3", 100), (None, "n2", 100)}
    b2 = [("a", 1, "a-old-but-later", 1), ("d", 1, "d1", 2), (None, 5, "n5", 3)]
    lake.write_incremental("t", _ents(spark, b2), 200, "b2", ("_arrival",))
    got = {(r.id, r.v, r.recorded) for r in lake.latest("t").collect()}
    # replaced unconditionally; NULL ids never match, so they are inserted again
    assert got == {("a", "a-old-but-later", 200), ("b", "bnull2", 100), ("c", "c3", 100), ("d", "d1", 200),
                   (None, "n2", 100), (None, "n5", 200)}
    assert lake.log("t").count() == 12


def test_empty_batch_loads_nothing(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    st = lake.write_incremental("t", _ents(spark, []), 1, "empty")
    assert st.version == 0 and lake.state("t") is None


def test_schema_is_never_altered(spark, tmp):
    import pytest

    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "x", 1)]), 1, "b1")
    lake.define(DatasetDefinition("t", incoming=MAPPED))
    with pytest.raises(ValueError):
        lake.write_incremental("t", _batch(spark, tmp), 2, "b2")


def test_required_and_bad_cast_fail(spark, tmp):
    import pytest

    lake = Lake(spark, tmp + "/lake")
    req = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "missing", "string", required=True),))
    lake.define(DatasetDefinition("r", incoming=req))
    with pytest.raises(Exception):
        lake.write_incremental("r", _ents(spark, [("a", 1, "x", 1)]), 1, "b1")
    bad = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "v", "integer"),))
    lake.define(DatasetDefinition("c", incoming=bad))
    with pytest.raises(Exception):
        lake.write_incremental("c", _ents(spark, [("a", 1, "not-a-number", 1)]), 1, "b1")


import pytest  # noqa: E402


@pytest.mark.parametrize("mode", ["compact-each-batch", "compact-shuffle", "deltas-only", "explicit-compact"])
def test_merge_on_read_equals_copy_on_write(spark, tmp, mode):
    max_rows = 1 if mode == "compact-each-batch" else 10**9
    # a zero byte bound: nothing is broadcast, every commit compacts through the shuffle merge
    max_bytes = 0 if mode == "compact-shuffle" else None
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4, delta_rows_max=max_rows, broadcast_bytes_max=max_bytes)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    b1 = [("a", 5, "a5", 1), ("b", None, "b0", 2), (None, 1, "n1", 3), ("c", 1, "c1", 4)]
    b2 = [("a", 1, "a-late", 1), (None, 2, "n2", 2), ("d", 1, "d1", 3)]
    b3 = [("c", 9, "c9", 1), ("a", 2, "a-last", 2)]
    for i, b in enumerate((b1, b2, b3)):
        lake.write_incremental("t", _ents(spark, b), 100 + i, f"b{i}", ("_arrival",))
    st = lake.state("t")
    assert (len(st.deltas) == 0) == mode.startswith("compact-")
    if mode == "explicit-compact":
        lake.compact("t")
        assert lake.state("t").deltas == [] and lake.state("t").latest_paths
    got = sorted(((r.id or ""), r.v, r.recorded) for r in lake.latest("t").collect())
    assert got == sorted([("a", "a-last", 102), ("b", "b0", 100), ("c", "c9", 102), ("d", "d1", 101),
                          ("", "n1", 100), ("", "n2", 101)])


def test_log_compaction_keeps_rows_and_replay_keys(spark, tmp):
    lake = Lake(spark, tmp + "/lake", log_compact_batches=3)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    for i in range(7):
        lake.write_incremental("t", _ents(spark, [(f"id{i}", i, f"v{i}", 1)]), 10 + i, f"b{i}")
    st = lake.state("t")
    assert [b["level"] for b in st.log] == [1, 1, 0]
    lake.write_incremental("t", _ents(spark, [("dup", 1, "x", 1)]), 99, "b1")  # compacted key: replay no-op
    rows = sorted((r.id, r.recorded) for r in lake.log("t").collect())
    assert rows == [(f"id{i}", 10 + i) for i in range(7)]


def test_concurrent_commit_is_retried_on_the_newer_state(spark, tmp):
    a = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    b = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    for lake in (a, b):
        lake.define(DatasetDefinition("t", incoming=MAP_V))
    a.write_incremental("t", _ents(spark, [("x", 1, "x0", 1)]), 1, "b0")
    real_commit = a.store.commit
    raced = []

    def racing_commit(loc, state):
        if not raced:  # another writer commits the same version first
            raced.append(True)
            b.write_incremental("t", _ents(spark, [("y", 1, "y-from-b", 1)]), 2, "from-b")
        return real_commit(loc, state)

    a.store.commit = racing_commit
    a.write_incremental("t", _ents(spark, [("x", 2, "x-from-a", 1)]), 3, "from-a")
    assert raced and {"b0", "from-a", "from-b"} <= a.state("t").keys()
    assert sorted((r.id, r.v) for r in a.latest("t").collect()) == [("x", "x-from-a"), ("y", "y-from-b")]
    assert a.log("t").count() == 3


def test_delta_sizes_recorded_and_fold_never_shuffles_the_base(spark, tmp):
    from entitylake.operators.upsert import fold_deltas

    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "a1", 1), ("a", 2, "a2", 2), ("bb", 1, "b", 3)]), 1, "b1")
    (d,) = lake.state("t").deltas
    assert (d["rows"], d["id_bytes"]) == (2, 3)
    assert lake.store.can_broadcast(lake.state("t"))
    base = spark.createDataFrame([("a", "old"), ("z", "z")], "id string, v string")
    deltas = spark.createDataFrame([("a", "new", 1)], "id string, v string, _seq int")
    plan = fold_deltas(base, deltas, 4, True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the delta rows only
    got = sorted((r.id, r.v) for r in fold_deltas(base, deltas, 4, True).collect())
    assert got == [("a", "new"), ("z", "z")]


def test_since_read_of_a_log_prunes_older_batches_through_the_manifest(spark, tmp):
    from entitylake.functions.tokens import encode_token

    lake = Lake(spark, tmp + "/lake", log_compact_batches=3)
    lake.define(DatasetDefinition("t"))
    feed = DatasetDefinition("feed", SourceConfig(table_name="T", raw_column="entity", since_column="recorded"))
    lake.define(feed)
    for i in range(7):  # batches 0-2 and 3-5 become segments, batch 6 stays a folder
        lake.write_incremental("t", _ents(spark, [(f"id{i}", i, f"v{i}", 1)]), 100 + i, f"b{i}")
    assert [b.get("load_ns_max") for b in lake.state("t").log if b["level"]] == [102, 105]
    for after, ids, folders in ((102, ["id3", "id4", "id5", "id6"], 2), (105, ["id6"], 1), (106, [], 0)):
        page = lake.entities("feed", since=encode_token(str(after)))
        assert sorted(r.id for r in page.entities.collect()) == ids
        assert len({f.rsplit("/", 1)[0] for f in lake.table(lake.dataset("feed"), encode_token(str(after))).inputFiles()}) == folders
    assert lake.entities("feed", since=encode_token("106")).token == encode_token("106")  # nothing new


def test_compaction_triggers_on_the_broadcast_byte_estimate(spark, tmp):
    # each batch: 2 ids of 1 byte -> estimate 2 + 2 x 48 = 98 bytes; compaction above half of 250
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4, broadcast_bytes_max=250)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "a1", 1), ("b", 1, "b1", 2)]), 1, "b1")
    st = lake.state("t")
    assert len(st.deltas) == 1 and st.delta_id_size() == 98 and not st.latest_paths
    lake.write_incremental("t", _ents(spark, [("a", 2, "a2", 1), ("c", 1, "c1", 2)]), 2, "b2")
    st = lake.state("t")
    assert st.deltas == [] and st.latest_paths  # folded into buckets (broadcast path: 196 <= 250)
    assert sorted((r.id, r.v) for r in lake.latest("t").collect()) == [("a", "a2"), ("b", "b1"), ("c", "c1")]


def test_replays_are_known_after_compaction_and_full_sync(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True, log_compact_batches=2)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    for i in range(5):
        lake.write_incremental("t", _ents(spark, [(f"id{i}", i, f"v{i}", 1)]), 10 + i, f"batch/{i}")
    assert [b["level"] for b in lake.state("t").log] == [2, 0]  # two segments were merged into one of the next level
    sync = lake.full_sync("t", "s")
    sync.start()
    sync.add(_ents(spark, [("synced", 1, "x", 1)]))
    sync.commit(99)
    version = lake.state("t").version
    for i in range(5):
        lake.write_incremental("t", _ents(spark, [(f"id{i}", i, "again", 1)]), 200, f"batch/{i}")
    assert lake.state("t").version == version and [r.id for r in lake.log("t").collect()] == ["synced"]


def test_two_writers_of_one_version_never_both_win(spark, tmp):
    import threading

    from entitylake.sinks import fs

    for k in range(5):
        path, won = f"{tmp}/m/v{k}.json", []
        gate = threading.Barrier(4)

        def create(name):
            gate.wait()
            if fs.write_text_exclusive(spark, path, name):
                won.append(name)

        threads = [threading.Thread(target=create, args=(f"writer-{i}",)) for i in range(4)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(won) == 1 and fs.read_text(spark, path) == won[0]


def test_a_half_written_manifest_is_passed_over(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "x", 1)]), 1, "b1")
    with open(f"{tmp}/lake/DB/PUBLIC/T/_manifest/v00000002.json", "w") as f:
        f.write('{"version": 2, "log": [')  # its writer died
    assert [r.id for r in lake.log("t").collect()] == ["a"]
    lake.write_incremental("t", _ents(spark, [("b", 1, "y", 1)]), 2, "b2")
    assert lake.state("t").version == 3 and lake.log("t").count() == 2


def test_latest_table_can_be_switched_off(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "a1", 1)]), 1, "b1")
    lake.define(DatasetDefinition("t", SourceConfig(latest_table=False), incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "a2", 1)]), 2, "b2")
    assert not lake.state("t").latest and lake.log("t").count() == 2
    assert [r.v for r in lake.latest("t").collect()] == ["a1"]  # left as it was


def test_newest_from_log_equals_latest_through_compaction(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True, log_compact_batches=2)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    rows = [("a", 9, "a-newest", 1), ("a", 3, "a-older", 2), ("b", None, "b1", 3), ("b", None, "b2", 4), ("c", 5, "c", 5)]
    lake.write_incremental("t", _ents(spark, rows), 1, "b1", ("_arrival",))
    lake.write_incremental("t", _ents(spark, [("c", 1, "c-later", 1)]), 2, "b2", ("_arrival",))
    assert [b["level"] for b in lake.state("t").log] == [1]
    want = [("a", "a-newest"), ("b", "b2"), ("c", "c-later")]
    assert sorted((r.id, r.v) for r in lake.newest("t").collect()) == want
    assert sorted((r.id, r.v) for r in lake.latest("t").collect()) == want


def test_record_token_in_custom_expressions():
    from entitylake.operators.incoming import entity_expression

    assert entity_expression('$1:props:"urn:a"::string') == """variant_get(entity, '$["props"]["urn:a"]', 'variant')::string"""
    assert entity_expression("concat('$1 ', $1:id::string)") == """concat('$1 ', variant_get(entity, '$["id"]', 'variant')::string)"""
    assert entity_expression("to_json($1)") == "to_json(entity)" and entity_expression("$10 + x") == "$10 + x"


def test_a_writer_that_pauses_before_it_publishes_loses_nothing(spark, tmp, monkeypatch):
    from entitylake.sinks import fs

    a = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    b = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    for lake in (a, b):
        lake.define(DatasetDefinition("t", incoming=MAP_V))
    a.write_incremental("t", _ents(spark, [("x", 1, "x0", 1)]), 1, "b0")
    publish, paused = fs._publish, []

    def slow(spark_, scheme, tmp_, p):
        if str(p.getName()).startswith("v") and not paused:  # the text is written, the name not yet taken
            paused.append(str(p.getName()))
            assert a.state("t").version == 1  # nobody sees half a version
            b.write_incremental("t", _ents(spark, [("y", 1, "y-from-b", 1)]), 3, "from-b")
        return publish(spark_, scheme, tmp_, p)

    monkeypatch.setattr(fs, "_publish", slow)
    a.write_incremental("t", _ents(spark, [("z", 1, "z-from-a", 1)]), 2, "from-a")
    assert paused == ["v00000002.json"] and a.state("t").version == 3
    assert {"b0", "from-a", "from-b"} == a.state("t").keys()
    assert sorted(r.id for r in a.log("t").collect()) == sorted(r.id for r in b.latest("t").collect()) == ["x", "y", "z"]
    assert fs.list_names(spark, f"{tmp}/lake/DB/PUBLIC/T/_manifest") == ["_last"] + [f"v0000000{k}.json" for k in (1, 2, 3)]


def test_publishing_through_a_file_context(spark, tmp):
    """Other schemes than ``file`` take their name by a rename without overwrite."""
    from entitylake.sinks import fs

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    for n, want in ((1, True), (2, False)):
        fs.write_text(spark, f"{tmp}/whole-{n}", f"text {n}")
        assert fs._publish(spark, "hdfs", path(f"file:{tmp}/whole-{n}"), path(f"file:{tmp}/final")) is want
    assert fs.read_text(spark, f"{tmp}/final") == "text 1"


def test_rising_load_numbers_are_checked_at_the_commit(spark, tmp):
    from entitylake.sinks.store import LoadOrderConflict

    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", 1, "x", 1)]), 10, "b1")
    with pytest.raises(LoadOrderConflict, match="starts at 10, 10 is committed"):
        lake.write_incremental("t", _ents(spark, [("b", 1, "y", 1)]), 10, "b2", rising=True)
    lake.write_incremental("t", _ents(spark, [("b", 1, "y", 1)]), 11, "b2", rising=True)
    sync = lake.full_sync("t", "s")
    sync.start()
    sync.add(_ents(spark, [("c", 1, "z", 1)]))
    sync.commit(5)  # replaces the rows, not the numbers already given out
    assert lake.state("t").newest_load() == 11


def test_base_and_run_meet_without_an_exchange(spark, tmp):
    from entitylake.plans.ingest import RUN_SHARE

    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4, delta_rows_max=1)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [(f"id{i}", 1, f"v{i}" * 50, i) for i in range(4_000)] + [(None, 1, "n1", 0)]), 1, "b1")
    st = lake.state("t")
    assert st.base and not st.run and not st.deltas and st.buckets == 4
    lake.write_incremental("t", _ents(spark, [("id7", 2, "seven", 1), ("new", 2, "new", 2), (None, 1, "n2", 0)]), 2, "b2")
    st2 = lake.state("t")
    assert st2.base == st.base and st2.run["bytes"] * RUN_SHARE <= st2.base["bytes"] and not st2.deltas  # the base is not rewritten
    lake.write_incremental("t", _ents(spark, [("id7", 3, "again", 1), ("id8", 3, "eight", 2)]), 3, "b3")
    st3 = lake.state("t")
    assert st3.base == st.base and st3.run != st2.run
    rows = lake.latest("t")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("Bucketed: true") >= 2, plan
    got = {r.id: (r.v, r.recorded) for r in rows.where("id is not null").collect()}
    assert len(got) == 4_001 and got["id7"] == ("again", 3) and got["id8"] == ("eight", 3) and got["new"] == ("new", 2) and got["id9"] == ("v9" * 50, 1)
    assert sorted(r.v for r in rows.where("id is null").collect()) == ["n1", "n2"]
    one = rows.where(F.col("id") == "id7")
    assert "SelectedBucketsCount: 1 out of 4" in one._jdf.queryExecution().executedPlan().toString() and [r.v for r in one.collect()] == ["again"]
    assert "latest_paths" not in st3.to_json() and len(st3.to_json()) < 4_000
    done = lake.compact("t")
    assert done.base != st.base and not done.run and {r.id: (r.v, r.recorded) for r in lake.latest("t").where("id is not null").collect()} == got


def test_a_base_that_outgrew_its_buckets_is_dealt_anew(spark, tmp, monkeypatch):
    from entitylake.sinks import store

    lake = Lake(spark, tmp + "/lake", latest_default=True, delta_rows_max=1)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [(f"id{i}", 1, f"v{i}", i) for i in range(100)]), 1, "b1")
    assert lake.state("t").buckets == 8
    monkeypatch.setattr(store, "BUCKET_BYTES", 400)
    lake.write_incremental("t", _ents(spark, [(f"id{i}", 2, f"w{i}", i) for i in range(90, 400)]), 2, "b2")
    assert lake.state("t").buckets >= 32
    lake.write_incremental("t", _ents(spark, [("id5", 3, "x5", 1)]), 3, "b3")
    got = {r.id: r.v for r in lake.latest("t").collect()}
    assert got == {f"id{i}": "x5" if i == 5 else f"w{i}" if i >= 90 else f"v{i}" for i in range(400)}


def test_rejects_are_kept_with_their_reasons(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    mapping = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "v", "integer", required=True), IncomingPropertyMapping("rec", is_recorded=True)))
    lake.define(DatasetDefinition("t", incoming=mapping))
    good, bad = [("a", 1, "1", 1), ("b", None, "2", 2)], [("c", 1, "x", 3), ("d", 1, None, 4)]
    with pytest.raises(Exception, match="required column v is null|CAST"):
        lake.write_incremental("t", _ents(spark, good + bad), 1, "b1")
    assert lake.state("t") is None
    lake.write_incremental("t", _ents(spark, good + bad), 1, "b1", strict=False)
    assert sorted((r.id, r.v) for r in lake.log("t").collect()) == sorted((r.id, r.v) for r in lake.latest("t").collect()) == [("a", 1), ("b", 2)]
    assert sorted((r.id, r.recorded, r.reason) for r in lake.rejects("t").collect()) == [("c", 1, "column v is not bigint"), ("d", 1, "required column v is null")]
    assert [json.loads(r.raw)["props"] for r in lake.rejects("t").where("id = 'c'").collect()] == [{"v": "x"}]
    assert lake.state("t").rejects[0]["rows"] == 2 and lake.state("t").log[0]["ranges"]["v"] == ["1", "2"]
    lake.write_incremental("t", _ents(spark, bad), 2, "b2", strict=False)  # nothing to load
    lake.write_incremental("t", _ents(spark, bad), 2, "b2", strict=False)  # a replay
    lake.write_incremental("t", _ents(spark, [("a", 1, "7", 1)]), 3, "b3")
    assert lake.rejects("t").count() == 4 and len(lake.state("t").log) == 2 and {r.v for r in lake.latest("t").collect()} == {7, 2}
    sync = lake.full_sync("t", "s", strict=False)
    sync.start()
    sync.add(_ents(spark, good + bad[:1]))
    sync.commit(9)
    assert sorted(r.v for r in lake.latest("t").collect()) == [1, 2] and [(r.id, r.recorded) for r in lake.rejects("t").collect()] == [("c", 9)]
    again = lake.full_sync("t", "s2", strict=False)
    again.start()
    again.add(_ents(spark, bad))
    again.commit(10)
    assert lake.log("t").count() == lake.latest("t").count() == 0 and lake.rejects("t").count() == 2


@pytest.mark.parametrize("query", ["log_compacted", "log_since_event_time"])
def test_weekly_batches_are_chosen_in_the_scan_and_dealt_over_the_tasks(spark, tmp, monkeypatch, query):
    from entitylake import workloads

    rows = [(k, f"2024-01-{d:02d} 23:59:59.999999", k, "view", 1.0, '{"k": 1}') for k, d in enumerate((1, 7, 8, 16, 30))] + [(9, None, 1, "view", None, None)]
    cols = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, cols).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(tmp + "/events.parquet")
    plans, real = [], Lake.write_incremental

    def seen(self, name, entities, *a, **k):
        plans.append(entities._jdf.queryExecution().executedPlan().toString())
        return real(self, name, entities, *a, **k)

    monkeypatch.setattr(Lake, "write_incremental", seen)
    got = getattr(workloads, query)(spark, tmp)
    assert sorted(r.id[-1] for r in got.collect()) == (["0", "1", "2", "3", "4"] if query == "log_compacted" else ["3", "4"])
    assert len(plans) == 5 and all("GreaterThanOrEqual(ts," in p and "Exchange hashpartitioning(event_id" in p for p in plans)
