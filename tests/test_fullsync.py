"""Full sync sessions (F8): start / middle / end, abandoned ids, first sync, latest on/off."""

import pytest
from pyspark.sql import functions as F

from entitylake.lake import Lake
from entitylake.model import DatasetDefinition, IncomingMapping, IncomingPropertyMapping, SourceConfig

MAP_V = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "v", "string"),))


def _ents(spark, rows):
    df = spark.createDataFrame(rows, "id string, v string")
    return df.select(
        "id",
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        F.parse_json(F.lit("{}")).alias("refs"),
        F.to_variant_object(F.create_map(F.lit("v"), F.col("v").cast("variant"))).alias("props"),
    )


def _ids(df):
    return sorted((r.id, r.v, r.recorded) for r in df.collect())


@pytest.mark.parametrize("latest", [True, False])
def test_multi_batch_sync_replaces_everything(spark, tmp, latest):
    lake = Lake(spark, tmp + "/lake", latest_default=latest)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("old", "x"), ("a", "old-a")]), 1, "inc1")
    sync = lake.full_sync("t", "sync-1")
    sync.start()
    sync.add(_ents(spark, [("a", "a1")]))
    before = _ids(lake.log("t"))
    sync.add(_ents(spark, [("b", "b1"), ("a", "a2")]))
    assert _ids(lake.log("t")) == before  # readers see the old table until commit
    sync.add(_ents(spark, [("c", "c1")]))
    sync.commit(9)
    assert _ids(lake.log("t")) == [("a", "a1", 9), ("a", "a2", 9), ("b", "b1", 9), ("c", "c1", 9)]
    if latest:
        assert _ids(lake.latest("t")) == [("a", "a2", 9), ("b", "b1", 9), ("c", "c1", 9)]
    else:
        assert lake.latest("t").count() == 0


def test_first_sync_and_restart(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V, source=SourceConfig(latest_table=True)))
    a = lake.full_sync("t", "a")
    a.start()
    a.add(_ents(spark, [("x", "from-a")]))
    b = lake.full_sync("t", "b")
    b.start()  # voids a
    with pytest.raises(RuntimeError):
        a.add(_ents(spark, [("y", "late")]))
    with pytest.raises(RuntimeError):
        a.commit(5)
    b.add(_ents(spark, [("z", "from-b")]))
    b.commit(6)
    assert _ids(lake.log("t")) == [("z", "from-b", 6)]
    assert _ids(lake.latest("t")) == [("z", "from-b", 6)]


def test_sync_requires_id(spark, tmp):
    lake = Lake(spark, tmp + "/lake")
    with pytest.raises(ValueError):
        lake.full_sync("t", "")


def test_manifest_versions_are_exclusive(spark, tmp):
    from entitylake.sinks.store import CommitConflict

    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", "1")]), 1, "b1")
    st = lake.state("t")
    with pytest.raises(CommitConflict):
        lake.store.commit(lake.store.location(lake.dataset("t")), st)


def test_vacuum_keeps_results_and_drops_superseded_data(spark, tmp):
    import os

    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4, delta_rows_max=2, log_compact_batches=2)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    for i in range(4):
        lake.write_incremental("t", _ents(spark, [(f"k{i % 2}", f"v{i}")]), 10 + i, f"b{i}")
    sync = lake.full_sync("t", "s1")
    sync.start()
    sync.add(_ents(spark, [("k0", "synced")]))
    sync.commit(99)
    lake.write_incremental("t", _ents(spark, [("k1", "after")]), 100, "b9")
    before_log, before_latest = _ids(lake.log("t")), _ids(lake.latest("t"))
    assert lake.vacuum("t", keep_versions=1) == []  # superseded, but not for long enough
    deleted = lake.vacuum("t", keep_versions=1, older_than_s=0)
    assert deleted and all(not os.path.exists(p.replace("file:", "")) for p in deleted)
    assert _ids(lake.log("t")) == before_log == [("k0", "synced", 99), ("k1", "after", 100)]
    assert _ids(lake.latest("t")) == before_latest == [("k0", "synced", 99), ("k1", "after", 100)]
    assert not [d for d in os.listdir(f"{tmp}/lake/DB/PUBLIC/T/log") if not d.startswith("b9")]
    assert lake.state("t").version >= 1


def test_manifest_hint_stale_missing_or_torn(spark, tmp):
    import os

    lake = Lake(spark, tmp + "/lake")
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    for i in range(3):
        lake.write_incremental("t", _ents(spark, [(f"k{i}", "v")]), i, f"b{i}")
    hint = f"{tmp}/lake/DB/PUBLIC/T/_manifest/_last"
    assert open(hint).read().strip() == "3" and lake.state("t").version == 3
    with open(hint, "w") as f:
        f.write("1")  # stale: newer versions are probed
    assert lake.state("t").version == 3
    with open(hint, "w") as f:
        f.write("not-a-number")  # torn: fall back to listing
    assert lake.state("t").version == 3
    os.remove(hint)  # missing: listing
    assert lake.state("t").version == 3


def test_same_sync_id_again_starts_from_nothing(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    first = lake.full_sync("t", "nightly")
    first.start()
    first.add(_ents(spark, [("a", "abandoned")]), seq=0)
    first.add(_ents(spark, [("b", "abandoned")]), seq=1)
    again = lake.full_sync("t", "nightly")
    again.start()
    again.add(_ents(spark, [("c", "c1")]), seq=0)
    again.commit(5)
    assert _ids(lake.log("t")) == _ids(lake.latest("t")) == [("c", "c1", 5)]


def test_a_sync_that_dies_before_the_switch_leaves_the_table(spark, tmp, monkeypatch):
    lake = Lake(spark, tmp + "/lake", latest_default=True)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    for rows, load in (([("a", "one")], 1), ([("b", "two")], 2)):
        sync = lake.full_sync("t", "nightly")  # the id of the table's own state
        sync.start()
        sync.add(_ents(spark, rows), seq=0)
        if load == 2:
            monkeypatch.setattr(lake.store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
            with pytest.raises(RuntimeError, match="driver lost"):
                sync.commit(load)
            monkeypatch.undo()
            assert _ids(lake.log("t")) == _ids(lake.latest("t")) == [("a", "one", 1)]
        sync.commit(load)
    assert _ids(lake.log("t")) == _ids(lake.latest("t")) == [("b", "two", 2)]


def test_a_batch_loaded_during_the_commit_does_not_fail_the_sync(spark, tmp):
    a, b = (Lake(spark, tmp + "/lake", latest_default=True) for _ in range(2))
    for lake in (a, b):
        lake.define(DatasetDefinition("t", incoming=MAP_V))
    sync = a.full_sync("t", "s")
    sync.start()
    sync.add(_ents(spark, [("x", "synced")]))
    commit, raced = a.store.commit, []

    def racing(loc, state):
        if not raced:
            raced.append(b.write_incremental("t", _ents(spark, [("y", "meanwhile")]), 7, "inc"))
        return commit(loc, state)

    a.store.commit = racing
    sync.commit(9)
    assert _ids(a.log("t")) == _ids(a.latest("t")) == [("x", "synced", 9)]  # the sync replaces what is there
    b.write_incremental("t", _ents(spark, [("y", "meanwhile")]), 7, "inc")  # and the batch stays known
    assert a.log("t").count() == 1


def test_vacuum_spares_a_running_ingest(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("a", "1")]), 1, "b1")
    commit = lake.store.commit

    def vacuumed(loc, state):
        lake.store.vacuum(loc, keep_versions=1, older_than_s=0)  # between the data and the manifest
        return commit(loc, state)

    lake.store.commit = vacuumed
    lake.write_incremental("t", _ents(spark, [("b", "2")]), 2, "b2")
    assert _ids(lake.log("t")) == _ids(lake.latest("t")) == [("a", "1", 1), ("b", "2", 2)]


def test_commit_with_latest_off_keeps_the_latest_table_and_can_be_repeated(spark, tmp):
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("t", incoming=MAP_V))
    lake.write_incremental("t", _ents(spark, [("old", "o")]), 1, "b1")
    lake.define(DatasetDefinition("t", SourceConfig(latest_table=False), incoming=MAP_V))
    sync = lake.full_sync("t", "s-1")
    sync.start()
    sync.add(_ents(spark, [("new", "n")]), seq=0)
    done = sync.commit(2)
    assert [r.id for r in lake.log("t").collect()] == ["new"] and [r.id for r in lake.latest("t").collect()] == ["old"]
    assert sync.commit(2).version == done.version  # the answer was lost: asked again
    assert lake.full_sync("t", "s-1").commit(2).version == done.version  # also by a driver that took over
    with pytest.raises(RuntimeError, match="not open"):
        lake.full_sync("t", "s-2").commit(2)
    again = lake.full_sync("t", "s-1")
    again.start()  # the id is used for a second sync, left empty
    assert again.commit(3).version == done.version + 2 and lake.log("t").count() == 0
    assert [r.id for r in lake.latest("t").collect()] == ["old"]
