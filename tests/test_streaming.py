"""Landing-folder stream: one file per micro-batch, restarts load nothing twice."""

import json
import os
import time
from datetime import datetime

import pytest

from entitylake import workloads
from entitylake.lake import Lake
from entitylake.model import DatasetDefinition, IncomingMapping, IncomingPropertyMapping
from entitylake.plans import ingest
from entitylake.sinks import fs
from entitylake.streaming import landing as landing_module
from entitylake.streaming.landing import ingest_stream

NS = '{"id":"@context","namespaces":{"x":"http://example.org/"}}'
MAP = IncomingMapping(property_mappings=(IncomingPropertyMapping("v", "http://example.org/v", "string"),))


def _land(folder, name, entities, mtime):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as f:
        f.write("[" + ",\n".join([NS] + entities) + "]")
    os.utime(path, (mtime, mtime))


def test_stream_restart_is_exactly_once(spark, tmp):
    landing, ckpt = tmp + "/landing", tmp + "/ckpt"
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    now = time.time() - 1000
    _land(landing, "a", ['{"id":"x:1","props":{"x:v":"a1"}}', '{"id":"x:2","props":{"x:v":"a2"}}'], now)
    _land(landing, "b", ['{"id":"x:1","props":{"x:v":"b1"}}'], now + 10)
    ingest_stream(lake, "s", landing, ckpt, 1000)
    st = lake.state("s")
    assert sorted(b["load_ns_max"] for b in st.log) == [1000, 1001]  # one batch per file, in arrival order
    assert sorted((r.id, r.v, r.recorded) for r in lake.latest("s").collect()) == [
        ("http://example.org/1", "b1", 1001),
        ("http://example.org/2", "a2", 1000),
    ]
    ingest_stream(lake, "s", landing, ckpt, 1000)  # restart: nothing new
    assert lake.state("s").version == st.version
    _land(landing, "c", ['{"id":"x:2","props":{"x:v":"c2"}}'], now + 20)
    ingest_stream(lake, "s", landing, ckpt, 1000)
    assert sorted((r.id, r.v) for r in lake.latest("s").collect()) == [
        ("http://example.org/1", "b1"),
        ("http://example.org/2", "c2"),
    ]
    assert lake.log("s").count() == 4


def test_files_of_one_micro_batch_load_as_if_one_by_one(spark, tmp):
    landing, now = tmp + "/landing", time.time() - 1000
    for k in range(6):  # names sort against their modification times
        rows = [f'{{"id":"x:{i}","recorded":{100 - k},"props":{{"x:v":"file{k}"}}}}' for i in range(k, 6)] + [f'{{"props":{{"x:v":"none{k}"}}}}']
        _land(landing, f"z{9 - k}", rows, now + 10 * k)
    results = []
    for n in (1, 4, 8):
        lake = Lake(spark, f"{tmp}/lake{n}", latest_default=True, buckets=4)
        lake.define(DatasetDefinition("s", incoming=MAP))
        ingest_stream(lake, "s", landing, f"{tmp}/ckpt{n}", 1000, files_per_batch=n)
        assert len(lake.state("s").log) == -(-6 // n)
        results.append(sorted((str(r.id), r.v, r.recorded) for r in lake.latest("s").collect()))
        assert lake.log("s").count() == 27
    assert results[0] == results[1] == results[2]
    assert ("http://example.org/5", "file5", 1005) in results[0] and ("None", "none0", 1000) in results[0]


def test_load_numbers_rise_when_the_batch_size_changes_at_a_restart(spark, tmp):
    landing, ckpt, now = tmp + "/landing", tmp + "/ckpt", time.time() - 1000
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    for k in range(16):
        _land(landing, f"f{k:02d}", [f'{{"id":"x:1","props":{{"x:v":"old{k}"}}}}'], now + 10 * k)
    ingest_stream(lake, "s", landing, ckpt, 1000, files_per_batch=4)
    assert lake.state("s").newest_load() == 1015
    _land(landing, "late", ['{"id":"x:1","props":{"x:v":"NEW"}}'], now + 500)
    ingest_stream(lake, "s", landing, ckpt, 1000, files_per_batch=1)
    rows = [(r.v, r.recorded) for df in (lake.latest("s"), lake.newest("s")) for r in df.collect()]
    assert rows == [("NEW", 1016)] * 2


def test_a_batch_is_numbered_anew_when_another_writer_was_faster(spark, tmp):
    landing, now = tmp + "/landing", time.time() - 1000
    lake, other = (Lake(spark, tmp + "/lake", latest_default=True, buckets=4) for _ in range(2))
    for x in (lake, other):
        x.define(DatasetDefinition("s", incoming=MAP))
    _land(landing, "a", ['{"id":"x:1","props":{"x:v":"streamed"}}'], now)
    real, raced = lake.store.commit, []

    def racing(loc, state):
        if not raced:
            raced.append(True)
            _land(tmp + "/other", "b", ['{"id":"x:1","props":{"x:v":"other"}}'], now)
            ingest_stream(other, "s", tmp + "/other", tmp + "/ckpt2", 1000)
        return real(loc, state)

    lake.store.commit = racing
    # both streams start their batches at 0, so the keys differ by what other writers may use
    other.write_incremental, plain = (lambda *a, **k: plain(a[0], a[1], a[2], "other", *a[4:], **k)), other.write_incremental
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    assert raced and sorted((r.v, r.recorded) for r in lake.log("s").collect()) == [("other", 1000), ("streamed", 1001)]
    assert [r.v for r in lake.latest("s").collect()] == ["streamed"]


def test_a_micro_batch_writes_its_rows_once(spark, tmp):
    landing, now = tmp + "/landing", time.time() - 1000
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    for k in range(3):  # an id many times in a file and over files, and rows without id
        rows = [f'{{"id":"x:{i}","recorded":{10 - j},"props":{{"x:v":"{k}.{j}"}}}}' for i in range(k, 4) for j in range(3)]
        _land(landing, f"f{k}", [*rows, f'{{"props":{{"x:v":"none{k}"}}}}'], now + 10 * k)
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    st = lake.state("s")
    assert [d["path"] for d in st.deltas] == [b["path"] for b in st.log] and not os.path.exists(f"{lake.store.location(lake.dataset('s'))}/latest")
    assert [d["rows"] for d in st.deltas] == [13, 10, 7]  # all rows of the folder bound what a read broadcasts

    def rows(df):
        return sorted((str(r.id), r.v, r.recorded) for r in df.collect())

    x = "http://example.org/"
    want = [("None", f"none{k}", 1000 + k) for k in range(3)] + [(f"{x}{i}", f"{min(i, 2)}.0", 1000 + min(i, 2)) for i in range(4)]
    assert rows(lake.latest("s")) == rows(lake.newest("s")) == sorted(want)
    ddl = "id string, recorded bigint, deleted boolean, refs variant, props variant"
    plain = spark.createDataFrame([(f"{x}1", None, False, None, None)], ddl)
    lake.write_incremental("s", plain, 500, "plain")  # a batch with a lower load number than the stream's: it came later
    _land(landing, "f3", ['{"id":"x:3","props":{"x:v":"3.0"}}'], now + 50)
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    want = [w for w in want if w[0] not in (f"{x}1", f"{x}3")] + [(f"{x}1", None, 500), (f"{x}3", "3.0", 1003)]
    assert rows(lake.latest("s")) == sorted(want)
    logged = {b["path"] for b in lake.state("s").log}
    folded = lake.compact("s")
    assert not folded.deltas and not logged & set(folded.dropped)  # the log still has the folders
    assert rows(lake.latest("s")) == sorted(want)


def test_landing_files_are_listed_dated_and_moved_by_folder(spark, tmp):
    for k in (2, 10):
        _land(f"{tmp}/ready/n={k}", "part", ["{}"], 5)
    open(f"{tmp}/ready/n=2/_mark", "w").close()
    files = fs.files_below(spark, f"{tmp}/ready")
    assert [f.rsplit("/", 2)[1:] for f in files] == [["n=10", "part.json"], ["n=2", "part.json"]]
    fs.set_mtimes(spark, tmp, {f: 1_000_000 * (i + 1) for i, f in enumerate(files)})
    fs.move_into(spark, {f: f.rsplit("/", 2)[1] for f in files}, f"{tmp}/landing")
    assert {n: os.path.getmtime(f"{tmp}/landing/{n}") for n in os.listdir(f"{tmp}/landing") if n[0] != "."} == {"n=10": 1000, "n=2": 2000}


def test_a_micro_batch_reads_the_manifest_once(spark, tmp, monkeypatch):
    landing, now = tmp + "/landing", time.time() - 1000
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    for k in range(4):
        _land(landing, f"f{k}", [f'{{"id":"x:{k % 2}","props":{{"x:v":"\u00e9{k}"}}}}'], now + 10 * k)
    read, plain = [], fs.read_text
    monkeypatch.setattr(fs, "read_text", lambda s, path: read.append(path) or plain(s, path))
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    monkeypatch.undo()
    manifests = sorted(p.rsplit("/", 1)[1] for p in read if p.endswith(".json"))
    assert manifests == ["v00000001.json", "v00000002.json", "v00000003.json"]
    assert sorted((r.v, r.recorded) for r in lake.latest("s").collect()) == [("\u00e92", 1002), ("\u00e93", 1003)]


def test_landing_events_are_dealt_by_file_before_they_are_mapped(spark, tmp, monkeypatch):
    ddl = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    at = datetime(2024, 1, 1)
    rows = [(k, at, k % 7, "signup" if k % 3 else "error", None if k % 5 else k / 2, f'{{"k": {k}}}') for k in range(4100)]
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp}/events.parquet")
    mapped, real = [], workloads.write_payloads
    monkeypatch.setattr(workloads, "write_payloads", lambda ev, *a, **k: mapped.append(ev) or real(ev, *a, **k))
    files = workloads._landing_files(spark, tmp, f"{tmp}/landing")
    plan = mapped[0]._jdf.queryExecution().toString().rsplit("Physical Plan", 1)[1]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("to_variant_object") < plan.index("Exchange")
    assert [f.rsplit("/", 2)[1] for f in files] == ["file_no=0", "file_no=1", "file_no=2"]
    ids = [[e["props"]["e:event_id"] for e in json.loads(open(f.removeprefix("file:")).read())[1:]] for f in files]
    assert ids == [list(range(2000)), list(range(2000, 4000)), list(range(4000, 4100))]


def test_small_texts_are_read_whole(spark, tmp):
    with open(f"{tmp}/t", "wb") as f:
        f.write("a\u00e9\r\nb\rc\n".encode() + b"\xff\n")
    assert fs.read_text(spark, f"{tmp}/t") == "a\u00e9\nb\nc\n\ufffd"


def _store_calls(lake, monkeypatch):
    """Batch keys whose rows a job of their own wrote, and the folders written ahead."""
    alone, many = [], []
    plain, ahead = ingest._write_log, landing_module.write_ahead
    monkeypatch.setattr(ingest, "_write_log", lambda store, rows, schema, path, key, strict: alone.append(key) or plain(store, rows, schema, path, key, strict))
    monkeypatch.setattr(landing_module, "write_ahead", lambda store, ds, path, *a: many.append(path) or ahead(store, ds, path, *a))
    return alone, many


def _rows(df):
    return sorted((str(r.id), r.v, r.recorded) for r in df.collect())


def test_rows_of_coming_micro_batches_are_written_in_one_job(spark, tmp, monkeypatch):
    landing, now = tmp + "/landing", time.time() - 1000
    for k in range(9):  # names sort against times; an id in many files, rows without id, a file without entities
        rows = [f'{{"id":"x:{i}","recorded":{50 - k},"props":{{"x:v":"{k}.{i}"}}}}' for i in range(k % 4, 6)] + [f'{{"props":{{"x:v":"none{k}"}}}}']
        _land(landing, f"z{9 - k}", rows if k != 7 else [], now + 10 * k)
    results = {}
    for n in (1, 2):
        for size in (64, 1):
            lake = Lake(spark, f"{tmp}/lake{n}-{size}", latest_default=True, buckets=4)
            lake.define(DatasetDefinition("s", incoming=MAP))
            with monkeypatch.context() as m:
                m.setattr(landing_module, "AHEAD_BATCHES", size)
                alone, many = _store_calls(lake, m)
                ingest_stream(lake, "s", landing, f"{tmp}/ckpt{n}-{size}", 1000, files_per_batch=n)
            st = lake.state("s")
            assert len(st.log) == (8 if n == 1 else 5) and st.version == len(st.log)  # one commit for each micro-batch with rows
            assert [d["path"] for d in st.deltas] == [b["path"] for b in st.log] and len({b["path"] for b in st.log}) == len(st.log)
            assert [b["key"] for b in st.log] == [f"stream-{k:08d}" for k in range(9 if n == 1 else 5) if n == 2 or k != 7]
            assert not many if size == 1 else many
            assert len(alone) == (-(-9 // n) if size == 1 else 1)  # ahead: the one after the empty file, or the last, which is not full
            stats = [{k: b.get(k) for k in ("key", "load_ns_max", "level", "ranges")} for b in st.log], [(d["rows"], d["id_bytes"]) for d in st.deltas]
            results[n, size] = stats, _rows(lake.log("s")), _rows(lake.latest("s")), _rows(lake.newest("s"))
            assert _rows(lake.compact("s") and lake.latest("s")) == results[n, size][2]
    assert results[1, 64] == results[1, 1] and results[2, 64] == results[2, 1]


def test_what_does_not_fit_its_micro_batch_is_not_taken(spark, tmp, monkeypatch):
    landing, now = tmp + "/landing", time.time() - 1000
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    for k in range(6):
        _land(landing, f"f{k}", [f'{{"id":"x:{k}","props":{{"x:v":"{k}"}}}}'], now + 10 * k)
    alone, many = _store_calls(lake, monkeypatch)
    ddl = "id string, recorded bigint, deleted boolean, refs variant, props variant"
    commit, seen = lake.store.commit, []

    def between(loc, state):
        done = commit(loc, state)
        if len(seen) == 1:  # after the second micro-batch: another writer takes the next numbers
            lake.store.commit = commit
            lake.write_incremental("s", spark.createDataFrame([("http://example.org/9", None, False, None, None)], ddl), 2000, "other")
        seen.append(done.version)
        return done

    lake.store.commit = between
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    x = "http://example.org/"
    want = [(f"{x}0", "0", 1000), (f"{x}1", "1", 1001), (f"{x}9", None, 2000)] + [(f"{x}{k}", f"{k}", 1999 + k) for k in range(2, 6)]
    assert _rows(lake.log("s")) == _rows(lake.latest("s")) == sorted(want)
    assert [k for k in alone if k != "other"] == ["stream-00000002"] and len(many) == 2
    kept = {b["path"] for b in lake.state("s").log}
    assert all(p in kept for m in many for p in (f"{m}/{n}" for n in fs.list_names(spark, m)) if "_ahead=" in p)  # the others are gone


def test_a_bad_file_fails_its_own_micro_batch(spark, tmp):
    landing, now = tmp + "/landing", time.time() - 1000
    lake = Lake(spark, tmp + "/lake", latest_default=True, buckets=4)
    lake.define(DatasetDefinition("s", incoming=MAP))
    for k in range(5):
        _land(landing, f"f{k}", [f'{{"id":"x:{k}","props":{{"x:v":"{k}"}}}}'], now + 10 * k)
    with open(f"{landing}/f3.json", "w") as f:
        f.write("[" + NS + ",{")
    os.utime(f"{landing}/f3.json", (now + 30, now + 30))
    with pytest.raises(Exception, match="malformed payload file"):
        ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)
    assert [r[1:] for r in _rows(lake.log("s"))] == [("0", 1000), ("1", 1001), ("2", 1002)]
    _land(landing, "f3", ['{"id":"x:3","props":{"x:v":"3"}}'], now + 30)
    ingest_stream(lake, "s", landing, tmp + "/ckpt", 1000)  # goes on where it stopped
    assert [r[1:] for r in _rows(lake.latest("s"))] == [(f"{k}", 1000 + k) for k in range(5)]


def test_small_files_of_the_local_disk(spark, tmp):
    assert fs.local_path(spark, f"file:{tmp}/a") == fs.local_path(spark, f"file://{tmp}/a") == fs.local_path(spark, f"{tmp}/a") == f"{tmp}/a"
    assert fs.local_path(spark, "viewfs://store/a") is fs.local_path(spark, "s3a://b/a") is fs.local_path(spark, "file://host/a") is None
    where = f"file:{tmp}/d/hint"
    path, hadoop = fs._fs(spark, where)[1], fs._fs(spark, where)[0]
    fs._write_whole(hadoop.create(path, True), bytearray(b"old"))  # with a checksum beside it
    assert os.path.exists(f"{tmp}/d/.hint.crc") and fs.read_text(spark, where) == "old"
    fs.write_text(spark, where, "new")
    assert fs.read_text(spark, where) == "new" and bytes(hadoop.open(path).readAllBytes()) == b"new"
    assert fs.size_of(spark, f"file:{tmp}/d") == 3 == hadoop.getContentSummary(path.getParent()).getLength()
    for text in ("", "x"):
        assert [fs.write_text_exclusive(spark, f"{tmp}/e/k{len(text)}", t) for t in (text, "late")] == [True, False]
        assert fs.read_text(spark, f"{tmp}/e/k{len(text)}") == text and sorted(os.listdir(f"{tmp}/e")) == ["k0", "k1"][: len(text) + 1]
