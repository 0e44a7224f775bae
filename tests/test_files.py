"""Entity batches -> expanded staged NDJSON.gz lines and back."""

import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

from entitylake.sinks.stage import write_stage
from entitylake.sources.entity_files import STAGE_ORDER, payload_entities, read_stage

PREFIXES = {"lib": "urn:library:", "geo": "https://places.example/id#"}
BATCH = [
    {"id": "@context", "namespaces": PREFIXES},
    {"id": "lib:book/7", "props": {"lib:title": "Dune: part one", "lib:pages": 612, "plain": None}, "refs": {"lib:at": "geo:north"}},
    {"id": "lib:book/8", "deleted": True, "props": {"lib:tags": ["sf", 2, {"lib:deep": "geo:x"}], "lib:price": 9.5}, "refs": {}},
    {"id": "lib:book/9", "recorded": 1722500000000000001, "refs": {"lib:by": ["geo:a", "who:b", "geo:c"], "other:link": "geo:south"}},
    {"id": "other:1", "deleted": False, "recorded": 0},
    {"props": {"lib:note": "no id"}},
]


def expanded(name):
    prefix, colon, rest = name.partition(":")
    return PREFIXES[prefix] + rest if colon and prefix in PREFIXES else name


def expected_lines(batch):
    """Staged lines of a batch: keys in the stage's order, objects sorted, unset fields left out."""
    out = []
    for e in batch[1:]:
        refs = {expanded(k): [expanded(x) for x in v] if isinstance(v, list) else expanded(v) for k, v in e.get("refs", {}).items()}
        props = {expanded(k): v for k, v in e.get("props", {}).items()}
        line = {"id": expanded(e["id"])} if "id" in e else {}
        line |= {"recorded": e["recorded"]} if e.get("recorded") else {}
        line |= {"deleted": True} if e.get("deleted") else {}
        out.append(line | {"refs": dict(sorted(refs.items())), "props": dict(sorted(props.items()))})
    return [json.dumps(x, separators=(",", ":")) for x in out]


def write_batch(tmp, name="batch.json", batch=BATCH, lead="", tail="\n", text=None):
    path = f"{tmp}/{name}"
    with open(path, "w", newline="") as f:
        f.write(text if text is not None else lead + json.dumps(batch, indent=1) + tail)
    return path


def staged_lines(path):
    out = []
    for f in sorted(glob.glob(path + "/*.gz")):
        out += gzip.open(f).read().decode().splitlines()
    return out


@pytest.mark.parametrize("lead", ["", "\n", "\t ", "\r\n\r\n", "﻿"], ids=["none", "newline", "tab", "crlf", "mark"])
def test_expanded_stage_lines(spark, tmp, lead):
    ents = payload_entities(spark, [write_batch(tmp, lead=lead, tail="\r\n \t")])
    write_stage(ents, tmp + "/stage", order_by=("_file", "_pos"))
    assert staged_lines(tmp + "/stage") == expected_lines(BATCH)


def test_each_file_has_its_own_context(spark, tmp):
    other = [{"id": "@context", "namespaces": {"lib": "http://elsewhere/"}}, {"id": "lib:1", "props": {"geo:p": 1}}]
    paths = [write_batch(tmp, "a.json"), write_batch(tmp, "b.json", other, lead="\n")]
    ents = payload_entities(spark, paths)
    write_stage(ents, tmp + "/stage", order_by=("_file", "_pos"))
    assert staged_lines(tmp + "/stage") == expected_lines(BATCH) + ['{"id":"http://elsewhere/1","refs":{},"props":{"geo:p":1}}']


@pytest.mark.parametrize(
    "text",
    ['[{"id":"a"}] {"id":"b"}', '[{"id":"a"}] [{"id":"b"}]', '{"id":"a"} {"id":"b"}', '[{"id":"a"}', '[{"id":"a"},]', " ", "nonsense", '[{"id":"a"}]]', '"text"'],
)
def test_text_after_the_value_or_malformed_text_aborts(spark, tmp, text):
    with pytest.raises(Exception, match="malformed payload file"):
        payload_entities(spark, [write_batch(tmp, text=text)]).collect()


def test_empty_array_has_no_entities(spark, tmp):
    paths = [write_batch(tmp, "a.json", text=" [ \n] "), write_batch(tmp, "b.json", [BATCH[0]])]
    assert payload_entities(spark, paths).count() == 0


def test_a_payload_of_150_mb(spark, tmp):
    filler = "x" * 1000
    path = f"{tmp}/large.json"
    with open(path, "w") as f:
        f.write('\n[{"id":"@context","namespaces":{"lib":"urn:library:"}}')
        for i in range(150_000):
            f.write(f',\n{{"id":"lib:{i}","recorded":12.5,"props":{{"lib:text":"{filler}"}}}}')
        f.write("]\n")
    got = payload_entities(spark, [path]).agg(F.count("id"), F.min("id"), F.max("recorded"), F.countDistinct("id")).first()
    assert tuple(got) == (150_000, "urn:library:0", 12, 150_000)
    with open(path, "a") as f:
        f.write('{"id":"lib:late"}')
    with pytest.raises(Exception, match="malformed payload file"):
        payload_entities(spark, [path]).count()


def test_payload_without_context_or_array(spark, tmp):
    one = write_batch(tmp, "one.json", text='\n{"id": "x:1", "props": {"x:a": 1}}')
    bare = write_batch(tmp, "bare.json", [{"id": "x:2"}, {"id": "@context", "namespaces": {"x": "http://x/"}}])
    # no expansion: only a first element that is the context counts
    assert sorted(r.id for r in payload_entities(spark, [one, bare]).collect()) == ["x:1", "x:2"]


def _numbered(spark, n):
    return spark.range(0, n).select(
        F.concat(F.lit("e"), F.col("id")).alias("id"),
        F.lit(None).cast("bigint").alias("recorded"),
        F.lit(False).alias("deleted"),
        F.parse_json(F.lit("{}")).alias("refs"),
        F.to_variant_object(F.create_map(F.lit("n"), F.col("id").cast("variant"))).alias("props"),
        F.col("id").alias("_arrival"),
    )


def test_stage_rollover_and_metadata(spark, tmp):
    write_stage(_numbered(spark, 120).coalesce(1), tmp + "/stage", per_file=50)
    assert len(glob.glob(tmp + "/stage/*.gz")) == 3  # 50 + 50 + 20
    st = read_stage(spark, tmp + "/stage")
    assert st.count() == 120 and {r["_roll"] for r in st.select("_roll").collect()} == {0, 1, 2}
    r = st.select("_file", "_fts", "_ix").first()
    assert r._file and r._fts is not None


def test_arrival_order_past_a_thousand_rollover_files(spark, tmp):
    from entitylake.operators.dedup import newest_per_id

    ents = _numbered(spark, 1100).withColumn("id", F.lit("same")).coalesce(1)
    write_stage(ents, tmp + "/stage", order_by=("_arrival",), per_file=1)
    assert any("-c1099." in f for f in glob.glob(tmp + "/stage/*.gz"))
    staged = read_stage(spark, tmp + "/stage").select(
        F.variant_get("entity", "$.id", "string").alias("id"), F.variant_get("entity", "$.props.n", "bigint").alias("n"),
        F.lit(None).cast("bigint").alias("recorded"), *STAGE_ORDER,
    )
    assert [r.n for r in newest_per_id(staged, "recorded", STAGE_ORDER).collect()] == [1099]


def test_outer_array_stripped_and_malformed_aborts(spark, tmp):
    with gzip.open(tmp + "/a.json.gz", "wt") as f:
        f.write('[{"id":"a"},{"id":"b"}]\n{"id":"c"}\n\t [{"id":"d"}, {"id":"e"}]\n')
    ids = sorted(r.id for r in read_stage(spark, tmp + "/a.json.gz").select(F.variant_get("entity", "$.id", "string").alias("id")).collect())
    assert ids == ["a", "b", "c", "d", "e"]
    with gzip.open(tmp + "/bad.json.gz", "wt") as f:
        f.write('{"id":"a"}\n{bad\n')
    with pytest.raises(Exception):
        read_stage(spark, tmp + "/bad.json.gz").collect()
    with gzip.open(tmp + "/trailing.json.gz", "wt") as f:
        f.write('{"id":"a"}\n{"id":"b"} {"id":"c"}\n')
    with pytest.raises(Exception, match="malformed staged line"):
        read_stage(spark, tmp + "/trailing.json.gz").collect()


def test_duplicate_json_keys_abort_the_load(spark, tmp):
    with gzip.open(tmp + "/dup.json.gz", "wt") as f:
        f.write('{"id":"a","props":{"k":1,"k":2}}\n')
    with pytest.raises(Exception):
        read_stage(spark, tmp + "/dup.json.gz").collect()


def test_plain_stage_files_keep_row_order_across_splits(spark, tmp):
    from pyspark.sql import Window

    write_stage(_numbered(spark, 3000), tmp + "/plain", order_by=("_arrival",), compression="none")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # force several splits per file
    try:
        st = read_stage(spark, tmp + "/plain").select(F.variant_get("entity", "$.props.n", "bigint").alias("n"), *STAGE_ORDER)
        assert st.rdd.getNumPartitions() > 2
        w = Window.orderBy(*STAGE_ORDER)
        got = [r.n for r in st.select("n", F.row_number().over(w).alias("r")).orderBy("r").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(3000))
