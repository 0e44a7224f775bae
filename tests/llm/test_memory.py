"""What a task, a broadcast and a Python worker hold of a table does not grow with its texts' copies."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitylake.llm import byte_contexts, decontam, lang_ppm

DOCS = "doc_id long, text string, lang string, source string"
WORDS = [f"w{k}" for k in range(40)]


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bound", [decontam.BROADCAST_HASHES, 0])
def test_clean_documents_broadcast_hashes_alone(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_HASHES", bound)
    item, short = " ".join(WORDS[:13]), "Only Three words"
    bench = spark.createDataFrame([(1, item), (2, short), (3, short), (None, "w30 w31"), (4, None), (5, "--")], "item_id long, text string")
    texts = [item, f"a {item.upper()}. b", " ".join(WORDS[:9]), "x only-three, words y", "w30 w31", "", None, " ".join(WORDS[20:]), " ".join(WORDS[2:12]), "one two"]
    docs = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, item, "en", "s"), (None, "one two", "en", "s"), (9, "one two", "en", "s"), (9, item, "en", "s")]
    table = spark.createDataFrame(docs, DOCS)
    sent, real = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df.dtypes) or real(df))
    kept = decontam.clean_documents(table, bench)
    assert kept.columns == table.columns
    monkeypatch.setattr(F, "broadcast", real)
    assert sent == ([[("h", "bigint")]] if bound else [])
    bad = {item, texts[1], texts[3], texts[8]}
    assert _rows(kept) == Counter(d for d in docs if d[1] not in bad)
    assert {r.text for r in table.join(decontam.judge(table, bench).filter("contaminated"), "doc_id").collect()} >= bad - {item}
    none = spark.createDataFrame([], "item_id long, text string")
    assert _rows(decontam.clean_documents(table, none)) == Counter(docs)


def test_a_hash_alone_condemns_no_document(spark, monkeypatch):
    monkeypatch.setattr(decontam, "_window_hash", lambda words, at, length: F.lit(7).cast("long"))
    bench = spark.createDataFrame([(1, "p q r")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d", "en", "s"), (2, "o p Q r", "en", "s")], DOCS)
    assert [r.doc_id for r in decontam.clean_documents(docs, bench).collect()] == [1]


def test_language_id_sends_a_text_to_python_once(spark, monkeypatch):
    docs = [(k, f"the cat and the dog {k} went home", "en", "a") for k in range(40)] + [(100 + k, f"der hund und die katze {k} gehen", "de", "b") for k in range(40)]
    table = spark.createDataFrame([*docs, (7, None, "en", "a"), (8, "...", "en", "a")], DOCS)
    asked, real = [], lang_ppm.predict
    monkeypatch.setattr(lang_ppm, "predict", lambda d, model, *keep: asked.append((d.schema, keep)) or real(d, model, *keep))
    kept = lang_ppm.keep_known(table)
    assert kept.columns == table.columns and _rows(kept) == Counter(docs)
    ((schema, keep),) = asked
    assert "text" in schema.names and "text" in keep and "text" not in schema["row"].dataType.names


def test_a_task_holds_a_bounded_number_of_grams(spark, monkeypatch):
    rng = np.random.default_rng(1)
    texts = [("".join(map(chr, rng.integers(97, 123, 400))),) for _ in range(60)]
    table = spark.createDataFrame(texts, "text string").coalesce(1)
    want = _rows(byte_contexts.gram_counts(table, None, True, 3))
    assert byte_contexts.GRAMS_HELD <= 1 << 20
    monkeypatch.setattr(byte_contexts, "GRAMS_HELD", 50)
    assert _rows(byte_contexts.gram_counts(table, None, True, 3)) == want
