"""The byte-context models: plain versions, the table beyond the broadcast bound, growth with the corpus."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from entitylake.llm import byte_contexts, ctw, lang_ppm
from tests.conftest import SF
from tests.llm import brute


def plain_ppm(train, text, depth, least):
    """Language -> code length in bits, byte by byte from counts of every context."""
    counts = defaultdict(Counter)
    for lang, t in train:
        data = b"\0" * depth + brute.lower(t).encode()
        for i in range(depth, len(data)):
            for k in range(depth + 1):
                counts[lang, data[i - k : i]][data[i]] += 1
    out = {}
    for lang in sorted({x for x, _ in train}):
        bits, data = 0.0, b"\0" * depth + brute.lower(text).encode()
        for i in range(depth, len(data)):
            p = 1 / 256
            for k in range(depth + 1):
                seen = counts.get((lang, data[i - k : i]), {})
                n = sum(seen.values())
                if n < least:
                    break
                p = seen[data[i]] / (n + len(seen)) if data[i] in seen else p * len(seen) / (n + len(seen))
            bits -= math.log2(p)
        out[lang] = bits
    return out


def judged(spark, train, texts, depth, least):
    docs = spark.createDataFrame([(t, lang) for lang, t in train], "text string, lang string")
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r for r in lang_ppm.predict(asked, lang_ppm.train(docs, depth, least), "i").collect()}


@pytest.mark.parametrize("depth, least, broadcast", [(4, 1, 10**6), (3, 2, 10**6), (4, 3, 10**6), (4, 2, 40), (5, 1, 30), (4, 1, 400), (2, 1, 0)])
def test_ppm_equals_the_plain_version(spark, monkeypatch, depth, least, broadcast):
    monkeypatch.setattr(lang_ppm, "BROADCAST_ENTRIES", broadcast)
    rng = random.Random(depth)
    words = {"aa": ["the", "thin", "there", "Hat", "ran"], "bb": ["der", "die", "über", "hat", "rand"], "cc": ["été", "la", "le", "rang"]}
    train = [(lang, " ".join(rng.choice(w) for _ in range(30))) for lang, w in words.items() for _ in range(3)]
    texts = [" ".join(rng.choice(words[lang]) for _ in range(6)) for lang in words] + ["ÜBER the", "x", "zzz qqq", "Hat", "hat ran " * 40]
    got = judged(spark, train, texts, depth, least)
    for i, t in enumerate(texts):
        want = plain_ppm(train, t, depth, least)
        best = min(want.values())
        assert want[got[i].lang_pred] == pytest.approx(best, abs=1e-3)
        assert got[i].score == pytest.approx(1 / sum(2.0 ** max(best - b, -1000) for b in want.values()), rel=2e-3)
        raw = brute.lower(t).encode()
        assert got[i].foreign == (best > 8 * (len(raw) + len(set(raw))))


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    whole = {r.doc_id: r.score for r in ctw.score(docs, depth=4, least=4).collect()}
    monkeypatch.setattr(byte_contexts, "BROADCAST_CONTEXTS", 300)
    parts = {r.doc_id: r.score for r in ctw.score(docs, depth=4, least=4).collect()}
    assert whole.keys() == parts.keys() and all(parts[i] == pytest.approx(s, rel=1e-6, abs=1e-6) for i, s in whole.items())


def test_depth_four_equals_the_recursion(spark):
    import zlib

    rows = [(i, t) for i, t in enumerate(["abracadabra abracadabra", "abrakadabra candela", "Candelabra ünd", "cadabra zebra", ""])]
    seen = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=4).collect():
        assert r.score == pytest.approx(brute.ctw_log10(seen, rows[r.doc_id][1], 4), abs=2e-4)


def test_kept_contexts_grow_with_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [len(lang_ppm.train(docs.filter(F.col("doc_id") % m == 0)).keys) for m in (8, 2, 1)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_personal_data_on_held_out_sentences(spark):
    """Five folds of the labelled table: what the CRF adds to the patterns is right and finds more."""
    import re

    from entitylake.llm import pii_crf

    def marked(line):
        text, spans, at = "", set(), 0
        for m in re.finditer(r"\[(email|ip|card|phone)\|([^\]]*)\]", line):
            text += line[at : m.start()]
            spans.add((m[1], len(text), len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        return text + line[at:], spans

    lines, right, wrong, gold, by_pattern = pii_crf.LABELLED.strip().split("\n"), Counter(), Counter(), Counter(), Counter()
    for fold in range(5):
        held = [marked(x) for i, x in enumerate(lines) if i % 5 == fold]
        table = spark.createDataFrame([(x,) for i, x in enumerate(lines) if i % 5 != fold], "sentence string")
        docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(held)], "doc_id long, text string")
        for r in pii_crf.find(docs, table).collect():
            text, spans = held[r.doc_id]
            found = {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)}
            base = set(pii_crf.base_spans(text))
            gold.update(k for k, _, _ in spans)
            right.update(k for k, _, _ in found & spans)
            wrong.update(k for k, _, _ in found - base - spans)
            by_pattern.update(k for k, _, _ in base & spans)
    print("held out, gold", dict(gold), "found", dict(right), "by patterns", dict(by_pattern), "wrongly added", dict(wrong))
    assert sum(wrong.values()) <= 0.1 * sum(right.values()) and sum(right.values()) >= 0.85 * sum(gold.values())
    assert right["phone"] >= 1.3 * by_pattern["phone"]
