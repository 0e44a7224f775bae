"""The registered queries over the given small tables, against DuckDB or the plain versions."""

import re
import html
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from entitylake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF
from tests.llm import brute
from tools.check_oracle import TABLES, rows_of


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in read(spark, "documents")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert Counter(got) == Counter(rows_of(cols, res.fetchall()))


def test_op4_base_spans(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op4_pii"](spark, SF).collect()}
    for i, text in docs:
        base = brute.pii(text)
        counts = Counter(k for k, _, _ in base)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(counts[k] for k in brute.PII)
        assert got[i].base_sha256 == brute.sha_of_spans(base)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i].spans.split(","))


def test_op5_components(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert got == brute.jaccard_components(docs, 3, 90, 100)


def test_op6_unigram(spark, docs):
    got = QUERIES["op6_ctw_scoring"](spark, SF).collect()
    want = brute.unigram(docs)
    for r in got:
        held, n, known, train, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(score, rel=1e-9)
    held = [r.bits_per_byte for r in got if r.held_out]
    assert sum(held) / len(held) < 3.0  # far below the 4.1 bits of single bytes


def test_op7_links(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, "embeddings")]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op7_embedding_dedup"](spark, SF).collect()}
    assert got == brute.cosine_links(rows)


def test_op8_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in read(spark, "documents")}
    got = [r for r in QUERIES["op8_language_id"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.97 * len(got) > 0


def test_op10_article_text(spark):
    pages = {r.page_id: r.html for r in read(spark, "pages")}
    for r in QUERIES["op10_html_extraction"](spark, SF).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_pipeline_stages_against_plain_versions(spark):
    """Each stage's decisions from its own input."""
    from entitylake.llm.line_dedup import chunk_lines

    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert 4 <= len(stages) <= 5
    known = stages["language_id"](spark, docs, SF)
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    lines = stages["line_dedup"](spark, docs, SF).cache()
    want = brute.lines_kept([(r.doc_id, r.text) for r in docs.collect()], lambda t: chunk_lines(t, 50))
    before = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in lines.collect()} == {i: t for i, t in want.items() if t == before[i] or t.strip()}
    assert lines.columns == docs.columns
    kept = stages["ngram_jaccard_join"](spark, lines, SF).cache()
    groups = brute.jaccard_components([(r.doc_id, r.text) for r in lines.collect()], 5, 8, 10)
    assert {r.doc_id for r in kept.collect()} == {i for i, (n, c) in groups.items() if i == c}
    clean = stages["benchmark_decontamination"](spark, kept, SF).cache()
    hit = {r.doc_id for r in QUERIES["op9_decontamination"](spark, SF).collect() if r.contaminated}
    unchanged = {r.doc_id for r in kept.collect() if before[r.doc_id] == r.text}
    assert {r.doc_id for r in clean.collect()} & unchanged == unchanged - hit
    clean.createOrReplaceTempView("clean_documents")
    from entitylake.llm.oracles import mixing_sql

    con = duckdb.connect()
    con.register("clean", clean.toPandas())
    drawn = Counter((r.doc_id, r.epoch) for r in stages["mixing"](spark, clean, SF).collect())
    assert drawn == Counter((r[0], r[6]) for r in con.execute(mixing_sql("clean")).fetchall())


def test_pipeline_runs_all_stages(spark):
    """run() is the stages one after the other, each on what the one before wrote; what a document keeps is its own."""
    from entitylake.session import scratch_dir

    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "epoch"] and out.count() > 0
    given = spark.read.parquet(f"{SF}/documents.parquet")
    frame, ids = given, [{r.doc_id for r in given.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, frame, SF).write.parquet(path)
        frame = spark.read.parquet(path)
        ids.append({r.doc_id for r in frame.select("doc_id").collect()})
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, frame.select(*out.columns).collect()))
    assert all(after <= before for before, after in zip(ids, ids[1:])) and all(len(a) < len(b) for a, b in zip(ids[2:5], ids[1:]))
    texts = {r.doc_id: r for r in given.collect()}
    for r in frame.collect():
        lines = iter(texts[r.doc_id].text.split("\n"))
        assert all(x in lines for x in r.text.split("\n")) and (r.lang, r.source, r.n_chars) == (*texts[r.doc_id][2:4], len(r.text))  # lines in their order
