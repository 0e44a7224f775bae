"""Hard-negative mining against sorting all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from entitylake.llm import hard_negatives
from entitylake.llm.queries import QUERIES
from tests.conftest import SF


def plain(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """``rows``: (id, label, integer components), ids distinct."""
    out = set()
    for a, la, qa in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(qa, q)), i, lab) for i, lab, q in rows if i != a and len(q) == len(qa))
        for p_neg, p, _ in [s for s in scored if s[2] == la][:positives]:
            fits = [(s, i) for s, i, lab in scored if lab != la and low * -p_neg <= 100 * -s <= high * -p_neg]
            out |= {(a, p, k, n, -p_neg, -s) for k, (s, n) in enumerate(fits[:negatives], 1)}
    return out


def result(df):
    return [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()]


def test_query(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        if r.label is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding):
            rows.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * x) for x in r.embedding]))
    got = result(QUERIES["op11_hard_negatives"](spark, SF))
    assert len(got) == len(set(got)) and set(got) == plain(rows, lambda i: i % 100 == 0) and got


@pytest.mark.parametrize("block", [7, 1000])
def test_clustered_vectors_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SLICE", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8)) + 1
    x = centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, 8)) * 0.05
    x[100:260] = x[100]  # one vector in a third of the rows
    rows = [(i, i % 4, [int(v) for v in np.floor(64 * x[i])]) for i in range(400)]
    df = spark.createDataFrame([(i, lab, [v / 64 for v in q]) for i, lab, q in rows], "vec_id long, label int, embedding array<double>").repartition(5)
    got = result(hard_negatives.mine(hard_negatives.quantised(df, scale=64), F.col("vec_id") % 10 == 0))
    assert len(got) == len(set(got)) and set(got) == plain(rows, lambda i: i % 10 == 0) and got


def test_bounds_spare_most_scores_of_close_anchors():
    rng = np.random.default_rng(1)
    anchors = np.floor(1000 * (rng.normal(size=8) + rng.normal(size=(50, 8)) * 0.001)).astype(np.int64)
    cand = np.floor(1000 * rng.normal(size=(500, 8))).astype(np.int64)
    block, n, top = hard_negatives.Block(list(range(50)), ["x"] * 50, anchors), [0], {}

    def found(k, rows, scores):
        n[0] += len(rows)
        assert (scores == cand[rows] @ block.q[k]).all()
        top[k] = max(scores)

    block.walk(cand, lambda k, low, high: ((cand @ block.q[k] >= low) & (cand @ block.q[k] <= high)).all() & (high >= top.get(0, -np.inf)), found)
    assert n[0] < 0.1 * 50 * 500 and all(top[k] == max(cand @ block.q[k]) for k in top)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 9.0], 2), (3, [0.5, 9.0], 2), (3, [0.5, 9.0], 2), (4, [0.5, 9.0], None), (5, None, 2), (6, [], 2),
        (7, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, [None, 0.5], 2), (11, [0.5, 0.0, 0.0], 2), (12, [1e200, 0.0], 2), (13, [0.3, 0.0], 2), (14, [0.95, 0.0], 2),
        (None, [0.5, 0.0], 2), (100, [-1.0, 0.0], 3), (200, [0.0, 0.0, 1.0], 4), (15, [0.5, 0.0], 5), (15, [0.4, 0.0], 5), (300, [], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("q", "vec", "score", "anchor", "id", "r")})
    clean = hard_negatives.quantised(df)
    got = result(hard_negatives.mine(clean, F.col("vec_id") % 100 == 0))
    # anchors 100 and 200 have no other row of their label; of two rows 15 the lesser vector counts; ties go by id
    p = 256 * 256
    want = [(2, 128 * 256), (3, 128 * 256), (15, 102 * 256), (13, 76 * 256)]
    want = [(i, s) for i, s in want if 30 * p <= 100 * s <= 90 * p]
    assert sorted(got) == [(0, 1, k, i, p, s) for k, (i, s) in enumerate(want, 1)]
    assert hard_negatives.mine(clean.filter("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.mine(clean, F.lit(False)).count() == 0
    # scores of two equal candidates that only a long holds exactly
    big = [(0, [3.1e8 / 256, 2.9e8 / 256], 1), (1, [3.0e8 / 256, 3.0e8 / 256], 1), (2, [1.5e8 / 256, 1.5e8 / 256 + 1 / 256], 2), (3, [1.5e8 / 256, 1.5e8 / 256 + 2 / 256], 2)]
    q = {i: [math.floor(256 * x) for x in v] for i, v, _ in big}
    got = result(hard_negatives.mine(hard_negatives.quantised(spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")), F.col("vec_id") == 0))
    assert set(got) == plain([(i, lab, q[i]) for i, _, lab in big], lambda i: i == 0) and len(got) == 2
