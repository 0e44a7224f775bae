"""Prefix tree formatting against plain tries, and its exact round trip."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entitylake.llm import prefix_tree
from entitylake.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = "</s>[INST] ok [/INST]"


def by_conversation(rows):
    out = defaultdict(list)
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for r in sorted(rows, key=key):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return out


def plain(rows):
    out = {}
    for c, turns in by_conversation(rows).items():
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)]
    out = QUERIES["op13_prefix_tree"](spark, SF)
    assert digests(out) == plain(rows)
    assert all(r.formatted_chars > sum(len(x) for _, x in by_conversation(rows)[r.conv_id]) for r in out.collect())


ROWS = [
    *[(c, t, r, x) for c in (1, 2, 3) for t, r, x in ((0, "user", "hello"), (1, "assistant", "hi"), (2, "user", f"branch {min(c, 2)}"))],
    (4, 0, "user", "hello"), (5, 0, "user", "hello"), (5, 1, "assistant", "hi"), (6, 0, "system", "be kind"), (6, 1, "user", "hello"), (7, 0, "user", "hello"), (7, 1, "assistant", "other"),
    (8, 0, "user", TRICKY), (8, 1, "assistant", TRICKY), (8, 2, "tool [/TURN]", TRICKY), (8, 3, "", "<s><\\s><\\\\/s>[/SYS][\\TURN] [ INST] \\< $1"),
    (9, None, None, None), (9, 0, "assistant", None), (None, 0, "user", "no id"), (None, 0, "user", "no id"), (10, 5, "assistant", " lead and trail "), (10, 2, "user", "é" * 30_000 + "\U0001f600"),
    *[(20, t, "user" if t % 2 == 0 else "assistant", f"long {t}") for t in range(1_500)], *[(21, t, "user" if t % 2 == 0 else "assistant", f"long {t}" if t < 900 else "x") for t in range(950)],
    *[(c, t, "user", "same") for c in range(100, 160) for t in range(2)],
]


@pytest.fixture(scope="module")
def forest(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("conv", "node", "depth", "size", "leaf", "start", "rank", "part")})
    return prefix_tree.build(df.repartition(6))


def test_round_trip(forest):
    assert digests(prefix_tree.read_back(forest)) == plain(ROWS)


def test_shared_turns_are_put_out_once_depth_first(forest):
    nodes = {bytes(r.node): r for r in forest.nodes.collect()}
    prefixes = {tuple(v[: k + 1]) for v in by_conversation(ROWS).values() for k in range(len(v))}
    assert len(nodes) == forest.nodes.count() == len(prefixes)
    turn_of = {bytes(r.node): (r.said_by, r.said) for r in prefix_tree.read_turns(forest.nodes).collect()}

    def path(n):
        out = []
        while True:
            out.append(nodes[n])
            if not nodes[n].parent:
                return out[::-1]
            n = bytes(nodes[n].parent)

    assert {tuple(turn_of[bytes(x.node)] for x in path(n)) for n in nodes} == prefixes
    trees = defaultdict(list)
    for r in nodes.values():
        trees[bytes(r.tree)].append(r)
    for tree in trees.values():
        tree.sort(key=lambda r: r.start)
        assert tree[0].start == 0 and all(a.end == b.start for a, b in zip(tree, tree[1:])) and all(r.end - r.start == len(r.text) for r in tree)
        open_ = []
        for r in tree:  # depth first: the parent is the last node of its depth
            del open_[r.depth :]
            assert (bytes(r.parent) or None) == (open_[-1] if open_ else None)
            open_.append(bytes(r.node))
    for n, r in nodes.items():
        above = path(n)[:-1]
        assert r.position == sum(len(a.text) for a in above)
        assert [p for s in r.sees for p in range(s.start, s.end)] == [p for a in above for p in range(a.start, a.end)]
        assert all(a.end < b.start for a, b in zip(r.sees, r.sees[1:]))  # adjoining intervals are one
        spoken = r.text[r.loss_start : r.loss_end] if r.loss_start is not None else None
        assert (spoken is not None) == (r.role == "assistant")


def test_controls_never_stand_inside_a_turn(spark, forest):
    import re

    for r in forest.nodes.collect():
        body = r.text.removeprefix("<s>") if r.depth == 0 else r.text
        marks = re.findall(r"</?s>|\[/?(?:INST|SYS|TURN)\]", body)
        assert marks in (["[INST]", "[/INST]"], ["[SYS]", "[/SYS]"], ["</s>"], ["[TURN]", "[/TURN]", "[/TURN]"])
    texts = ["", "<s>", "<\\s>", "<\\\\\\s>", "<<s>>", "[[INST]]", "[\\/INST]", "</s", "s>", "\\", "$1\\$2", "[SYS][/SYS]<s></s>", "a<s\\>b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", prefix_tree.escape(F.col("t")).alias("e"))
    for r in df.withColumn("u", prefix_tree.unescape(F.col("e"))).collect():
        assert r.u == r.t and not re.search(r"</?s>|\[/?(?:INST|SYS|TURN)\]", r.e)


def test_empty(spark):
    empty = prefix_tree.build(spark.createDataFrame([], SCHEMA))
    assert empty.nodes.count() == 0 and prefix_tree.read_back(empty).count() == 0


def test_sql_counts_escapes(spark, monkeypatch):
    """Control strings, escaped or not, in the texts of a table: SQL and query agree on every column."""
    import duckdb

    from entitylake.llm import queries
    from entitylake.llm.oracles import prefix_tree_sql

    rows = [r for r in ROWS if r[0] is not None]
    table = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *_: table)
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"turn": "Int64"}))
    want = {r[0]: tuple(r[1:]) for r in con.execute(prefix_tree_sql()).fetchall()}
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_prefix_tree"](spark, "").collect()}
    assert got == want
