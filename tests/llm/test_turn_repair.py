"""Conversation repair against a search over all edit sequences and against the whole-string version."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from entitylake.llm import turn_repair
from entitylake.llm.queries import QUERIES, damaged
from tests.conftest import SF

LEGAL = re.compile(r"(s?(ua)+)?")


def fault_of(rows):
    out, seen = [], set()
    for role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_way(rows, inserts):
    """Least (cost, audit) by trying every edit of every row and every place for up to ``inserts`` insertions."""
    faults = fault_of(rows)
    options = []
    for (role, _), f in zip(rows, faults):
        own = [("D", 3, "")]
        if f not in ("blank", "duplicate"):
            more = f == "truncated"
            own += [("K", more, role[:1])] * bool(role) + [("R", 2 + more, "u"), ("R", 2 + more, "a")]
        options.append(own)
    best = None
    for n in range(inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for new in itertools.product([("I", 2, "u"), ("I", 2, "a")], repeat=n):
                for picked in itertools.product(*options):
                    edits, k = [], 0
                    for i in range(len(rows) + 1):
                        while k < n and places[k] == i:
                            edits.append(new[k])
                            k += 1
                        if i < len(rows):
                            edits.append(picked[i])
                    if LEGAL.fullmatch("".join(e[2] for e in edits)):
                        way = sum(e[1] for e in edits), "".join(e[0] for e in edits)
                        best = way if best is None else min(best, way)
    return best


def whole_strings(rows):
    """(cost, audit, repaired turns): least pair per state, all edits kept as strings."""
    nxt = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    given = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def inserted(ways):
        for _ in range(4):
            for s in list(ways):
                c, a, out = ways[s]
                role, to = given[s]
                way = c + 2, a + "I", out + ((role, ""),)
                ways[to] = min(ways.get(to, way), way)
        return ways

    ways = inserted({0: (0, "", ())})
    for (role, text), f in zip(rows, fault_of(rows)):
        new = {}

        def offer(s, way):
            new[s] = min(new.get(s, way), way)

        for s, (c, a, out) in ways.items():
            offer(s, (c + 3, a + "D", out))
            if f not in ("blank", "duplicate"):
                c += f == "truncated"
                if role[:1] in nxt[s]:
                    offer(nxt[s][role[:1]], (c, a + "K", out + ((role, text),)))
                offer(given[s][1], (c + 2, a + "R", out + ((given[s][0], text),)))
        ways = inserted(new)
    return min(ways[s] for s in (0, 3) if s in ways)


def plain(rows):
    """Digest columns of sorted (turn, role, text)."""
    turns = {t for t, _, _ in rows if t is not None}
    said = [(r, x) for _, r, x in rows]
    f = fault_of(said)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, out = whole_strings(said)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, sha


def plain_damage(rows):
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        k = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in plain_damage(rows):
        by[conv].append((turn, role, text))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {c: plain(sorted(by[c], key=key)) if by[c] else nothing for c in {r[0] for r in rows}}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_turn_repair"](spark, SF).collect()}
    assert got == expected(rows)


def test_whole_strings_find_the_best_of_every_way():
    roles, texts = ["user", "assistant", "system", "tool", "u2", ""], ["Fine.", "cut", "", "Ok!", " \t"]
    rng = random.Random(4)
    for _ in range(60):
        rows = [(rng.choice(roles), rng.choice(texts) + rng.choice(["", "", " x."])) for _ in range(rng.randint(0, 3))]
        assert whole_strings(rows)[:2] == every_way(rows, 3), rows


def search(rows):
    s, out = turn_repair.Search(), []
    held = 0
    for (role, text), f in zip(rows, fault_of(rows)):
        out += s.step(role, f, (None, role, text, f))
        held = max(held, max(e.depth for _, e in s.live.values()) - s.root.depth)
    cost, rest = s.end()
    out += rest
    return (cost, "".join(e.letter for e in out), tuple(e.row[1:3] for e in out if e.letter != "D")), held


def test_search_equals_whole_strings():
    rng = random.Random(7)
    for n in range(400):
        pool = rng.sample(["user", "assistant", "system", "tool", "x", "", "us"], rng.randint(1, 7))
        rows = [(rng.choice(pool), rng.choice(["a.", "b", "", f"{i}?", f"{i}", " "])) for i in range(rng.randint(0, 40))]
        assert search(rows)[0] == whole_strings(rows), rows


def test_memory_follows_what_is_unsettled():
    rows = [("user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(20_000)]
    (cost, audit, _), held = search(rows)
    assert (cost, audit) == (0, "K" * 20_000) and held < 20


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (1, 0, "user", "a."), (1, None, None, None), (1, None, "system", "s."), (1, 9, "assistant", "b."), (1, 9, "assistant", "b."), (1, 4, "", "x."),
        (2, None, None, "x"), (3, 0, "assistant", ""), (None, 0, "user", "n."), (None, 1, "assistant", "m."), (4, -5, "user", "é" * 50_000 + "."), (4, 5, "assistant", " ."),
        (5, 1, "user", ".!?"), *[(6, i, ["user", "assistant", "system", "tool"][i * i % 7 % 4], f"t{i}" + "." * (i % 3)) for i in range(3_000)],
    ]
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("kind", "fault", "again", "body", "copy", "seq", "edit", "found_id")})
    key = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: plain(sorted(v, key=key)) for c, v in by.items()}
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turn_repair.digests(df).collect()} == want
    fixed = defaultdict(list)
    for r in turn_repair.repaired(df).orderBy("seq").collect():
        fixed[r.conv_id].append((r.role, r.text))
    for c, v in want.items():
        assert LEGAL.fullmatch("".join(r[:1] for r, _ in fixed[c]))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for r, x in fixed[c]).encode()).hexdigest() == v[-1]
    assert turn_repair.repair(df.filter("false")).count() == 0 and turn_repair.digests(df.filter("false")).count() == 0
    assert sorted(map(str, damaged(df).select("conv_id", "turn", "role", "text").collect())) == sorted(
        str(r) for r in spark.createDataFrame(list(plain_damage(rows)), schema).collect()
    )


@pytest.mark.parametrize("rows, way", [([], (0, "")), ([("system", "s.")], (3, "D")), ([("tool", "t.")], (3, "D")), ([("user", "a.")], (2, "KI")), ([("user", "a")], (3, "D"))])
def test_small_cases(rows, way):
    assert search(rows)[0][:2] == way == every_way(rows, 3)
