"""Plain single-machine versions of the operators, used as expected results."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def smallest_reached(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, k):
    w = SPACE.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard_components(rows, k, num, den):
    """{doc_id: (set size, component)}"""
    sets = {i: shingle_set(t, k) for i, t in rows}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    edges = set()
    for i, s in sets.items():
        common = Counter(j for x in s for j in by_shingle[x] if j > i)
        edges |= {(i, j) for j, n in common.items() if den * n >= num * (len(s) + len(sets[j]) - n)}
    root = smallest_reached(sets, edges)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def cosine_links(rows, threshold=0.98):
    """{vec_id: (links, component, kept)}"""
    groups = defaultdict(list)
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            groups[label, len(v)].append((i, np.array(v, float)))
    links, edges = Counter(), []
    for g in groups.values():
        x = np.stack([v / np.linalg.norm(v) for _, v in g])
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[g[a][0]] += 1
                edges.append((g[a][0], g[b][0]))
    root = smallest_reached([r[0] for r in rows], edges)
    return {i: (links[i], root[i], root[i] == i) for i, _, _ in rows}


def unigram(rows, modulus=10):
    """{doc_id: (held out, tokens, known, train tokens, score)}"""
    words = {i: [*SPACE.findall(lower(t)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % modulus == 0 for i, _ in rows}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {
        i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for i, ws in words.items()
    }


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0


def pii(text):
    """Base spans (kind, start, end)."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def sha_of_spans(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def lines_kept(rows, chunks_of, long_words=50):
    """{doc_id: text} without the lines of repeated chunks and of repeated runs of ``long_words`` words; rows by id, pieces by first occurrence."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        found = {(a, b) for a, b, movable in chunks_of(text) if movable}
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(len(SPACE.findall(x)) for x in lines[a:b]) >= long_words:
                    found.add((a, b))
                    break
        for a, b in sorted(found):
            piece = "\n".join(lines[a:b])
            if piece in seen:
                gone.update(range(a, b))
            seen.add(piece)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def ctw_log10(train, text, depth=3):
    """log10 probability of a text's bytes: recursion over the full context tree, without pruning."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(data):
        data = b"\0" * depth + data
        for i in range(depth, len(data)):
            node = 1
            for bit in range(7, -1, -1):
                b = data[i] >> bit & 1
                yield data[i - depth : i], node, b
                node = 2 * node + b

    for t in train:
        for ctx, node, b in steps(t.encode()):
            for k in range(depth + 1):
                counts[ctx[depth - k :], node][b] += 1
                if k < depth:
                    children[ctx[depth - k :], node].add(ctx[depth - k - 1 :])

    def kt(s, node):
        a, b = counts[s, node] if (s, node) in counts else (0, 0)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - 2 * math.lgamma(0.5), (b + 0.5) / (a + b + 1)

    memo = {}

    def weighted(s, node):
        if (s, node) not in memo:
            own = kt(s, node)[0]
            if len(s) < depth:
                split = sum(weighted(c, node) for c in children[s, node])
                top = max(own, split)
                own = top + math.log(math.exp(own - top) + math.exp(split - top)) - math.log(2)
            memo[s, node] = own
        return memo[s, node]

    total = 0.0
    for ctx, node, b in steps(text.encode()):
        left, one = 1.0, 0.0
        for k in range(depth + 1):
            s = ctx[depth - k :]
            own, p = kt(s, node)
            if k == depth:
                one += left * p
                break
            stop = math.exp(own - math.log(2) - weighted(s, node))
            one, left = one + left * stop * p, left * (1 - stop)
        total += math.log10(one if b else 1 - one)
    return total


def sequential_viterbi(model, words, features, can_be_labelled):
    """Best labels of one text as one chain, word by word."""
    names, w = model["names"], model["w"]
    n = w.shape[1]
    fs = [features(x) for x in words]
    score = None
    back = []
    for k, word in enumerate(words):
        e = np.zeros(n)
        for side, feats in (("own", fs[k][0]), ("prev", fs[k - 1][1] if k else ()), ("next", fs[k + 1][1] if k + 1 < len(words) else ())):
            for f in feats:
                if f"{side} {f}" in names:
                    e += w[names[f"{side} {f}"]]
        if not can_be_labelled(word):
            e[1:] = -1e9
        if score is None:
            score = e + model["first"]
        else:
            through = score[:, None] + model["steps"]
            back.append(through.argmax(0))
            score = through.max(0) + e
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]
