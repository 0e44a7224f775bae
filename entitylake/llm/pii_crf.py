"""Personal data: fixed patterns, and a linear-chain CRF over word shapes that adds to them.

The patterns (email, ip, card, phone) give the base spans.  Beside them a conditional random
field labels every word of every text (begin and inside of each kind, or outside).  Its
features are the word's shape, attributes of the shape, and the attributes of both
neighbours; a word without digit, ``@``, ``+`` or ``(`` can only be outside, which is part of the model,
in training and in decoding.  It is trained by gradient ascent on the exact likelihood of a
small labelled table and decoded by Viterbi.  The forced words cut a text into short independent
chains, which are decoded together in numpy batches; the result is that of one chain per text.

A labelled run of words, without enclosing punctuation, is added as a span when it passes the
kind's check (an address, four parts up to 255, 16-19 digits with a Luhn sum, 8-15 digits of a
phone) and does not overlap a base span.

Scale: one pass without a shuffle; the model is a few kilobytes.  Patterns are written so that each is
linear in the text's length, whatever it holds.

Defined results: null and empty texts have no spans; positions are code points, end exclusive;
repeated rows are judged alike; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.bytetext import WHITE_SPACE, batch_column, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Labelled sentences: ``[kind|text]`` marks a span.  The small table from which the default model is trained.
LABELLED = """
write to [email|anna.berg@mail.example.com] before noon
his address is [email|jo_34@post7.example.org].
mail ([email|x.y+z@a-b.example.net]) or call
contact: <[email|info@example.com]>
from [email|k9@example.co], to [email|sales.team@shop.example.com];
the host [ip|192.168.10.24] did not answer
ping [ip|8.8.4.4] and [ip|10.0.0.254], please
server at [ip|233.254.104.120].
blocked ([ip|64.147.79.24]) again
paid with [card|4111 1111 1111 1111] on Monday
card [card|5500-0000-0000-0004], valid
number [card|4012888888881881].
cards [card|4111111111111111] [card|5105105105105100] listed
pan [card|6011.1111.1111.1117] stored
call [phone|+1 (743) 555-3824] today
phone [phone|+44 20 7946 0958], office
tel. [phone|+49-30-901820]
dial [phone|(743) 555-3824] now
ring [phone|(017) 555-7713], ask
fax [phone|743-555-3824] or write
mobile [phone|555.382.7713].
home [phone|(20) 7946-0958] evenings
call [phone|+1 (136) 555-7479]%%% soon
reach us: [phone|(604) 555-0199] or [email|desk@example.org]
version 3.0 of the license
Licensed under CC BY-NC 4.0.
section 1.2.3 and 1.2.3.4.5 follow
on 2024-01-15 at 10:30 we met
from 1999-2003 and 12/05/2021
order 1234567890 was shipped
invoice 20240115 with 12 items
token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" stays
key: b44e15e09fd311c3cf3163b66d5a9875
a total of 12,500.00 in 2023
chapter 4 (page 17) and (12) more
see [1] and (3) or +5 points
rated 5 of 10, 300 people
300.400.500.600 is no address
the 2nd (b) part, 42% of 7
@someone wrote + nothing
3 + 4 = 7 and (x+y)
ISBN 978-3-16-148410-0 printed
between 100-200 and 3000-4000
room 12-34, floor 5-6
plain words only, nothing else here
cell [phone|743.555.3824] or [phone|(136) 555-7479]
call [phone|604-555-0199] after six
her number: [phone|252.555.8630], his [phone|017-555-7713]
office [phone|743-555-0100], ext. 12
fax no. [phone|20-7946-0958]
text [phone|555-382-7713] for help
numbers [phone|(252) 555-8630] [phone|(604) 555-0123] both work
two cards, [card|4111111111111111] and [card|5500000000000004]
pans [card|4012888888881881] [card|4111111111111111] leaked
cards: [card|5105105105105100], [card|4111111111111111]
stored as [card|4111.1111.1111.1111] in the log
old card [card|5500/0000/0000/0004] replaced
[email|max@mail.example.com], [email|eva@mail.example.com] wrote
route [ip|10.1.2.3] via [ip|10.0.0.1]
due 2024-03-31, paid 2024-04-02
between 2023-12-24 and 2024-01-06 closed
2021-06-30 to 2021-07-04 in week 26
at 12.30.2021 and 31.12.2021
version 2.4.10-beta and 10.15.7 run
part no. 555-0199-A and 20-30-40
sizes 10x20x30, 100-200-300 mm
"""


# --- patterns ---------------------------------------------------------------------
def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    return 16 <= len(d := _digits(text)) <= 19 and luhn(d)


def _is_phone(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``: the run of address characters before it (not before the last match), then the domain."""
    done = before = 0
    at = text.find("@")
    while at >= 0:
        low = max(done, before)
        start = low + len(text[low:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        before = at + 1
        at = text.find("@", before)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    for kind, pattern, check in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if check(m[0])]
    return out


# --- features ---------------------------------------------------------------------
TRIM_LEFT, TRIM_RIGHT = "\"'<([{", ".,;:!?\"'>)]}%*#$&"


def _bucket(n: int) -> str:
    return str(n) if n <= 4 else "7" if n <= 7 else "11" if n <= 11 else "15" if n <= 15 else "19" if n <= 19 else "99"


def attributes(word: str) -> list[str]:
    """Attributes of a word's shape; these also describe it to its neighbours."""
    core = word.rstrip(TRIM_RIGHT)
    digits, letters = sum(c.isdigit() for c in core), sum(c.isalpha() for c in core)
    dots = core.count(".")
    out = [f"digits={_bucket(digits)}", f"letters={min(letters, 2)}", f"first={'+' if core[:1] == '+' else '(' if core[:1] == '(' else 'other'}"]
    out.append(f"quad={dots == 3 and digits > 3 and not letters and all(0 < len(p) <= 3 for p in core.split('.'))}")
    out.append(f"address={'@' in core[1:-1] and '.' in core.rpartition('@')[2]}")
    out.append(f"dashes={min(core.count('-'), 3)}")
    out.append(f"dots={min(dots, 4)}")
    out.append(f"paren={'(' in word}{')' in word}")
    return out


def shape(word: str) -> str:
    """Runs of letters as x, of digits as 9 with their length's bucket, other characters as they are."""
    runs = re.sub(r"[^\W\d_]+", "x", word.rstrip(TRIM_RIGHT))
    return re.sub(r"\d+", lambda m: f"9{{{_bucket(len(m[0]))}}}", runs)[:40]


def can_be_labelled(word: str) -> bool:
    return any(c in "0123456789@+(" for c in word)


def features(word: str) -> tuple[list[str], list[str]]:
    """``(own features, features shown to neighbours)``."""
    if not can_be_labelled(word):
        return ["word"], ["word"]
    attrs = attributes(word)
    return [f"shape={shape(word)}", *attrs], attrs


def parse_labelled(lines: list[str]) -> list[tuple[list[str], list[int]]]:
    """Words and label numbers of sentences with ``[kind|text]`` marks."""
    out = []
    for line in lines:
        spans, plain = [], ""
        for part in re.split(r"(\[(?:email|ip|card|phone)\|[^\]]*\])", line):
            m = re.fullmatch(r"\[(\w+)\|([^\]]*)\]", part)
            if m:
                spans.append((len(plain), len(plain) + len(m[2]), m[1]))
            plain += m[2] if m else part
        words, labels = [], []
        for w in re.finditer(r"\S+", plain):
            hit = next(((a, b, k) for a, b, k in spans if a < w.end() and w.start() < b), None)
            words.append(w[0])
            labels.append(0 if hit is None else LABELS.index(("B-" if w.start() <= hit[0] else "I-") + hit[2]))
        if words:
            out.append((words, labels))
    return out


# --- the model --------------------------------------------------------------------
def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Log-domain masks: label to label, and start to label (inside only after begin or inside of its kind)."""
    n = len(LABELS)
    step = np.zeros((n, n))
    for j, to in enumerate(LABELS):
        if to[0] == "I":
            for i, fr in enumerate(LABELS):
                if fr[1:] != to[1:]:
                    step[i, j] = -1e9
    return step, step[0].copy()


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(sentences: list[tuple[list[str], list[int]]], steps: int = 400, rate: float = 0.5, l2: float = 0.01) -> dict:
    """Maximum likelihood with an L2 prior, by AdaGrad on the exact gradient (forward-backward over all sentences at once)."""
    names: dict[str, int] = {}
    for words, _ in sentences:
        for own, shown in map(features, words):
            for f in own:
                names.setdefault(f"own {f}", len(names))
            for f in shown:
                names.setdefault(f"prev {f}", len(names))
                names.setdefault(f"next {f}", len(names))
    s, t, y = len(sentences), max(len(w) for w, _ in sentences), len(LABELS)
    x = np.zeros((s, t, len(names)))
    gold, real, free = np.zeros((s, t), int), np.zeros((s, t), bool), np.zeros((s, t), bool)
    for i, (words, labels) in enumerate(sentences):
        fs = [features(w) for w in words]
        for k, w in enumerate(words):
            for f in fs[k][0]:
                x[i, k, names[f"own {f}"]] = 1
            for f in fs[k - 1][1] if k else ():
                x[i, k, names[f"prev {f}"]] = 1
            for f in fs[k + 1][1] if k + 1 < len(words) else ():
                x[i, k, names[f"next {f}"]] = 1
            gold[i, k], real[i, k], free[i, k] = labels[k], True, can_be_labelled(w)
    step, first = _allowed()
    forced = np.where(free[:, :, None] | (np.arange(y) == 0), 0.0, -1e9)  # also pads sentences with outside words
    w, tr = np.zeros((len(names), y)), np.zeros((y, y))
    sum_w, sum_t = np.full_like(w, 1e-8), np.full_like(tr, 1e-8)
    gold_x = np.einsum("stf,sty->fy", x, np.eye(y)[gold] * real[:, :, None])
    gold_t = np.einsum("sti,stj->ij", np.eye(y)[gold[:, :-1]] * real[:, 1:, None], np.eye(y)[gold[:, 1:]] * real[:, 1:, None])
    for _ in range(steps):
        e = x @ w + forced
        m = tr + step
        fw, bw = np.zeros((s, t, y)), np.zeros((s, t, y))
        fw[:, 0] = e[:, 0] + first
        for k in range(1, t):
            moved = _logsum(fw[:, k - 1][:, :, None] + m, 1) + e[:, k]
            fw[:, k] = np.where(real[:, k, None], moved, fw[:, k - 1])
        for k in range(t - 2, -1, -1):
            moved = _logsum(m[None] + (e[:, k + 1] + bw[:, k + 1])[:, None, :], 2)
            bw[:, k] = np.where(real[:, k + 1, None], moved, bw[:, k])
        z = _logsum(fw[:, -1], 1)
        p = np.exp(fw + bw - z[:, None, None]) * real[:, :, None]
        pair = fw[:, :-1, :, None] + m + (e + bw)[:, 1:, None, :] - z[:, None, None, None]
        pt = (np.exp(np.minimum(pair, 0)) * real[:, 1:, None, None]).sum((0, 1))
        gw = gold_x - np.einsum("stf,sty->fy", x, p) - l2 * w
        gt = gold_t - pt - l2 * tr
        sum_w += gw * gw
        sum_t += gt * gt
        w += rate * gw / np.sqrt(sum_w)
        tr += rate * gt / np.sqrt(sum_t)
    return {"names": names, "w": w, "steps": tr + step, "first": first}


def labelled_table(spark: SparkSession) -> DataFrame:
    """The default training table: one marked sentence per row."""
    return spark.createDataFrame([(x,) for x in LABELLED.strip().split("\n")], "sentence string")


def train_table(labelled: DataFrame, most_rows: int = 10_000) -> dict:
    """From a table of marked sentences (column ``sentence``), of which the first ``most_rows`` in text order are used."""
    rows = labelled.select("sentence").filter("sentence is not null").orderBy("sentence").limit(most_rows).collect()
    return train(parse_labelled([r[0] for r in rows]))


def viterbi(model: dict, scores: np.ndarray) -> np.ndarray:
    """Best labels of chains of one length: ``scores`` is chains x words x labels."""
    n, t, y = scores.shape
    back = np.zeros((n, t, y), np.int8)
    best = scores[:, 0] + model["first"]
    for k in range(1, t):
        through = best[:, :, None] + model["steps"]
        back[:, k] = through.argmax(1)
        best = through.max(1) + scores[:, k]
    out = np.zeros((n, t), np.int64)
    out[:, -1] = best.argmax(1)
    for k in range(t - 1, 0, -1):
        out[:, k - 1] = back[np.arange(n), k, out[:, k]]
    return out


class Labeller:
    """Labels the words of a batch; emission scores of a word's kind are computed once and kept."""

    def __init__(self, model: dict):
        self.model, self.kinds, self.rows = model, {}, []
        self._kind("word")  # kind 0: words that can only be outside

    def _kind(self, word: str) -> int:
        own, shown = features(word)
        key = (*own, "|", *shown)
        if key not in self.kinds:
            names, w = self.model["names"], self.model["w"]
            total = [sum((w[names[f"{side} {f}"]] for f in fs if f"{side} {f}" in names), np.zeros(len(LABELS))) for side, fs in (("own", own), ("prev", shown), ("next", shown))]
            self.kinds[key] = len(self.rows)
            self.rows.append(np.array(total))
        return self.kinds[key]

    def __call__(self, words: list[str], at: np.ndarray, n_words: int, first: np.ndarray) -> np.ndarray:
        """Labels of the words at positions ``at`` (those that can be labelled) of ``n_words`` words; ``first``: documents' first words."""
        kind = np.zeros(n_words + 2, np.int64)  # one outside word at each end
        kind[at + 1] = [self._kind(w) for w in words]
        table = np.array(self.rows)
        before, after = table[kind[at], 1], table[kind[at + 2], 2]
        before[np.isin(at, first[:-1])] = 0  # a text's ends have no neighbour
        after[np.isin(at + 1, first[1:])] = 0
        score = table[kind[at + 1], 0] + before + after
        breaks = np.concatenate([[True], (np.diff(at) != 1) | np.isin(at[1:], first)])
        starts = np.flatnonzero(breaks)
        length = np.diff(np.append(starts, len(at)))
        labels = np.zeros(len(at), np.int64)
        for n in np.unique(length):
            rows = starts[length == n][:, None] + np.arange(n)
            labels[rows] = viterbi(self.model, self._after_outside(score[rows], starts[length == n], at, first))
        return labels

    def _after_outside(self, score: np.ndarray, starts: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Adds the steps from the outside word before a chain and to the one behind it."""
        score = score.copy()
        n = score.shape[1]
        head = ~np.isin(at[starts], first[:-1])
        tail = ~np.isin(at[starts + n - 1] + 1, first[1:])
        score[head, 0] += self.model["steps"][0] - self.model["first"]
        score[tail, -1] += self.model["steps"][:, 0]
        return score


CHECKS = {
    "email": lambda x: x.rfind("@") > 0 and DOMAIN.fullmatch(x, x.rfind("@") + 1) is not None,
    "ip": lambda x: IP.fullmatch(x) is not None and _is_ip(x),
    "card": _is_card,
    "phone": _is_phone,
}


def added_spans(words: list[tuple[int, str, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``words``: (start, word, label) of labelled words in order.  Spans that pass their check and overlap no base span."""
    runs: list[list] = []
    for start, word, label in words:
        if label == 0:
            runs.append([])
        elif LABELS[label][0] == "B" or not runs or not runs[-1]:
            runs.append([(start, word, LABELS[label][2:])])
        else:
            runs[-1].append((start, word, LABELS[label][2:]))
    out = []
    for run in filter(None, runs):
        (a, head, kind), (b, tail, _) = run[0], run[-1]
        end = b + len(tail.rstrip(TRIM_RIGHT))
        lead = TRIM_LEFT.replace("(", "") if kind == "phone" else TRIM_LEFT
        start = a + len(head) - len(head.lstrip(lead))
        text = " ".join(w for _, w, _ in run)
        core = text.lstrip(lead).rstrip(TRIM_RIGHT)
        if start < end and CHECKS[kind](core) and not any(x < end and start < y for _, x, y in base):
            out.append((kind, start, end))
    return out


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_labelled long, n_added long"


def find(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, base counts by kind, base_sha256, spans (base and added), words labelled by the model, spans added."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train_table(labelled_table(spark) if labelled is None else labelled))
    marked = np.zeros(256, bool)
    marked[[ord(c) for c in "0123456789@+("]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(shared.value)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            ids = batch_column(batch, "doc_id")
            for a, b, data, off in slices(batch_column(batch, "text")):
                n = b - a
                base_of: dict[int, list] = {}
                words_of: dict[int, list] = {}
                hit = np.flatnonzero(marked[data])
                if len(hit):
                    word = ~WHITE_SPACE[data]
                    edge = np.zeros(len(data) + 1, bool)
                    edge[off] = True
                    begins = word.copy()
                    begins[1:] &= ~word[:-1] | edge[1:-1]
                    start = np.flatnonzero(begins)
                    at = np.unique(np.searchsorted(start, hit, "right") - 1)
                    doc = np.searchsorted(off, start[at], "right") - 1
                    first = np.searchsorted(start, off)
                    texts = {int(d): data[off[d] : off[d + 1]].tobytes() for d in np.unique(doc)}
                    found = []
                    for k, d in zip(start[at], doc):
                        raw = texts[int(d)]
                        m = WORD.match(raw, int(k - off[d]))
                        found.append(m[0].decode("utf-8", "replace"))
                    labels = label(found, at, len(start), first)
                    for k, d, w, y in zip(start[at], doc, found, labels):
                        words_of.setdefault(int(d), []).append((int(k - off[d]), w, int(y)))
                    for d, raw in texts.items():
                        base_of[d] = base_spans(raw.decode("utf-8", "replace"))
                        if any(y for _, _, y in words_of[d]):
                            to_point = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
                            words_of[d] = [(int(to_point[k]), w, y) for k, w, y in words_of[d]]
                out = []
                for d in range(n):
                    base = base_of.get(d)
                    if base is None:
                        out.append((0, 0, 0, 0, nothing, "", 0, 0))
                        continue
                    n_labelled = sum(y > 0 for _, _, y in words_of[d])
                    added = added_spans(words_of[d], base) if n_labelled else []
                    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                    out.append((*counts, hashlib.sha256(_join(base).encode()).hexdigest(), _join(base + added), n_labelled, len(added)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, n), *columns], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_labelled", "n_added"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)


WORD = re.compile(rb"[^\x20\x09-\x0D]+")
