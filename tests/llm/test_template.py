"""HTML extraction against a template deduction on whole trees with explicit occurrence vectors."""

import random
from collections import defaultdict
from html.parser import HTMLParser

import pytest

from entitylake.llm import html_template
from entitylake.llm.queries import QUERIES
from tests.conftest import SF

BLOCKS = {"html", "body", "div", "section", "article", "main", "p", "h1", "h2", "ul", "li", "nav", "header", "footer", "aside", "table", "tr", "td"}
GONE = {"head", "script", "style", "nav", "footer", "aside", "form", "title", "button"}


class Tree(HTMLParser):
    """Nodes (tag, path, furniture, parent, children); texts are children of their own."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = self.at = {"tag": "", "path": "", "gone": False, "up": None, "kids": [], "block": ""}
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.at["kids"].append({"text": " ", "up": self.at})
            return
        if tag in BLOCKS:  # a block ends an open paragraph
            while self.at["tag"] == "p" or (tag == "li" == self.at["tag"]):
                self.at = self.at["up"]
        a = dict(attrs)
        name = f"{a.get('class', '')} {a.get('id', '')}".split()
        path = f"{self.at['path']}/{tag}.{' '.join(sorted(name))}"
        gone = self.at["gone"] or tag in GONE or bool({"ad", "sidebar", "comments", "cookie-notice"} & set(name)) or (tag == "header" and "/article" not in path and "/main" not in path)
        node = {"tag": tag, "path": path, "gone": gone, "up": self.at, "kids": [], "block": path if tag in BLOCKS else self.at["block"]}
        self.at["kids"].append(node)
        if tag not in ("meta", "img", "input", "link", "hr"):
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node["up"] is not None and node["tag"] != tag:
            node = node["up"]
        if node["up"] is not None:
            self.at = node["up"]

    def handle_data(self, text):
        self.at["kids"].append({"text": text, "up": self.at})


def walk(node):
    for kid in node["kids"]:
        yield kid
        if "text" not in kid:
            yield from walk(kid)


def plain(pages):
    """{page_id: text} of the pages of one host; all different."""
    trees = {i: Tree(p).root for i, p in pages.items()}
    ids, vector, of = sorted(trees), defaultdict(lambda: [0] * len(trees)), {}
    texts_in, elements = defaultdict(list), {}
    for k, i in enumerate(ids):
        for n in walk(trees[i]):
            if "text" not in n:
                vector[n["path"]][k] += 1
                elements[n["path"]] = n
            elif n["text"].split() and not n["up"]["gone"]:
                token = n["up"]["path"], " ".join(n["text"].split())
                vector[token][k] += 1
                texts_in[n["up"]["block"]].append(token)
    valid = {t: tuple(v) for t, v in vector.items() if 2 * sum(map(bool, v)) >= len(ids)}
    fixed = set()
    for block, tokens in texts_in.items():
        above, node = set(), elements.get(block)
        while node is not None and node["path"]:
            above.add(valid.get(node["path"]))
            node = node["up"]
        if all(t in valid and valid[t] in above and sum(map(bool, valid[t])) >= html_template.LEAST for t in tokens):
            fixed.add(block)
    length = defaultdict(int)  # slot text below each element
    for path, e in elements.items():
        for t, v in vector.items():
            if isinstance(t, tuple) and t[0] == path and not (len(ids) > 1 and t in valid):
                p = e
                while p is not None and p["path"]:
                    length[p["path"]] += len(t[1]) * sum(v)
                    p = p["up"]

    def once(path):
        return path in valid and max(valid[path]) == 1 and not elements[path]["gone"]

    named = [p for p in elements if elements[p]["tag"] == "article" and once(p) and length[p]]
    at = named[0] if len(named) == 1 else ""
    if not at:
        while True:
            kids = {p for p, e in elements.items() if p in valid and e["up"]["path"] == at}
            best = max(kids, key=lambda p: length[p], default=None)
            whole = length[at] if at else sum(length[p] for p, e in elements.items() if not e["up"]["path"])
            if best is None or not once(best) or not length[best] or length[best] < html_template.MOST * whole:
                break
            at = best

    def blocks(node, out):
        for kid in node["kids"]:
            if "text" in kid:
                if not kid["up"]["gone"] and kid["up"]["block"] not in fixed:
                    out[-1] += kid["text"]
            else:
                if kid["tag"] in BLOCKS:
                    out.append("")
                blocks(kid, out)
                if kid["tag"] in BLOCKS:
                    out.append("")
        return out

    got = {}
    for i in ids:
        found = [n for n in walk(trees[i]) if n.get("path") == at] if at else [trees[i]]
        got[i] = "\n\n".join(x for n in found for b in blocks(n, [""]) if (x := " ".join(b.split())))
    return got


def test_query(spark):
    pages = defaultdict(dict)
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        pages[r.url.split("://")[1].split("/")[0]][r.page_id] = r.html
    got = {r.page_id: r.text for r in QUERIES["op10_html_extraction"](spark, SF).collect()}
    alone = {i: plain({i: p})[i] for host in pages.values() for i, p in host.items()}
    together = {i: x for host in pages.values() for i, x in plain(host).items()}
    assert got.keys() == alone.keys() and all(got[i] in (together[i], alone[i]) for i in got)


@pytest.mark.parametrize("seed", range(4))
def test_neutral_names(spark, seed):
    """Pages whose markup tells nothing: the template is what comes and goes together."""
    rng = random.Random(seed)
    word = lambda n: " ".join(rng.choice(["sun", "sea", "hill", "road", "wind", "tree", "stone", "bird"]) + str(rng.randrange(99)) for _ in range(n))
    menu = "<div class=a><ul>" + "".join(f"<li><i>Entry {k}</i></li>" for k in range(4)) + "</ul></div>"
    tail = "<div class=b><p>All rights reserved by somebody</p></div>"
    box = "<div class=c><p>Sign the petition today</p><p>It is free</p></div>"
    pages = {}
    for i in range(9):
        body = "".join(f"<p>{word(12)}</p>" for _ in range(rng.randint(2, 5)))
        some = box if rng.random() < 0.7 else ""
        pages[i] = f"<html><body>{menu}<div class=m><h1>{word(4)}</h1>{body}{some}<p>{word(9)} <b>bold</b> end</p></div>{tail}</body></html>"
    df = spark.createDataFrame([(i, f"http://n{seed}.org/{i}", p) for i, p in pages.items()], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.main_texts(df).collect()}
    assert got == plain(pages)
    assert not any(x in t for t in got.values() for x in ("Entry", "rights", "petition")) and all("bold end" in t for t in got.values())


def test_the_article_among_teasers(spark):
    page = "<body><article class=teaser><p>Read {0} next</p></article><article><h1>Story {0}</h1><p>{1}</p></article></body>"
    rows = [(i, f"http://t.org/{i}", page.format(i, f"long text {i} " * 20)) for i in range(5)]
    got = {r.page_id: r.text for r in html_template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i}\n\n" + ("long text %d " % i * 20).strip() for i in range(5)}
