"""Main text of web pages by a tree-structured graphical model.

A page's block elements and the runs of text in them are the nodes of a tree.
A node is boilerplate, content, or (elements only) a frame that holds both.
The model has a potential for each pair of a parent's and a child's label and
for each label and feature of a node (tag, words of its class, id and role,
length, share of link text, how it ends), all estimated from labelled pages by
smoothed counts.  One upward and one downward pass of sum-product messages give
every text's exact content marginal; texts above one half are the main text.

What a reader never sees (scripts, styles, head, comments of the markup) and
fields of forms are no nodes.  Line breaks and white space of any kind inside a
block become one space, blocks are joined by a blank line.

Defined cases: a null or empty page, or one without content, gives an empty
text; unclosed and misplaced tags are closed where a browser would close
paragraphs, list items and cells; a head without an end tag ends at the first
tag or text that may not stand in it; an svg or math element ends at a tag of
HTML that breaks out of it, and these and the other hidden elements end with the
block around them, but titles, scripts, styles, text areas, frames and templates
only at their own end tags; deep nesting and very long pages need no recursion;
repeated rows give repeated rows; a null url is kept."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable

BOILER, CONTENT, FRAME = 0, 1, 2

#: Elements that begin a block of their own.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre section summary table tbody td
tfoot th thead tr ul button""".split())
#: Elements whose inside is never text of the page.
HIDDEN = frozenset("head title script style template noscript iframe svg math canvas audio video object select textarea datalist".split())
#: Hidden elements that nothing but their own end tag closes; all but the last hold no tags.
SEALED = frozenset("title script style textarea iframe template".split())
#: Elements with an inside that may stand in a head, and those without.
HEAD_BLOCKS = frozenset("title script style noscript template noframes".split())
HEAD_VOID = frozenset("base basefont bgsound link meta".split())
#: Elements of other languages, the parts of them that hold HTML again, and the start tags that end them elsewhere.
FOREIGN = frozenset(("svg", "math"))
POINTS = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset("""b big blockquote br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu meta nobr ol p
pre ruby s small span strong strike sub sup table tt u ul var""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of its row, unless one of the second set is open in between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Power of a text's own features, which are many and alike within a block, against the names and tags around it.
TEXT_WEIGHT = 0.4
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)      # empty: text
    names: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)   # characters inside links
    mark: list[str] = field(default_factory=list)     # label of a training page's element


class _Open(list):
    """Open elements from the root on, (tag, node; -1 inside a hidden element),
    with how many there are of each, so that an end tag without its element costs
    no walk along them."""

    def __init__(self):
        super().__init__()
        self.here: Counter = Counter()  # of (tag, hidden)
        self.hidden = 0                 # the hidden ones are the last

    def push(self, tag: str, node: int) -> None:
        self.append((tag, node))
        self.here[tag, node < 0] += 1
        self.hidden += node < 0

    def cut(self, k: int) -> None:
        for tag, node in self[k:]:
            self.here[tag, node < 0] -= 1
            self.hidden -= node < 0
        del self[k:]

    def any(self, tags) -> bool:
        return any(self.here[t, False] or self.here[t, True] for t in tags)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = Tree()
        self.open = _Open()
        self.buffer: list[str] = []
        self.link = self.linked = 0
        self.add("html", (), "")
        self.open.push("html", 0)

    def add(self, tag: str, names: tuple[str, ...], mark: str, text: str = "") -> int:
        t = self.tree
        t.parent.append(self.open[-1][1] if self.open else -1)
        t.tag.append(tag)
        t.names.append(names)
        t.text.append(text)
        t.linked.append(self.linked if not tag else 0)
        t.mark.append(mark)
        return len(t.parent) - 1

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.add("", (), "", text)
            self.buffer = []
        self.link = self.linked = 0

    def visible(self) -> int:
        """Number of open elements around the outermost hidden one."""
        return len(self.open) - self.open.hidden

    def broken_out(self, tag: str) -> int:
        """Number of open elements that are left when ``tag`` starts in an element of another language."""
        left = k = len(self.open)
        while tag in BREAKOUT and self.open.any(FOREIGN) and self.open[k - 1][1] < 0 and self.open[k - 1][0] not in POINTS:
            k -= 1
            if self.open[k][0] in FOREIGN:
                left = k
            elif self.open[k][0] in HIDDEN:
                break
        return left

    def start_hidden(self, tag: str) -> bool:
        """Whether the start tag stands in a hidden element, once those that it ends are closed."""
        while self.open[-1][1] < 0:
            top = self.open[-1][0]
            if top == "head" and tag not in HEAD_BLOCKS | HEAD_VOID | {"head", "html"}:
                self.open.cut(len(self.open) - 1)
            elif (left := self.broken_out(tag)) < len(self.open):
                self.open.cut(left)
            else:
                if top == "head":
                    inner = tag in HEAD_BLOCKS
                else:  # blocks inside are kept, so that their end tags are not taken for those of blocks around
                    inner = (top not in SEALED or top == "template") and tag not in VOID and (
                        tag in HIDDEN or tag in BLOCKS or tag in POINTS or "-" in tag)
                if inner:
                    if top == "p" and tag in BLOCKS:
                        self.open.cut(len(self.open) - 1)
                    self.open.push(tag, -1)
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" and self.open.here["head", True]:
            self.open.cut(self.open.index(("head", -1)))
        if self.start_hidden(tag):
            return
        if tag in HIDDEN:
            self.open.push(tag, -1)
            return
        if tag not in BLOCKS and "-" not in tag:
            if tag == "br":
                self.buffer.append(" ")
            elif tag == "a":
                self.link += 1
            return
        self.flush()
        if tag in ("html", "body") and self.open.any((tag,)):
            return
        self.shut({"p"}, BLOCKS - {"p"})
        if tag in CLOSES:
            self.shut(*CLOSES[tag])
        if tag not in VOID:
            a = dict(attrs)
            names = " ".join(a.get(k) or "" for k in ("class", "id", "role", "itemprop"))
            words = tuple(dict.fromkeys(w.lower() for w in _NAME.findall(names))) if names.strip() else ()
            self.open.push(tag, self.add(tag, words, a.get("data-y") or ""))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN or self.open[-1] == (tag, -1) and tag in POINTS:
            self.handle_endtag(tag)

    def shut(self, tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        if not self.open.any(tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                self.flush()
                self.open.cut(k)
                return
            if self.open[k][0] in until:
                return

    def handle_endtag(self, tag: str) -> None:
        if self.open[-1][1] < 0:
            known = self.visible()
            if not self.open.here[tag, True] and any(self.open.here[x, True] for x in SEALED):
                return
            for k in range(len(self.open) - 1, known - 1, -1) if self.open.here[tag, True] else ():
                if self.open[k][0] == tag:
                    self.open.cut(k)
                    return
                if self.open[k][0] in SEALED:
                    return
            if tag not in BLOCKS and "-" not in tag or tag not in ("html", "body") and not self.open.here[tag, False]:
                return
            self.open.cut(known)
        if tag == "a":
            self.link = max(0, self.link - 1)
        elif tag in BLOCKS or "-" in tag:
            self.flush()
            if tag not in ("html", "body"):
                self.shut({tag}, frozenset())

    def handle_data(self, data: str) -> None:
        if self.open[-1] == ("head", -1) and data.strip():
            self.open.cut(len(self.open) - 1)
        if self.open[-1][1] >= 0:
            self.buffer.append(data)
            if self.link:
                self.linked += len(data)


def parse(html: str | None) -> Tree:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.open.cut(reader.visible())
    reader.flush()
    return reader.tree


def _stem(word: str) -> str:
    return f"stem {word[:4]}"


def _share(linked: int, chars: int) -> str:
    part = linked / chars if chars else 0
    return "none" if part == 0 else "some" if part < 0.3 else "half" if part < 0.8 else "all"


def features(tree: Tree) -> list[list[str]]:
    """Names of each node's features."""
    n = len(tree.parent)
    chars, linked, texts = [len(t) for t in tree.text], list(tree.linked), [not t for t in tree.tag]
    for i in range(n - 1, 0, -1):
        chars[tree.parent[i]] += chars[i]
        linked[tree.parent[i]] += linked[i]
        texts[tree.parent[i]] += texts[i]
    out = []
    for i in range(n):
        if tree.tag[i]:
            own = [f"tag {tree.tag[i]}"]
            if texts[i] > 1:  # a single text says so itself
                own.append(f"links {_share(linked[i], chars[i])}")
            own += [f"name {w}" for w in tree.names[i]]
        else:
            text = tree.text[i]
            words = text.count(" ") + 1
            own = [f"words {min(words.bit_length(), 6)}", f"linked {_share(linked[i], chars[i])}",
                   "end stop" if text[-1] in ".!?…\"”»" else "end other"]
            if text[0] == "©" or "©" in text:
                own.append("sign copyright")
        out.append(own)
    return out


@dataclass(frozen=True)
class TreeModel:
    step: dict[tuple[int, int, bool], float]      # (parent's label, child's label, child is text): probability
    root: tuple[float, float, float]
    seen: dict[str, tuple[float, float, float]]   # feature: likelihood under each label, up to a factor

    def evidence(self, own: list[str], is_text: bool) -> tuple[float, float, float]:
        e = [0.0, 0.0, 0.0]
        for f in own:
            p = self.seen.get(f)
            if p is None and f.startswith("name "):  # an unknown word counts as those that begin like it
                p = self.seen.get(_stem(f[5:]))
            if p:
                for y in (0, 1, 2):
                    e[y] += p[y]
        if is_text:
            top = max(e[0], e[1])
            return exp(e[0] - top), exp(e[1] - top), 0.0
        top = max(e)
        return exp(e[0] - top), exp(e[1] - top), exp(e[2] - top)


def marginals(tree: Tree, model: TreeModel) -> list[tuple[float, float, float]]:
    """P(label | page) of every node, by one upward and one downward pass."""
    n = len(tree.parent)
    parent = tree.parent
    inside = [list(model.evidence(f, not t)) for f, t in zip(features(tree), tree.tag)]  # evidence at and below a node
    step = {text: [[model.step[x, y, text] for y in (0, 1, 2)] for x in (0, 1, 2)] for text in (True, False)}
    up = [(1.0, 1.0, 1.0)] * n  # message to the parent
    for i in range(n - 1, 0, -1):
        b0, b1, b2 = inside[i]
        m0, m1, m2 = (s0 * b0 + s1 * b1 + s2 * b2 for s0, s1, s2 in step[not tree.tag[i]])
        top = max(m0, m1, m2) or 1.0
        up[i] = m = (m0 / top, m1 / top, m2 / top)
        p = inside[parent[i]]
        p0, p1, p2 = p[0] * m[0], p[1] * m[1], p[2] * m[2]
        top = max(p0, p1, p2)
        if top < 1e-100:  # keep the scale; all labels out only by underflow
            p0, p1, p2 = (p0 / top, p1 / top, p2 / top) if top else (1.0, 1.0, 1.0)
        p[0], p[1], p[2] = p0, p1, p2
    out = []
    for i in range(n):
        v0, v1, v2 = inside[i]
        if i:
            a0, a1, a2 = (x / m if m else 0.0 for x, m in zip(out[parent[i]], up[i]))  # the parent without this child
            (s00, s01, s02), (s10, s11, s12), (s20, s21, s22) = step[not tree.tag[i]]
            v0, v1, v2 = (v0 * (a0 * s00 + a1 * s10 + a2 * s20), v1 * (a0 * s01 + a1 * s11 + a2 * s21),
                          v2 * (a0 * s02 + a1 * s12 + a2 * s22))
        else:
            v0, v1, v2 = v0 * model.root[0], v1 * model.root[1], v2 * model.root[2]
        total = v0 + v1 + v2 or 1.0
        out.append((v0 / total, v1 / total, v2 / total))
    return out


def main_text(html: str | None, model: TreeModel) -> str:
    tree = parse(html)
    found = marginals(tree, model)
    return "\n\n".join(t for t, p, tag in zip(tree.text, found, tree.tag) if not tag and p[CONTENT] > 0.5)


def label_counts(html: str) -> Counter:
    """What training counts on one labelled page."""
    tree = parse(html)
    n = len(tree.parent)
    mark = list(tree.mark)
    for i in range(1, n):
        mark[i] = mark[i] or mark[tree.parent[i]]
    has = [mark[i] == "c" and not tree.tag[i] for i in range(n)]
    for i in range(n - 1, 0, -1):
        has[tree.parent[i]] |= has[i]
    label = [CONTENT if mark[i] == "c" else BOILER if mark[i] == "b" or not has[i] else FRAME for i in range(n)]
    counts: Counter = Counter()
    counts["root", str(label[0]), ""] += 1
    for i, own in enumerate(features(tree)):
        counts["label", str(label[i]), "text" if not tree.tag[i] else "element"] += 1
        for f in own:
            counts["feature", f, str(label[i])] += 1
        for w in tree.names[i]:
            if len(w) > 4:
                counts["feature", _stem(w), str(label[i])] += 1
        if i:
            counts["step", f"{label[tree.parent[i]]}{label[i]}", "text" if not tree.tag[i] else "element"] += 1
    return counts


def train(labelled: DataFrame, html: str = "html", smooth: float = 0.5) -> TreeModel:
    """Potentials from pages whose elements carry ``data-y`` marks.  Counts are
    summed by Spark; a row per tag, attribute word and label pair comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for h in b.column(0).to_pylist():
                total.update(label_counts(h or ""))
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in keys], pa.string()) for j in range(3)]
                                         + [pa.array([total[k] for k in keys], pa.int64())], ["kind", "a", "b", "n"])
    importable(labelled.sparkSession)
    rows = (labelled.select(F.col(html).cast("string").alias("html")).mapInArrow(run, "kind string, a string, b string, n long")
            .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).where("kind <> 'feature' OR n >= 2").collect())
    return fit({(r["kind"], r["a"], r["b"]): r["n"] for r in rows}, smooth)


def fit(counts: dict[tuple[str, str, str], int], smooth: float = 0.5) -> TreeModel:
    labels = (BOILER, CONTENT, FRAME)
    get = lambda *k: counts.get(k, 0)
    root = [get("root", str(y), "") + smooth for y in labels]
    step = {}
    for kind in ("text", "element"):
        for x in labels:
            row = [get("step", f"{x}{y}", kind) + (smooth if kind == "element" or y != FRAME else 0) for y in labels]
            for y in labels:
                step[x, y, kind == "text"] = row[y] / sum(row)
    seen = {}
    for f in {a for kind, a, _ in counts if kind == "feature"}:
        kind = "text" if f.split()[0] in ("words", "linked", "end", "sign") else "element"
        weight = TEXT_WEIGHT if kind == "text" else 1.0
        seen[f] = tuple(weight * log((get("feature", f, str(y)) + smooth) / (get("label", str(y), kind) + 2 * smooth)) for y in labels)
    return TreeModel(step, tuple(r / sum(root) for r in root), seen)


def extract(pages: DataFrame, model: TreeModel, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, then text string (the main text)."""
    importable(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = pages.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(b.column(b.num_columns - 1)[i].as_py(), shared.value) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])
    fields = ", ".join(f"`{c}` {k}" for c, k in kept.dtypes)
    return pages.select(*keep, F.col(html).cast("string").alias("_html")).mapInArrow(run, f"{fields}, text string")
