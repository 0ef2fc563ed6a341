"""HTML extraction by wrapper induction.

Pages of one host are aligned by simple tree matching into a wrapper: a tree of
block elements in which every node counts the pages, characters, link characters
and most frequent texts it met. Each task merges its own pages into one wrapper
per host; those are merged in two steps, so a host with a third of all pages
moves a few small trees and no page. Nodes whose text is the same on most
(different) pages are template; varying nodes are slots. A slot is content
unless its name or role marks it as navigation, header, footer, sidebar, notice,
advert, form or reader comments, or nearly all its text on the host is links.
Names that also occur in articles (``menu-item``, ``related-work``, ``alert-level``)
are only a prior: such a part goes if at least half of its pages agree on its text
or half of its text is links, else it stays. Advert words on inline elements hide these.
The host's decisions hold on every page. An article (or main) that a page marks is
evidence: where it has at least half of the text that is left, it is the content,
else all content slots are.

Null or empty html gives the empty text. A url without a host, or null, belongs
to the host "". Long pages are read whole; blocks deeper than DEPTH are
flattened into their ancestor as blocks of text, except for the first article or
marked part there. Repeated rows are pages of their own
but count once in their host's wrapper. An empty table gives an empty result. Extra columns are ignored.

Alignment numbers equal subtrees, matches each pair of different ones once, leaves
equal ends of two child lists out and divides the rest, so two lists of m and n
children take m times n steps of vectors and memory for m plus n. Nodes met on fewer
than one in ``RARE`` of a host's pages leave the wrapper; what they hold is content.
A node keeps its ``KEPT_TEXTS`` most frequent texts; one is only lost where it is on
at most one in nine of the pages merged so far.
"""

from __future__ import annotations

import json
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table

#: Elements that start and end a block, elements without content, elements whose text is never shown.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("audio canvas datalist head iframe math noembed noframes noscript object rp script style svg template textarea title video".split())
#: An opening element on the left ends open elements on the right.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: The same for hidden elements, where also a part of a table ends the rows before it; elements that may stand in a head.
HIDDEN_ENDS = {**ENDS, **dict.fromkeys(("tbody", "thead", "tfoot"), {"tr", "td", "th", "tbody", "thead", "tfoot"})}
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
SCOPES = {"ul", "ol", "menu", "table", "dl", "select", "td", "th", "article", "section", "div", "body"}
#: Elements, roles and words in class or id that mark a part as not being the article.
ASIDE_TAGS = frozenset("nav footer aside form menu select button dialog search fieldset option".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar "
    "masthead topbar footer bottombar sidebar aside widget related recommended trending "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "share sharing social comment comments commentlist disqus reply replies respond skiplink copyright".split()
)
LAYOUT_WORDS = frozenset("has have with without no not hide show open closed enabled disabled".split())
HEADER_WORDS = frozenset("header head siteheader pageheader".split())
#: Words that name parts of articles too, words that name a part's place or kind, advert words for inline elements.
PRIOR_WORDS = frozenset(
    "menu related recommended trending alert notice notices notification social share sharing reply replies respond copyright login discussion promotion".split()
)
PART_WORDS = frozenset(
    "site page main global top bottom left right center box block section area container wrapper wrap inner outer body content list links link "
    "post posts article articles story stories news unit slot bar panel primary secondary button buttons icon icons media toggle label text title "
    "message info warning success danger form mobile desktop sticky fixed".split()
)
INLINE_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo".split())

DEPTH = 64
#: Stands where a flattened block starts or ends.
BREAK = ("\n", False)
KEPT_TEXTS = 8
CONSTANT = 0.8
LINKS = 0.8
PRIOR = 0.5
MIN_PAGES = 5
RARE = 1000
#: The first merge of a host's trees is dealt over so many groups, the second merges their results.
PARTS = 1024
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "label", "marked", "prior", "items", "within")

    def __init__(self, tag: str, label: str, mark: int, within: frozenset = frozenset()):
        marked = mark == 2
        self.tag, self.label, self.marked, self.prior, self.items = tag, label, marked, mark == 1, []
        own = {"marked"} if marked else {tag} if tag in ("article", "main") else None
        self.within = within | own if own else within


class _Tree(HTMLParser):
    """A tree of block elements; items of a node are nodes and (text, in a link) pairs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", "#", 0)
        self.open, self.hidden, self.links = [self.root], [], 0

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            self._end_hidden(tag)
        if self.hidden:
            if tag not in VOID:
                self.hidden.append(tag)
            return
        if tag in HIDDEN:
            self.hidden.append(tag)
            return
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.open[-1].items.append((" ", False))
        if tag not in BLOCKS:
            if tag not in VOID and (_is_hidden(attrs) or _is_inline_advert(attrs)):
                self.hidden.append(tag)
                self.links -= tag == "a"
            return
        self.links = 0
        if self.open[-1].tag == "p" or (any(n.tag == "p" for n in self.open[-4:]) and tag != "p"):
            self._close("p")
        if tag in ENDS:
            self._end_open(ENDS[tag])
        if tag == "body" and any(n.tag == "body" for n in self.open) or tag == "html":
            return
        if tag not in VOID and _is_hidden(attrs):
            self.hidden.append(tag)
            return
        label, mark = _name(tag, attrs)
        node = Node(tag, label, mark, self.open[-1].within)
        if len(self.open) > DEPTH and not self._is_new(tag, node.marked):
            # flattened: the tag is open as any other, but its items are its parent's
            node.items = self.open[-1].items
            node.items.append(BREAK)
        else:
            self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
                return
            if tag in ("body", "html"):
                self.hidden = []
                return
            # the end of a block around a hidden element ends that too
            if self.hidden[0] in HIDDEN or tag not in BLOCKS or all(n.tag != tag for n in self.open):
                return
            self.hidden = []
        if tag == "a":
            self.links = 0
        if tag in BLOCKS:
            self.links = 0
            self._close(tag)

    def handle_data(self, data):
        if self.hidden == ["head"] and data.strip():
            self.hidden = []
        if not self.hidden:
            self.open[-1].items.append((data, self.links > 0))

    def _end_hidden(self, tag):
        """Ends hidden elements whose end tags may be left out where ``tag`` opens."""
        if self.hidden == ["head"] and tag not in HEAD:
            self.hidden = []
        for tags in ([{"p"}] if tag in BLOCKS else []) + ([HIDDEN_ENDS[tag]] if tag in HIDDEN_ENDS else []):
            k = len(self.hidden) - 1
            while k >= 0:
                if self.hidden[k] in tags:
                    del self.hidden[k:]
                elif self.hidden[k] in SCOPES:
                    break
                k -= 1

    def _is_new(self, tag, marked) -> bool:
        """Whether a deep element starts a marked part or an article, and none is open."""
        within = self.open[-1].within
        return "marked" not in within and (marked or tag in ("article", "main") and tag not in within)

    def _cut(self, k):
        flat = self.open[k].items is self.open[k - 1].items
        del self.open[k:]
        if flat:
            self.open[-1].items.append(BREAK)

    def _close(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self._cut(k)
                return

    def _end_open(self, tags):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                self._cut(k)
                return
            if self.open[k].tag in SCOPES:
                return


def _is_hidden(attrs) -> bool:
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _tokens(attrs) -> list[list[str]]:
    """The words of each class and id."""
    tokens = (token for name, value in attrs if value and name in ("class", "id") for token in value.split())
    return [_WORDS.findall(_CAMEL.sub(" ", token).lower()) for token in tokens]


def _is_inline_advert(attrs) -> bool:
    return any(not INLINE_ADVERTS.isdisjoint(words) and all(w in INLINE_ADVERTS or w in PART_WORDS for w in words) for words in _tokens(attrs))


def _name(tag: str, attrs) -> tuple[str, int]:
    """A label for matching, without numbers, and how surely the element is not the article: 2 marked, 1 prior, 0 not at all."""
    words, mark = [], 2 * (tag in ASIDE_TAGS)
    for found in _tokens(attrs):
        words += found
        mark = max(mark, _marks(tag, found))
    for role in (value.lower() for name, value in attrs if value and name == "role"):
        words.append(role)
        mark = max(mark, 2 * (role in ASIDE_ROLES))
    return " ".join([tag, *sorted(set(words))]), mark


def _marks(tag: str, words: list[str]) -> int:
    """What one class or id says. ``has-sidebar`` and the like describe a layout; an article is a comment only by its whole name."""
    if tag in ("body", "main") or not LAYOUT_WORDS.isdisjoint(words) or not words:
        return 0
    if tag == "article":
        return 2 * ASIDE_WORDS.issuperset(words)
    if HEADER_WORDS.issuperset(words) or any(w in ASIDE_WORDS and w not in PRIOR_WORDS for w in words):
        return 2
    if PRIOR_WORDS.isdisjoint(words):
        return 0
    # the whole name: nothing but such words and places, and not of a section that articles have themselves
    return 2 if all(w in ASIDE_WORDS or w in PART_WORDS for w in words) else 1


def parsed(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


# A wrapper node is a list: label, pages, chars, link chars, {text hash: pages}, children, whether its name is a prior.


def as_wrapper(node: Node, inside: bool = False) -> list:
    """The page's tree with counts of one page. Runs of equal leaves become one repeated slot."""
    texts = [x for x in node.items if isinstance(x, tuple)]
    own = " ".join("".join(t for t, _ in texts).split())
    chars = len(own)
    links = min(chars, sum(len(t) for t, link in texts if link))
    children: list = []
    for child in (x for x in node.items if isinstance(x, Node)):
        made = as_wrapper(child)
        if children and children[-1][0] == made[0]:
            children[-1] = merged(children[-1], made, same_page=True)
        else:
            children.append(made)
    chars += sum(c[2] for c in children)
    links += sum(c[3] for c in children)
    check = zlib.crc32(repr((own, [sorted(c[4]) for c in children])).encode("utf-8", "surrogatepass"))
    return [node.label, 1, chars, links, {str(check): 1}, children, node.prior]


class Shapes:
    """Numbers for equal subtrees and the sizes of their simple tree matchings, for the trees of one merge."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.children: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.seen: dict[int, tuple[int, list]] = {}
        self.scores: dict[tuple[int, int], int] = {}

    def number(self, node: list) -> int:
        if id(node) not in self.seen:
            children = tuple(map(self.number, node[5]))
            shape = self.numbers.setdefault((node[0], children), len(self.labels))
            if shape == len(self.labels):
                self.labels.append(node[0])
                self.children.append(np.array(children, np.int64))
                self.sizes.append(1 + sum(self.sizes[c] for c in children))
            # the node is held, so no other node takes its id
            self.seen[id(node)] = shape, node
        return self.seen[id(node)][0]

    def all(self, nodes: list) -> np.ndarray:
        return np.array([self.number(n) for n in nodes], np.int64)

    def score(self, x: int, y: int) -> int:
        """The largest number of aligned pairs of nodes that keeps order and ancestry."""
        if x == y:
            return self.sizes[x]
        if self.labels[x] != self.labels[y]:
            return 0
        if (x, y) not in self.scores:
            left, right = self.children[x], self.children[y]
            start, end = equal_ends(left, right)
            ends = sum(self.sizes[c] for c in (*left[:start], *left[len(left) - end :]))
            middle = self.totals(left[start : len(left) - end], right[start : len(right) - end])[-1]
            self.scores[x, y] = 1 + ends + int(middle)
        return self.scores[x, y]

    def weights(self, left: np.ndarray, right: np.ndarray):
        """For each of ``left`` its scores with all of ``right``."""
        shapes, place = np.unique(right, return_inverse=True)
        by_label: dict[str, list[int]] = {}
        for k, y in enumerate(shapes.tolist()):
            by_label.setdefault(self.labels[y], []).append(k)
        for x in left.tolist():
            row = np.zeros(len(shapes), np.int64)
            for k in by_label.get(self.labels[x], ()):
                row[k] = self.score(x, int(shapes[k]))
            yield row[place]

    def totals(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The best totals of ``left`` with the first 0, 1, 2 … of ``right``."""
        best = np.zeros(len(right) + 1, np.int64)
        if len(right):
            for row in self.weights(left, right):
                best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row))
        return best

    def pairs(self, left: np.ndarray, right: np.ndarray, i: int = 0, j: int = 0):
        """Aligned positions in order; ``i`` and ``j`` are the positions of the first of each list."""
        start, end = equal_ends(left, right)
        yield from ((i + k, j + k) for k in range(start))
        m, n = len(left) - end, len(right) - end
        inner, other = left[start:m], right[start:n]
        if not len(inner) or not len(other):
            yield from ((i + k, None) for k in range(start, m))
            yield from ((None, j + k) for k in range(start, n))
        elif len(inner) == 1:
            row = next(self.weights(inner, other))
            at = int(row.argmax())
            if row[at] == 0:
                yield i + start, None
            for k in range(len(other)):
                yield (i + start if k == at and row[at] else None), j + start + k
        else:
            half = len(inner) // 2
            both = self.totals(inner[:half], other) + self.totals(inner[half:][::-1], other[::-1])[::-1]
            cut = int(both.argmax())
            yield from self.pairs(inner[:half], other[:cut], i + start, j + start)
            yield from self.pairs(inner[half:], other[cut:], i + start + half, j + start + cut)
        yield from ((i + m + k, j + n + k) for k in range(end))


def equal_ends(left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
    """How many shapes two lists share at their start and, after that, at their end; a best matching pairs them."""
    most = min(len(left), len(right))
    same = left[:most] == right[:most]
    start = most if same.all() else int(same.argmin())
    rest = most - start
    same = left[len(left) - rest :][::-1] == right[len(right) - rest :][::-1]
    return start, rest if same.all() else int(same.argmin())


def matching(a: list, b: list) -> int:
    """Simple tree matching of two trees."""
    shapes = Shapes()
    return shapes.score(shapes.number(a), shapes.number(b))


def aligned(left: list, right: list, shapes: Shapes | None = None) -> list[tuple[int | None, int | None]]:
    """Pairs of child positions in order; None on one side where a child has no partner."""
    if not left or not right:
        return [(k, None) for k in range(len(left))] + [(None, k) for k in range(len(right))]
    if [x[0] for x in left] == [y[0] for y in right] and len({x[0] for x in left}) == len(left):
        return [(k, k) for k in range(len(left))]
    shapes = shapes or Shapes()
    return list(shapes.pairs(shapes.all(left), shapes.all(right)))


def merged(a: list, b: list, same_page: bool = False, shapes: Shapes | None = None) -> list:
    """Two trees with equal root labels as one, counts added."""
    children = []
    shapes = shapes or (Shapes() if a[5] and b[5] else None)
    for i, j in aligned(a[5], b[5], shapes):
        children.append(b[5][j] if i is None else a[5][i] if j is None else merged(a[5][i], b[5][j], same_page, shapes))
    texts = dict(a[4])
    if same_page:
        texts = {str(zlib.crc32(("+".join(sorted(a[4])) + "|" + "+".join(sorted(b[4]))).encode())): 1}
    else:
        for k, n in b[4].items():
            texts[k] = texts.get(k, 0) + n
        if len(texts) > KEPT_TEXTS:
            texts = dict(sorted(texts.items(), key=lambda kv: (-kv[1], kv[0]))[:KEPT_TEXTS])
    return [a[0], max(a[1], b[1]) if same_page else a[1] + b[1], a[2] + b[2], a[3] + b[3], texts, children, a[6] and b[6]]


def common(wrapper: list, pages: int) -> list:
    """The wrapper without nodes that fewer than one in ``RARE`` of the host's pages have."""
    return [*wrapper[:5], [common(c, pages) for c in wrapper[5] if c[1] * RARE >= pages], wrapper[6]]


def decided(wrapper: list, varied: bool | None = None) -> list:
    """label, dropped, children: what extraction needs of a wrapper."""
    label, pages, chars, links, texts, children, prior = wrapper
    share = max(texts.values(), default=0) / max(pages, 1)
    if varied is None:
        # where most different pages have one text, equal texts say nothing about the template
        varied = share < 0.5 and pages >= MIN_PAGES
        share = 0.0
    template = varied and pages >= MIN_PAGES and chars > 0 and share >= (PRIOR if prior else CONSTANT)
    linked = pages >= MIN_PAGES and links >= (PRIOR if prior else LINKS) * chars > 0
    return [label, int(template or linked), [decided(c, varied) for c in children]]


def _bare(node: Node) -> list:
    """The page's tree in the shape that ``aligned`` reads, with the nodes kept."""
    children: list = []
    for child in (x for x in node.items if isinstance(x, Node)):
        made = _bare(child)
        if children and children[-1][0] == made[0]:
            children[-1][6].append(child)
            children[-1][5] = _joined(children[-1][5], made[5])
        else:
            children.append(made)
    return [node.label, 1, 0, 0, {}, children, [node]]


def _joined(left: list, right: list, shapes: Shapes | None = None) -> list:
    out = []
    shapes = shapes or Shapes()
    for i, j in aligned(left, right, shapes):
        if i is None:
            out.append(right[j])
        else:
            if j is not None:
                left[i] = [*left[i][:5], _joined(left[i][5], right[j][5], shapes), left[i][6] + right[j][6]]
            out.append(left[i])
    return out


def _shape(decision: list) -> list:
    return [decision[0], 1, 0, 0, {}, [_shape(c) for c in decision[2]], decision[1]]


def _dropped(page: list, wrapper: list, out: set, shapes: Shapes | None = None) -> None:
    shapes = shapes or Shapes()
    for i, j in aligned(page[5], wrapper[5], shapes):
        if i is not None and j is not None:
            if wrapper[5][j][6]:
                out.update(id(n) for n in page[5][i][6])
            else:
                _dropped(page[5][i], wrapper[5][j], out, shapes)


def _articles(node: Node, tag: str) -> list[Node]:
    found = []
    for child in node.items:
        if isinstance(child, Node) and not child.marked:
            is_one = child.tag == tag or tag == "main" and "main" in child.label.split(" ")[1:]
            found += [child] if is_one else _articles(child, tag)
    return found


def _blocks(node: Node, dropped: set, in_article: bool, out: list[str]) -> None:
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    for item in node.items:
        if item is BREAK:
            flush()
            continue
        if isinstance(item, tuple):
            run.append(item[0])
            continue
        flush()
        skip = item.marked or id(item) in dropped or (item.tag == "header" and not in_article)
        if not skip:
            _blocks(item, dropped, in_article, out)
    flush()


def extracted(html: str | None, decision: list | None = None) -> str:
    """The main text of one page, given its host's decisions."""
    if not html:
        return ""
    root = parsed(html)
    dropped: set = set()
    if decision is not None:
        _dropped(_bare(root), _shape(decision), dropped)
    out: list[str] = []
    _blocks(root, dropped, False, out)
    found = _articles(root, "article") or _articles(root, "main")
    inside: list[str] = []
    for node in found:
        _blocks(node, dropped, True, inside)
    # the mark is evidence: it holds unless more of the page's own text lies outside
    if inside and 2 * sum(map(len, inside)) >= sum(map(len, out)):
        return "\n".join(inside)
    return "\n".join(out)


def _induce(batches):
    from pyspark import TaskContext

    hosts: dict[str, list] = {}
    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = as_wrapper(parsed(html.as_py()))
            whole = merged(hosts[host], page) if host in hosts else page
            hosts[host] = common(whole, whole[1]) if whole[1] % RARE == 0 else whole
    part = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(hosts), pa.string()), pa.array([part % PARTS] * len(hosts), pa.int32()), pa.array([json.dumps(w) for w in hosts.values()], pa.string())],
        ["host", "part", "wrapper"],
    )


def _merge(keys: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(rows["wrapper"]):
            tree = json.loads(text)
            whole = tree if whole is None else merged(whole, tree)
            whole = common(whole, whole[1])
        return pd.DataFrame({**{k: [rows[k].iloc[0]] for k in keys}, "wrapper": [json.dumps(whole)]})

    return run


def _decide(batches):
    for batch in batches:
        texts = [json.dumps(decided(json.loads(w)), separators=(",", ":")) for w in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["host", "decision"])


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, decision (json) from all pages."""
    rows = pages.where("html is not null").select(host_of("url").alias("host"), F.col("html").cast("string").alias("html"))
    # copies of a page are one page here; only pages that have copies move
    hashed = rows.withColumn("hash", F.xxhash64("html"))
    copied = Staged(pages.sparkSession, "copied-pages").write(hashed.groupBy("host", "hash").count().where("count > 1").drop("count"))
    single = hashed.join(copied, ["host", "hash"], "left_anti").select("host", "html")
    one = hashed.join(copied, ["host", "hash"], "left_semi").groupBy("host", "hash").agg(F.first("html").alias("html")).select("host", "html")
    partial = single.unionByName(one).mapInArrow(_induce, "host string, part int, wrapper string")
    halfway = partial.groupBy("host", "part").applyInPandas(_merge(["host", "part"]), "host string, part int, wrapper string")
    whole = halfway.groupBy("host").applyInPandas(_merge(["host"]), "host string, wrapper string")
    return whole.mapInArrow(_decide, "host string, decision string")


def _extract(batches):
    known: dict[str, list] = {}
    for batch in batches:
        texts = []
        for html, decision in zip(batch.column("html"), batch.column("decision")):
            text = decision.as_py()
            if text is not None and text not in known:
                if len(known) > 1000:
                    known.clear()
                known[text] = json.loads(text)
            texts.append(extracted(html.as_py(), known.get(text)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of (page_id, url, html)."""
    decisions = Staged(pages.sparkSession, "wrappers").write(wrappers(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of("url").alias("host"))
    return rows.join(decisions, "host", "left").select("page_id", "url", "html", "decision").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark, folder) -> DataFrame:
    return extract(read_table(spark, folder, "pages"))
