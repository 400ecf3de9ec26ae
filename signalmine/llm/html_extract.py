"""Main text of web pages by consensus host paths.

Each page's elements are read in one pass, and the text outside of navigation,
adverts, forms, notices and reader comments is found. A page votes twice, with
paths of tags and classes (numbers generalised): for the innermost container that
holds all of that text, and for its core, the container of the highest score, which
is the paragraph text in it and half of that one level below, less by its share of
links. Spark counts the votes per host.

Every page is then read again. Its text is taken from all containers at its host's
first path if nothing but links would be lost, else from its own; of that goes what
lies outside of the host's core path and repeats, at the same place and word for
word, on at least ``REPEATS`` pages and half of the pages with different cores: the
frame of the host, whatever its classes say.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import stored

LOOSE = 25              # characters from which text outside of paragraphs, headings and items is no mere label
MAIN_SHARE = 0.5        # of the page's text from which the main element bounds it
MOST = 0.5              # of the paragraph text around it that a marked element must have to be kept all the same
NEARLY_ALL = 0.9        # the same, for words that say what a text is and not where it stands
LONG = 80               # characters from which text outside of paragraphs counts as paragraph text
REPEATS = 3             # pages with different cores from which text around them may be the host's frame
FRAME_SHARE = 0.5       # of the host's pages with different cores

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template svg select canvas annotation annotation-xml".split())
CONTAINERS = frozenset("body div section article main td center blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html "
    "li menu nav ol p pre summary table tbody tfoot th thead tr ul br hr option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_MAIN = frozenset("form fieldset".split())
HARD = frozenset("head nav footer aside menu dialog button label".split())
PROSE = HEADINGS | frozenset("p pre blockquote figcaption".split())
ITEMS = frozenset("li dd dt td th caption".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("body div section article main td th table ul ol dl nav aside header footer form blockquote".split())
# Words in class, id or role that mark what isn't the article.
NOT_MAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices outbrain pager pagination paywall popup promo promotion recommended related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe taboola tags toolbar "
    "tooltip widget widgets".split())
# Those of them that say what the text is, so that a long one is still no article.
READERS = frozenset("comment comments discussion disqus replies reply respond".split())
SURE_WORDS = READERS | frozenset(
    "advert adverts advertisement advertising consent cookie cookies copyright disclaimer gdpr noscript outbrain "
    "taboola".split())
# First words of a class that is a label's value; words that say what a page has; page builders.
LABELS = frozenset("tag category".split())
MODIFIERS = frozenset("has have with without no not hide hides show shows enable disable".split())
STATES = frozenset("open closed enabled disabled on off".split())
BUILDERS = frozenset("elementor".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""",
    re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/>]|\Z)""", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_WORD = re.compile(r"[a-z]+|[0-9]+", re.I)
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "parent", "path", "begin", "end", "out", "soft", "heading", "strong", "length", "kind",
                 "hard", "marks", "prose", "para")

    def __init__(self, tag, parent, path, begin):
        self.tag, self.parent, self.path, self.begin, self.end = tag, parent, path, begin, -1
        self.out = self.soft = self.heading = self.strong = False
        self.length = 0
        self.hard = self.para = False  # left out whatever it holds; in a paragraph
        self.marks: frozenset[str] = frozenset()
        self.prose = 0  # characters of paragraph text
        self.kind = 0  # of its text: 2 in prose, 1 in an item, 0 loose, -1 a link outside of prose


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTR.findall(text):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _hidden(attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I)) or attrs.get("role", "").lower() in NOT_MAIN_ROLES


@functools.lru_cache(maxsize=10_000)
def _marks(value: str) -> frozenset[str]:
    """The marking words of a class or id value. What follows has-, with- or no-, a
    tag- or category- value, a state (comments-open) and a page builder's widget
    aren't marks."""
    found = set()
    for name in value.split():
        words = _WORD.findall(_CAMEL.sub(r"\1 \2", name).lower())
        if not words or words[0] in LABELS and len(words) > 1 or words[-1] in STATES:
            continue
        words = words[:next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))]
        found.update(w for w in words if w in NOT_MAIN_WORDS and not (w == "widget" and words[0] in BUILDERS))
    return frozenset(found)


def _label(tag: str, attrs: dict[str, str]) -> str:
    return ".".join([tag, *sorted({re.sub(r"\d+", "0", c) for c in attrs.get("class", "").split()})])


class Page:
    """The elements of a page and its text in order: ``events`` holds (node,
    text) with None for a break between blocks."""

    def __init__(self, source: str):
        self.nodes = [Node("", None, "", 0)]
        self.events: list[tuple[Node, str | None]] = []
        self.runs: list[tuple[int, int]] | None = None
        stack, at = [self.nodes[0]], 0
        while at < len(source):
            m = _TAG.search(source, at)
            if m is None:
                self._text(stack[-1], source[at:])
                break
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(stack, tag)
                continue
            if tag in RAW:
                close = _CLOSE[tag].search(source, at)
                at = close.end() if close else (len(source) if tag in ("script", "style", "textarea") else at)
                continue
            self._start(stack, tag, m[3] if m[2] else m[6])
        for node in stack:
            node.end = len(self.events)
        self._judge()

    def _text(self, node: Node, text: str) -> None:
        self.events.append((node, html.unescape(text) if "&" in text else text))

    def _close(self, stack: list[Node], at: int) -> None:
        for node in stack[at:]:
            node.end = len(self.events)
        del stack[at:]

    def _start(self, stack: list[Node], tag: str, attrs: str) -> None:
        block = tag in BLOCKS
        if tag == "body" or tag == "head":
            del_from = next((i for i, x in enumerate(stack) if x.tag == "head"), None)
            if del_from:
                self._close(stack, del_from)
        if block and tag != "br":
            ends = SIBLINGS.get(tag, set()) | {"p"} | (HEADINGS if tag in HEADINGS else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    self._close(stack, i)
                elif stack[i].tag in SCOPES:
                    break
        if block:
            self.events.append((stack[-1], None))
        if tag in VOID:
            return
        parent = stack[-1]
        found = _attributes(attrs) if attrs.strip() else {}
        path = f"{parent.path}/{_label(tag, found)}" if tag in CONTAINERS else parent.path
        node = Node(tag, parent, path, len(self.events))
        node.heading = parent.heading or tag in HEADINGS
        if tag in PROSE:
            node.kind = 2
        elif tag == "a" and parent.kind < 2:
            node.kind = -1
        else:
            node.kind = parent.kind or int(tag in ITEMS)
        if tag in ("header", "hgroup"):
            node.soft = True
        elif tag not in ("html", "body", "main"):
            node.hard = tag in HARD or bool(found) and _hidden(found)
            node.marks = _marks(f"{found.get('class', '')} {found.get('id', '')}") if found else node.marks
            if tag in NOT_MAIN or tag == "noscript" and parent.tag in ("", "html", "body"):
                node.marks |= {tag}
            node.out = node.hard or bool(node.marks & READERS if tag == "article" else node.marks)
        node.hard = node.hard or parent.hard
        node.para = parent.para or tag in ("p", "pre", "blockquote")
        if attrs.rstrip().endswith("/") and not block:
            node.end = len(self.events)
            return
        self.nodes.append(node)
        stack.append(node)

    def _end(self, stack: list[Node], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                self._close(stack, i)
                break
            if stack[i].tag in SCOPES and tag not in BLOCKS:
                break
        if tag in BLOCKS:
            self.events.append((stack[-1], None))

    def _judge(self) -> None:
        """Mark what is left out; sum up the text in each container."""
        inside = {id(self.nodes[0]): False}
        for node in self.nodes[1:]:
            node.strong = node.tag in ("article", "main") and not node.out and (node.tag == "main" or not node.marks)
            up = node.parent
            while up is not None and node.strong and up.tag not in ("body", ""):
                if up.tag in ("article", "main"):
                    break
                if up.out and (up.tag in CONTAINERS or up.tag in NOT_MAIN):
                    up.out = False  # a wrapper of the article, whatever its class says
                up = up.parent
        if any(node.out and node.marks and not node.hard for node in self.nodes):
            self._keep_most()
        for node in self.nodes[1:]:
            node.out = node.out or node.parent.out
            inside[id(node)] = inside[id(node.parent)] or node.tag in ("article", "main")
            if node.soft and not inside[id(node.parent)]:
                node.out = True  # the page's header, not the article's
            node.soft = node.soft or node.parent.soft
        self._leads()
        for node, text in self.events:
            if text is not None and self._in(node):
                node.length += len(text) - text.count(" ")
        for node in reversed(self.nodes[1:]):
            node.parent.length += node.length

    def _leads(self) -> None:
        """Long paragraphs in an article's header are text, as its headings are."""
        lengths: dict[int, int] = {}
        for node, text in self.events:
            if text is not None and node.soft and not node.out:
                while node.tag != "p" and node.parent is not None:
                    node = node.parent
                lengths[id(node)] = lengths.get(id(node), 0) + len(text.strip())
        for node in self.nodes[1:]:
            if node.soft:
                node.heading = node.heading or node.parent.heading or node.tag == "p" and lengths.get(id(node), 0) >= LONG

    def _keep_most(self) -> None:
        """Marked elements that hold most of the paragraph text of the article, kept
        element or page around them, alone or with the others of a word, are kept."""
        for node, text in self.events:
            if text is not None and not node.hard:
                n = len(text) - text.count(" ")
                node.prose += n if node.para or n >= LONG and node.kind >= 0 else 0
        inner: dict[int, list[Node]] = {}
        for node in reversed(self.nodes[1:]):
            node.parent.prose += node.prose
            inner.setdefault(id(node.parent), []).append(node)
        scopes = [self.nodes[0]]
        for scope in scopes:
            marked, strong, below = [], [], list(inner.get(id(scope), []))
            while below:
                node = below.pop()
                if node.strong:
                    strong.append(node)
                elif node.out:
                    marked += [] if node.hard else [node]
                else:
                    below += inner.get(id(node), [])
            scopes += strong
            if scope is self.nodes[0] and sum(n.prose for n in strong) > (1 - NEARLY_ALL) * scope.prose:
                continue  # the page says itself what its article is
            groups: dict[str, list[int]] = {}
            for node in marked:
                for word in node.marks:
                    groups.setdefault(word, []).append(node.prose)
            least = {w: (NEARLY_ALL if w in SURE_WORDS else MOST) * scope.prose for w in groups}
            together = {w for w, some in groups.items() if max(some) <= least[w] < sum(some)}
            for node in marked:
                if node.prose and all(w in together or node.prose > least[w] for w in node.marks):
                    node.out = False
                    scopes.append(node)

    def _in(self, node: Node) -> bool:
        return not node.out and (not node.soft or node.heading)

    def _runs(self) -> list[tuple[int, int]]:
        """(event, weight) of each text between two breaks that isn't left out and
        isn't a mere link; weight 2: in a paragraph, heading or item, or long."""
        if self.runs is None:
            self.runs, at, weight, loose = [], -1, 0, 0
            for i, (node, text) in enumerate(self.events):
                if text is None:
                    if weight:
                        self.runs.append((at, 2 if loose >= LOOSE else weight))
                    at, weight, loose = -1, 0, 0
                elif node.kind >= 0 and self._in(node) and not text.isspace():
                    if at < 0 or node.kind and weight < 2:
                        at = i
                    weight = 2 if node.kind else max(weight, 1)
                    loose += 0 if node.kind else len(text) - text.count(" ")
            if weight:
                self.runs.append((at, 2 if loose >= LOOSE else weight))
        return self.runs

    def _holder(self, first: int, last: int, among: list[Node]) -> Node | None:
        """The innermost container that holds both events."""
        return next((n for n in reversed(among) if n.begin <= first and last < n.end and n.tag in CONTAINERS), None)

    def best(self) -> Node:
        """The innermost container with all text that isn't left out; of the labels
        beside it only those under the same child of the body, and nothing outside of
        a main element that holds much of the page's text."""
        root, runs = self.nodes[0], self._runs()
        mains = [n for n in self.nodes if n.tag == "main" and not n.out]
        top = max(mains, key=lambda n: n.length, default=root)
        if top is not root and top.length >= MAIN_SHARE * root.length:
            runs = [r for r in runs if any(n.begin <= r[0] < n.end for n in mains)]
        sure = [i for i, weight in runs if weight == 2] or [i for i, _ in runs]
        if not sure:
            return root
        first, last = sure[0], sure[-1]
        top = next((n for n in self.nodes[1:] if n.begin <= first and last < n.end and n.tag in CONTAINERS
                    and n.tag != "body"), None)
        if top is not None:
            inner = [i for i, _ in runs if top.begin <= i < top.end]
            first, last = inner[0], inner[-1]
        return self._holder(first, last, self.nodes[1:]) or root

    def at(self, path: str) -> list[Node]:
        return [n for n in self.nodes[1:] if n.path == path and n.tag in CONTAINERS and not n.out]

    def chosen(self, path: str | None) -> list[Node]:
        """The containers at the host's path if they hold all of the page's own text
        but mere links, else its own container."""
        own, nodes = self.best(), self.at(path) if path else []
        if nodes and all(any(n.begin <= i < n.end for n in nodes)
                         for i, _ in self._runs() if own.begin <= i < own.end):
            return nodes if any(n.length for n in nodes) else [own]
        return [own]

    def core(self) -> Node:
        """The container of the highest score in the page's own; of equals the innermost."""
        own, scores, links = self.best(), {}, {}
        for node, text in self.events[own.begin:own.end]:
            if text is None or not self._in(node):
                continue
            n, up = len(text) - text.count(" "), node
            while up.tag not in CONTAINERS and up.parent is not None:
                up = up.parent
            if node.kind < 0:
                links[id(up)] = links.get(id(up), 0) + n
            elif node.kind == 2 or n >= LOOSE:
                scores[id(up)] = scores.get(id(up), 0) + n
                above = up.parent
                while above is not None and above.tag not in CONTAINERS:
                    above = above.parent
                if above is not None:
                    scores[id(above)] = scores.get(id(above), 0) + n / 2
        inner = [n for n in self.nodes if own.begin <= n.begin and n.end <= own.end and id(n) in scores] or [own]
        return max(reversed(inner), key=lambda n: scores.get(id(n), 0) ** 2 / (
            scores.get(id(n), 0) + links.get(id(n), 0) or 1))

    def pieces(self, nodes: list[Node], cores: list[Node]) -> list[tuple[int, int, int]]:
        """(first event, event after the last, hash of place and text) of each text
        between two breaks in ``nodes`` and in none of ``cores``."""
        out = []
        for node in nodes:
            begin, parts, place = node.begin, [], ""
            for i, (owner, text) in enumerate([*self.events[node.begin:node.end], (node, None)], node.begin):
                if text is None:
                    if said := " ".join("".join(parts).split()):
                        mark = hashlib.blake2b(f"{place}\0{said}".encode("utf-8", "replace"), digest_size=8).digest()
                        out.append((begin, i, int.from_bytes(mark, "little", signed=True)))
                    begin, parts = i + 1, []
                elif self._in(owner) and not any(n.begin <= i < n.end for n in cores):
                    place = owner.path if not parts else place
                    parts.append(text)
        return out

    def text(self, *nodes: Node, core: str | None = None, frame: frozenset[int] = frozenset()) -> str:
        """The text of ``nodes`` without the pieces of ``frame`` outside of ``core``."""
        left_out: set[int] = set()
        if frame and (cores := self.at(core)):
            for begin, end, mark in self.pieces(list(nodes), cores):
                if mark in frame:
                    left_out.update(range(begin, end))
        parts = [" " if text is None else text for node in nodes
                 for i, (owner, text) in enumerate([(node, None), *self.events[node.begin:node.end]], node.begin - 1)
                 if text is None or self._in(owner) and i not in left_out]
        return " ".join("".join(parts).split())


def _host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """Of each page: host, path and length of its own container, path (core) and
    length of its core, a hash of the core's text (content), and the hashes of the
    pieces around the core (pieces)."""

    def run(batches):
        for batch in batches:
            rows = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(source or "")
                own, core = page.best(), page.core()
                cores = page.at(core.path) if core.path else []
                said = page.text(*cores).encode("utf-8", "replace")
                rows.append({
                    "host": host, "path": own.path, "length": own.length if own is not page.nodes[0] else 0,
                    "core": core.path, "core_length": sum(n.length for n in cores),
                    "content": int.from_bytes(hashlib.blake2b(said, digest_size=8).digest(), "little", signed=True),
                    "pieces": sorted({mark for *_, mark in page.pieces([own], cores)}) if cores else []})
            yield pa.RecordBatch.from_pylist(rows, schema=_VOTE)

    return pages.select(_host().alias("host"), "html").mapInArrow(
        run, "host string, path string, length long, core string, core_length long, content long, pieces array<bigint>")


_VOTE = pa.schema([("host", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("core", pa.string()),
                   ("core_length", pa.int64()), ("content", pa.int64()), ("pieces", pa.list_(pa.int64()))])


def _winner(votes: DataFrame, path: str, length: str) -> DataFrame:
    """(host, path): the path with most votes, then most text, then the last by name."""
    counted = votes.where((F.col(path) != "") & (F.col(length) > 0)).groupBy("host", path).agg(
        F.count("*").alias("n"), F.sum(length).alias("length"))
    return counted.groupBy("host").agg(F.max_by(path, F.struct("n", "length", path)).alias(path))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, core, frame) of each host: the winning paths, and the hashes of
    the pieces around the core that its pages repeat. Each of these is on a given
    share of the host's pages, so they are no more than a few pages' pieces."""
    cast = stored(votes(pages), "host-votes")
    paths, cores = _winner(cast, "path", "length"), _winner(cast, "core", "core_length")
    usual = cast.join(cores, ["host", "core"], "left_semi")
    whole = usual.groupBy("host").agg(F.count_distinct("content").alias("contents"))
    found = usual.select("host", "content", F.explode("pieces").alias("piece")).groupBy("host", "piece").agg(
        F.count_distinct("content").alias("n")).where(F.col("n") >= REPEATS)
    frames = found.join(whole, "host").where(F.col("n") >= FRAME_SHARE * F.col("contents")).groupBy("host").agg(
        F.collect_list("piece").alias("frame"))
    return paths.join(cores, "host", "left").join(frames, "host", "left")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A null or empty page has an empty text. Pages without a host vote together.
    Repeated rows are read each. An empty table gives none."""
    paths = stored(host_paths(pages), "host-paths").withColumnRenamed("host", "_host")
    rows = pages.select("page_id", "url", "html", _host().alias("_of"))
    rows = rows.join(paths, F.col("_of") == F.col("_host"), "left").select(
        "page_id", "url", "path", "core", "frame", "html")

    def run(batches):
        for batch in batches:
            texts = []
            for path, core, frame, source in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                page = Page(source or "")
                texts.append(page.text(*page.chosen(path), core=core, frame=frozenset(frame or ())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
