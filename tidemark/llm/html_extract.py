"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree whose nodes are paths of styled elements (tag and words of class, id and
role). For every node the tree counts the child sequences in which its pages present it and the texts that stand below
it. A text on many pages of the node says little (its entropy over them is high), a node that always looks the same
likewise. A node's importance mixes both, the more towards presentation the more children it has. What elements say of
themselves is one more feature: it scales the importance down where tag or class name a part of the frame (navigation,
adverts, comments) or where the page marks its article elsewhere, and lifts it within a marked article, so that a heading
that all pages repeat stays with its article. Inside an article a compound name such as ``related-work`` only halves it,
unless most of the node's text is links. Nodes of low importance go with all below them, from each page of the host; no
other rule removes text, but for elements that never show any (scripts, styles, form controls).

Pages that mark an article, and those that don't, are separate trees of their host. On fewer than ``least_pages`` pages,
and on hosts on which nothing is important (all pages alike), the entropies decide nothing: what is left are the marks.

Reading a page takes time linear in its length: nodes are numbers with a parent. Elements nested deeper than ``DEPTH`` are
children of the last node above that depth, as browsers have it; their texts stay.

Defined results: null or empty html gives an empty text; pages without a host are one site; broken markup is read as far
as it goes, elements closing when their parent does; repeated rows are extracted each; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

# Element kinds of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body br button html td th tr tbody thead tfoot caption option optgroup legend summary title".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table select article section div nav body".split())
#: Elements that show no text of their own, and elements of the page's frame.
_UNSHOWN = frozenset("button head iframe noscript script select style svg template textarea title".split())
_NOISE = frozenset("aside dialog footer form menu nav".split())
#: Words of classes, ids and roles that name parts of the frame; those that an article may use in compounds; those that never wrap an article.
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies footer masthead menu nav navbar navigation newsletter notice notification pagination popup promo promoted related search share "
    "sharing sidebar social sponsor sponsored subscribe toolbar".split()
)
_DOUBTFUL = frozenset("banner notice notification promo promoted related search share sharing social subscribe toolbar".split())
_NO_WRAPPER = frozenset("ad ads advert adverts advertisement advertising comment comments promo promoted related sponsor sponsored".split())
_MAIN = frozenset(("article", "main"))
_WORDS = re.compile(r"[a-z0-9]+")
_DECLARATION = re.compile(r"<!\[[^>]*>")
DEPTH = 100
#: What a node says of itself.
PLAIN, FRAME, COMPOUND, ARTICLE = range(4)
STATS = "host string, node long, kind string, value long, above array<long>, n long"


class PageReader(HTMLParser):
    """Reads a page into blocks (node, text) and nodes with their parent, label, child labels and mark; node 0 is the page."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.label, self.depth = [0], [""], [0]
        self.mark, self.frame = [PLAIN], [0]  # frame: the nearest node at or above that is part of the frame
        self.lifts: set[int] = set()  # frames by their words alone, which may turn out to wrap the article
        self.children: list[list[str]] = [[]]
        self.number: dict[tuple[int, str], int] = {}
        self.main: set[int] = set()
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, list[int]] = {}  # tag -> places in the stack
        self.unshown = 0
        self.blocks: list[tuple[int, str]] = []
        self.held: list[str] = []
        self.shown = False  # does ``held`` hold more than white space?
        self.at = 0
        self.feed(_DECLARATION.sub("", page))
        self.close()
        self.flush()
        self._place()

    def flush(self) -> None:
        if self.shown:
            self.blocks.append((self.at, " ".join("".join(self.held).split())))
        self.held, self.shown = [], False

    def pop_to(self, index: int) -> None:
        if any(tag in _BLOCK for tag, _ in self.stack[index:]):
            self.flush()
        while len(self.stack) > index:
            tag = self.stack.pop()[0]
            self.open[tag].pop()
            self.unshown -= tag in _UNSHOWN

    def last(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=-1)

    def close_open(self, tags: set[str]) -> None:
        """Close the innermost of ``tags``, unless a list, table or section was opened in it."""
        place = self.last(tags)
        if place >= 0 and place >= self.last(_LISTS):
            self.pop_to(place)

    def node(self, above: int, label: str, mark: int, lifts: bool) -> int:
        if self.depth[above] >= DEPTH:
            if self.frame[above]:
                return above
            above = self.parent[above]
        self.children[above].append(label)
        found = self.number.get((above, label))
        if found is None:
            found = self.number[above, label] = len(self.parent)
            self.parent.append(above)
            self.label.append(label)
            self.depth.append(self.depth[above] + 1)
            self.children.append([])
            self.mark.append(mark)
            self.frame.append(found if mark == FRAME else self.frame[above])
            if lifts:
                self.lifts.add(found)
        return found

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES_P:
            self.close_open({"p"})
        if tag in _CLOSED_BY:
            self.close_open(_CLOSED_BY[tag])
        if tag in _BLOCK:
            self.flush()
        given = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role"))
        names = set(given.split())
        words = {w for w in _WORDS.findall(given) if w.isalpha()}
        named = words & _NOISE_WORDS
        main = tag in _MAIN or any(k == "role" and v and "main" in v.lower().split() for k, v in attrs)
        within = bool(self.open.get("article") or self.open.get("main"))
        mark, lifts = PLAIN, False
        if tag in _NOISE or (tag == "header" and not within) or (tag == "article" and names & _NO_WRAPPER):
            mark, main = FRAME, False
        elif named and not main and tag not in ("html", "body"):
            mark = COMPOUND if within and named <= _DOUBTFUL and not named & names else FRAME
            lifts = mark == FRAME and not named & _NO_WRAPPER
        at = self.node(self.stack[-1][1] if self.stack else 0, ".".join([tag, *sorted(words)]), mark, lifts)
        if main:
            self.main.add(at)
        if tag not in _VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append((tag, at))
            self.unshown += tag in _UNSHOWN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "iframe") and self.stack and self.stack[-1][0] == tag:
            self.pop_to(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            self.pop_to(self.open[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.unshown:
            return
        at = self.stack[-1][1] if self.stack else 0
        if not self.shown:
            self.at = at
        elif self.frame[at] != self.frame[self.at]:
            self.flush()  # an inline element of the page's frame starts or ends inside a block
            self.at = at
        self.held.append(data)
        self.shown = self.shown or not data.isspace()

    def _place(self) -> None:
        """Which nodes hold, are or lie beside the marked articles; keys of nodes, by the layout that this gives."""
        layout = "article"
        main = {m for m in self.main if not self.frame[m]}
        if not main and self.main:  # every article lies in the frame: a wrapper's words may be misleading
            layout = "wrapped"
            for m in self.main:
                at, wrappers = m, []
                while at and (self.mark[at] != FRAME or at in self.lifts):
                    wrappers.append(at)
                    at = self.parent[at]
                if not at:
                    main.add(m)
                    for w in wrappers:
                        self.mark[w] = PLAIN
        if main:
            holds = set(main)
            for m in main:
                at = self.parent[m]
                while at not in holds:
                    holds.add(at)
                    at = self.parent[at]
            inside = [False] * len(self.parent)
            for i in range(len(self.parent)):
                inside[i] = i in main or inside[self.parent[i]]
                if self.mark[i] == PLAIN:
                    self.mark[i] = ARTICLE if inside[i] or i in holds else FRAME
            # Text that stands in a wrapper itself, beside the article in it.
            self.beside = {i for i in holds if not inside[i]}
        else:
            layout, self.beside = "", set()
        self.key = [_hash(layout)]
        for i in range(1, len(self.parent)):
            self.key.append(_hash(f"{self.key[self.parent[i]]}/{self.label[i]}"))

    def above(self, i: int) -> list[int]:
        """Keys of the node and those above it."""
        keys = [self.key[i]]
        while i:
            i = self.parent[i]
            keys.append(self.key[i])
        return keys


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def main_text(page: str | None, low: frozenset[int]) -> str:
    """The page's text without the branches at ``low`` nodes. Text beside an article in an element that wraps it goes with the node's own key."""
    if not page:
        return ""
    reader = PageReader(page)
    gone: list[bool] = []
    for i, key in enumerate(reader.key):
        gone.append(key in low or (i > 0 and gone[reader.parent[i]]))
    return "\n".join(text for i, text in reader.blocks if not gone[i] and not (i in reader.beside and _hash(f"{reader.key[i]}/#text") in low))


def _site_stats(batches):
    for batch in batches:
        seen: Counter = Counter()
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not page:
                continue
            reader = PageReader(page)
            rows = {(host, reader.key[i], "text", _hash(text), ()) for i, text in reader.blocks}
            rows |= {(host, _hash(f"{reader.key[i]}/#text"), "node", FRAME, ()) for i, _ in reader.blocks if i in reader.beside}
            for i, labels in enumerate(reader.children):
                # Repeats of a label side by side are one: a longer article looks the same.
                sequence = [x for k, x in enumerate(labels) if not k or labels[k - 1] != x]
                rows.add((host, reader.key[i], "look", _hash("|".join(sequence)), ()))
                rows.add((host, reader.key[i], "node", 4 * len(set(labels)) + reader.mark[i], tuple(reader.above(i))))
            seen.update(rows)
            if COMPOUND in reader.mark:
                linked = [False] * len(reader.parent)
                for i in range(1, len(reader.parent)):
                    linked[i] = linked[reader.parent[i]] or reader.label[i].split(".")[0] == "a"
                for i, text in reader.blocks:
                    kind, at = "linked" if linked[i] else "chars", i
                    while at:
                        if reader.mark[at] == COMPOUND:
                            seen[host, reader.key[at], kind, 0, ()] += len(text)
                        at = reader.parent[at]
        columns = list(zip(*((*key, n) for key, n in seen.items()))) or [()] * 6
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in STATS.split(", ")])


def site_tree(pages: DataFrame, html_col: str = "html", gamma: float = 0.9, least_pages: int = 5) -> DataFrame:
    """(host, node, parent, pages, mark, features, importance) of every node; ``pages`` has ``host`` and the html column."""
    stats = pages.select("host", html_col).mapInArrow(_site_stats, STATS).groupBy("host", "node", "kind", "value", "above").agg(F.sum("n").alias("n"))
    stats = stage(stats, "site_stats")
    per_node = stats.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == "node", F.col("n"))).alias("m"),
        F.max(F.when(F.col("kind") == "node", F.col("value"))).alias("v"),
        F.max(F.when(F.col("kind") == "node", F.col("above"))).alias("above"),
        F.sum(F.when(F.col("kind") == "look", F.col("n"))).alias("s"),
        F.sum(F.when(F.col("kind") == "look", F.col("n") * F.log("n"))).alias("nlogn"),
        F.count(F.when(F.col("kind") == "look", 1)).alias("k"),
        F.sum(F.when(F.col("kind") == "text", F.log("n"))).alias("h"),
        F.count(F.when(F.col("kind") == "text", 1)).alias("f"),
        F.sum(F.when(F.col("kind") == "chars", F.col("n"))).alias("chars"),
        F.sum(F.when(F.col("kind") == "linked", F.col("n"))).alias("linked"),
    )
    nodes = stage(per_node, "site_nodes")
    # Texts count for every node above them.
    below = nodes.where("f > 0").select("host", "h", "f", F.explode("above").alias("node")).groupBy("host", "node").agg(F.sum("h").alias("hs"), F.sum("f").alias("features"))
    tree = nodes.join(below, ["host", "node"], "left")
    log_m = F.log(F.greatest("m", F.lit(2)))
    entropy = F.when(F.col("k") > 1, (F.log("s") - F.col("nlogn") / F.col("s")) / log_m).otherwise(0.0)
    content = F.when(F.col("features").isNull(), 1.0).otherwise(1 - F.col("hs") / F.col("features") / log_m)
    weight, mark = F.pow(F.lit(gamma), F.floor(F.col("v") / 4)), F.col("v") % 4
    own = F.when(F.col("m") < least_pages, 1.0).otherwise(F.greatest(F.lit(0.0), (1 - weight) * entropy + weight * content))
    links = F.coalesce("linked", F.lit(0)) >= F.greatest(F.coalesce("chars", F.lit(0)), F.lit(1))
    said = F.when(mark == FRAME, own * 0.05).when(mark == COMPOUND, own * F.when(links, 0.05).otherwise(0.5)).when(mark == ARTICLE, 0.5 + own / 2).otherwise(own)
    return tree.select("host", "node", F.get("above", F.lit(1)).alias("parent"), F.col("m").alias("pages"), mark.alias("mark"), "features", said.alias("importance"))


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    low: float = 0.1,
    least_pages: int = 5,
    broadcast_nodes: int = 1_000_000,
) -> DataFrame:
    """(page_id, url, text). ``low``: nodes of less importance are removed; ``broadcast_nodes``: so many such nodes, of all
    hosts together, are broadcast (8 bytes each); more are joined to pages by a shuffle."""
    host = F.lower(F.coalesce(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    tree = stage(site_tree(rows.select("host", "html"), least_pages=least_pages), "site_tree")
    # Where nothing but marked parts is important, low entropies say only that all pages are alike.
    some = tree.where((F.col("importance") >= low) & F.col("features").isNotNull() & F.col("parent").isNotNull()).select("host").distinct()
    told = F.col("mark") != PLAIN
    weak = tree.where((F.col("importance") < low) & (told | F.col("parent").isNotNull()))
    gone = weak.where(told).unionByName(weak.where(~told).join(some, "host", "left_semi")).select("host", "node", "parent")
    # Only the topmost: what lies below goes with them.
    top = gone.join(gone.select("host", F.col("node").alias("parent")), ["host", "parent"], "left_anti")
    sites = stage(top.groupBy("host").agg(F.collect_set("node").alias("low")), "low_nodes")
    total = sites.agg(F.sum(F.size("low"))).first()[0] or 0

    def run(batches):
        for batch in batches:
            texts, held = [], {}
            for page, host_low, name in zip(batch.column(2).to_pylist(), batch.column(4), batch.column(3).to_pylist()):
                if name not in held:
                    held = {name: frozenset(host_low.as_py() or ())}
                texts.append(main_text(page, held[name]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    placed = rows.join(F.broadcast(sites) if total <= broadcast_nodes else sites, "host", "left").select("page_id", "url", "html", "host", "low")
    kind = rows.schema["page_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"page_id {kind}, url string, text string")
