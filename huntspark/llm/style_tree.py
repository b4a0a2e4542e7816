"""Main text of web pages by a site style tree: branches that a host repeats, or that are marked as no content, go."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.llm.url_rules import host_and_path
from huntspark.plans.lineage_cut import cut

THRESHOLD = 0.4  # importance below which a branch goes
LEAST_PAGES = 10  # pages of a host that must have a branch before its repetition counts
GAMMA = 0.9  # share of the content in a node's importance, the rest is its presentation

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tr td th b i em strong a span br".split())
NO_CONTENT = frozenset(
    "head script style noscript template nav header footer aside form button select textarea input iframe object svg canvas dialog menu "
    "title".split()
)
ALWAYS = NO_CONTENT - {"form"}  # a form may span the page; like a marked class it gives way where nothing else is left
MAIN = frozenset("article main".split())
NO_CONTENT_WORD = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|"
    r"side-?bar|nav\w*|menu|breadcrumbs?|header|footer|masthead|comments?|replies|share|sharing|social|related|widget|login|search|"
    r"skip|toolbar|pagination|contentinfo|complementary|navigation)(?:$|[^a-z])"
)
MAIN_WORD = re.compile(r"(?:^|[^a-z])main(?:$|[^a-z])")
TOLD = re.compile(r"(?:has|have|no|not|with|without|is|show|hide|open|enable[ds]?|disable[ds]?|layout)[^a-z]")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article main section div table td th ul ol dl nav aside header footer form blockquote".split())


def role(tag: str, marks: str) -> int:
    """2 main, 0 no content, 1 anything else. A main tag or name wins over other names; a name like ``main-menu`` is none,
    and one like ``has-sidebar`` only tells of a part."""
    names = marks.split()
    if tag in MAIN or tag not in NO_CONTENT and any(MAIN_WORD.search(n) and not NO_CONTENT_WORD.search(n) for n in names):
        return 2
    return 0 if tag in NO_CONTENT or any(NO_CONTENT_WORD.search(n) and not TOLD.match(n) for n in names) else 1


class Node:
    __slots__ = ("sig", "path", "role", "protected", "main", "above", "children", "texts")

    def __init__(self, sig, path, role_, protected, main=False, above=None):
        self.sig, self.path, self.role, self.protected, self.main, self.above = sig, path, role_, protected, main, above
        self.children, self.texts = [], []


def parse(page: str | None) -> Node:
    """The page as a tree. Text runs and child nodes stand in page order in ``children``; open ends are closed as browsers
    do for paragraphs, list items and cells, and at the end of the page. What the longest main node stands in is protected."""
    root = Node("", "", 1, False)
    stack, tags, at, page = [root], [""], 0, page or ""

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(html.unescape(piece))

    def leave(to: int) -> None:
        del stack[to:], tags[to:]

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        close, tag, rest = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if close:
            if tag in tags:
                leave(len(tags) - 1 - tags[::-1].index(tag))
            continue
        ends = CLOSES.get(tag) or ({"p"} if tag in BLOCK else ())
        for k in range(len(tags) - 1, 0, -1):
            if tags[k] in ends:
                leave(k)
                break
            if tags[k] in SCOPE:
                break
        marks = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(rest)).lower() if rest and not rest.isspace() else ""
        marks = re.sub(r"\d+", "#", marks)
        sig, above = (f"{tag}.{marks}" if marks else tag), stack[-1]
        what = role(tag, marks)
        held = above.protected and tag in FLOW and (not marks or above.main and what == 1)
        node = Node(sig, f"{above.path}/{sig}", what, what == 2 or tag in ("html", "body") or held, what == 2 or held and above.main, above)
        above.children.append(node)
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = found.end() if found else end
        elif tag not in VOID and not rest.endswith("/"):
            stack.append(node)
            tags.append(tag)
    longest = max(_main_nodes(root), default=(0, 0, None), key=lambda x: x[:2])[2]
    while longest is not None and longest.above is not None:
        longest = longest.above
        longest.protected = True
    return root


def _main_nodes(root: Node) -> Iterator[tuple[int, int, Node]]:
    """Length of the text, place (first ones higher) and node of the main nodes."""
    order, todo, length = [], [root], {}
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    for k in range(len(order) - 1, -1, -1):
        node = order[k]
        length[id(node)] = sum(len(c.strip()) if isinstance(c, str) else length[id(c)] for c in node.children)
        if node.role == 2:
            yield length[id(node)], -k, node


def blocks(node: Node, removed: frozenset[str] | set[str], marked: bool = True) -> list[str]:
    """Texts of the blocks under ``node`` in page order, without removed paths, nor those that a tag marks no content; ``marked``:
    nor those that a form or a class marks."""
    done, open_ = [], []

    def stop() -> None:
        line = " ".join("".join(open_).split())
        open_.clear()
        if line:
            done.append(line)

    todo = [iter(node.children)]
    breaks = [False]
    while todo:
        for child in todo[-1]:
            if isinstance(child, str):
                open_.append(child)
                continue
            tag = child.sig.partition(".")[0]
            if tag == "br":
                open_.append(" ")
            if not child.protected and (child.path in removed or (child.role == 0 and (marked or tag in ALWAYS))) or tag in RAW:
                if tag in BLOCK:
                    stop()
                continue
            if tag in BLOCK:
                stop()
            todo.append(iter(child.children))
            breaks.append(tag in BLOCK)
            break
        else:
            todo.pop()
            if breaks.pop():
                stop()
    stop()
    return done


def features(page: str | None) -> Iterator[tuple[str, int, bool, int, int]]:
    """Of every node: path, role, whether it is protected, a hash of its child signatures, a hash of its text."""
    order, todo = [], [parse(page)]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if not isinstance(c, str)]
    texts: dict[int, str] = {}
    for node in reversed(order):
        texts[id(node)] = " ".join("".join(c if isinstance(c, str) else f" {texts.pop(id(c))} " for c in node.children).split())
        sigs = [c.sig for c in node.children if not isinstance(c, str)]
        shape = " ".join(s for k, s in enumerate(sigs) if k == 0 or s != sigs[k - 1])
        if node.path:
            yield node.path, node.role, node.protected, _hash(shape), _hash(texts[id(node)])


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def low_branches(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, paths): of ``pages`` (host, html) the paths whose importance on their host is below ``threshold``.

    The nodes of a host's pages are merged by path. A node's content importance is 1 less the mean of log(uses of its
    text) / log(pages that have the path): 1 if every page has its own text, 0 if all share one. Its presentation
    importance is the entropy of its child sequences over the same logarithm. Both are counted over all pages, summed per
    task first. A path with fewer than ``least_pages`` pages has importance 1. Marks do not count here.
    """

    def run(batches):
        kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["host", "path", "role", "protected", "shape", "content", "first"]
        for b in batches:
            rows = []
            for k, (host, page) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                seen = set()
                for path, *rest in features(page):
                    rows.append((host, path, *rest, path not in seen))
                    seen.add(path)
                if rows and (len(rows) > 20_000 or k + 1 == b.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    nodes = pages.select("host", "html").mapInArrow(
        run, "host string, path string, role int, protected boolean, shape long, content long, first boolean"
    )
    counted = cut(
        nodes.where("not protected")
        .groupBy("host", "path", "shape", "content")
        .agg(F.count("*").alias("n"), F.sum(F.col("first").cast("long")).alias("pages"), F.min("role").alias("role"))
    )
    key = ["host", "path"]
    content = counted.groupBy(*key, "content").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"), F.min("role").alias("role"))
    content = content.groupBy(*key).agg(
        F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.min("role").alias("role"),
        F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("repeated"),
    )
    shape = counted.groupBy(*key, "shape").agg(F.sum("n").alias("n")).groupBy(*key).agg(
        F.sum("n").alias("shapes"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("alike")
    )
    spread = F.log(F.greatest(F.col("pages"), F.lit(2)).cast("double"))
    own = F.greatest(F.lit(0.0), 1 - F.col("repeated") / F.col("n") / spread)
    look = F.least(F.lit(1.0), (F.log(F.col("shapes").cast("double")) - F.col("alike") / F.col("shapes")) / spread)
    importance = F.when(F.col("pages") < least_pages, 1.0).otherwise(GAMMA * own + (1 - GAMMA) * look)
    low = content.join(shape, key).where(importance < threshold)
    return low.groupBy("host").agg(F.collect_set("path").alias("paths"))


def main_text(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``pages`` (page_id, url, html) as rows (page_id, url, text, n_chars).

    Blocks in page order joined by one line feed, white space inside a block as one space, references decoded. Null and
    empty pages have an empty text; broken markup is read as far as it goes; where nothing else is left, what a form or a
    class marks as no content stays by its importance; a page whose every branch is repeated on its host loses only what is
    marked; repeated rows stay. Pages without a host are one site.
    """
    rows = pages.select("page_id", "url", "html", host_and_path(F.col("url"))[0].alias("host"))
    low = cut(low_branches(rows, threshold, least_pages))

    def run(batches):
        for b in batches:
            texts = []
            for page, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                root = parse(page)
                low = frozenset(paths or ())
                texts.append("\n".join(blocks(root, low) or blocks(root, low, False) or blocks(root, frozenset())))
            columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    id_type = rows.schema["page_id"].dataType.simpleString()
    return rows.join(low, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(
        run, f"page_id {id_type}, url string, text string, n_chars long"
    )
