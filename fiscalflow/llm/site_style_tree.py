"""Main text of web pages by site style trees.

Pages of a host are merged into one tree: a node is an element path (tags with their
classes), and on every page it has a style, the sequence of its child elements, and text
of its own.  Over the m pages that have a node:

* presentation importance: the entropy (base m) of its styles;
* content importance: 1 minus the mean, over its texts, of log_m(pages with that text); a text
  that is on all pages scores 0, one that is on a single page 1;
* composite importance: (1 - g^c) * presentation + g^c * mean content importance of the
  branch, with c child elements and g = 0.9.

Branches below ``least`` composite importance on at least ``least_pages`` different pages are
noise and are removed from each page, and so is a text that is on ``shared`` of the pages (and as many)
that have its node, whatever the node.  Besides, elements that say what they are (nav, footer,
aside, form, role and class names of menus, adverts, notices, comments ...) are always removed.
Inside an article or main element, a name counts if it is a noise name as a whole or has a strong
one as a part (class names, and ids but of sections); one that only has a weak one as a part
leaves the decision to the importance.  Ids of headings repeat their words and never count.
An article or main element is a prior, not a rule: if at least half of the text that is left on a page is in its
main element, or else in its articles, the rest is left out; a page whose only article is a teaser is read
whole.  Plain paragraphs and headings of articles aren't removed as nodes, since all paragraphs of an article are one
node of the tree, but text by text.  Where nothing would be left, weak names and then the statistics give way.

Copies of a page count once in the statistics.  Statistics are partial aggregates on
hashes; a page gets the list of its own removed nodes, joined on a hash of host and page, so
that neither a host's tree nor its pages are gathered anywhere.

Defined cases: null html is empty and gives the empty text; a null or odd URL belongs to the
host ""; markup that isn't closed is closed by its parent; repeated rows get equal texts; an
empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import TEXTS, batches, saved, small

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table tbody thead tr td th figure figcaption b i em strong a span code br sub sup q cite".split())
NOISE_TAGS = frozenset("head script style noscript template nav footer aside form button select textarea input iframe object embed svg canvas "
                       "menu dialog noembed noframes title label fieldset audio video".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form note".split())
NOISE_NAMES = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs footer header masthead topbar sidebar side aside widget widgets related "
                        "recommended share sharing social ad ads advert adverts advertisement advertising promo promotion sponsor sponsored "
                        "banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
                        "search comment comments disqus respond reply replies pagination pager copyright legal disclaimer toolbar".split())
# last parts of names that add nothing to what stands before them
BOX_NAMES = frozenset("area articles banner bar block body box button card cell column container content count form frame grid group holder inner item items "
                      "label layer link links list module notice outer panel posts row section slot stories text thread title unit widget wrap wrapper zone".split())
# names that mark noise wherever they stand; other names may only describe the layout of what they wrap
STRONG_NAMES = frozenset("comment comments disqus respond reply replies ad ads advert adverts advertisement advertising promo promotion sponsor sponsored "
                         "related recommended cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MODIFIER = re.compile(r"^(has|with|no|without|is|js)[-_]")
# an element of the key closes open elements of the value, up to their parent
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
STOPS = frozenset("ul ol dl table html body article main section div nav aside footer header form td th blockquote".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z:_-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PART = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "path", "noise", "soft", "plain", "inside", "children")

    def __init__(self, tag: str, path: str, noise: bool, soft: bool, plain: bool, inside: bool):
        self.tag, self.path, self.noise, self.soft, self.plain, self.inside = tag, path, noise, soft, plain, inside
        self.children: list[Node | str] = []


def parse(page: str, lenient: bool = False) -> Node:
    """Element tree; ``inside`` is set below an article or main element.

    ``soft`` noise is only named like noise (or a form) and turns out to be layout if it wraps
    an article or main element.  ``lenient``: outside of those, weak names are no noise.
    """
    root = Node("", "", False, False, True, False)
    open_ = [root]
    at, end = 0, len(page)
    lower = None
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        text = m[4]
        if text is not None:
            open_[-1].children.append(text)
            continue
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                open_[-1].children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
            continue
        if tag in BLOCK or tag in CLOSES:
            shut = CLOSES.get(tag, ())
            for k in range(len(open_) - 1, 0, -1):
                t = open_[k].tag
                if t in shut or t == "p" and tag in BLOCK:
                    del open_[k:]
                    break
                if t in STOPS:
                    break
        up = open_[-1]
        names, whole, slug, role, strong = set(), set(), set(), "", False
        label = tag
        if m[3] and ("class" in m[3] or "id" in m[3] or "role" in m[3] or "CLASS" in m[3] or "ID" in m[3]):
            for name, value in ATTRIBUTE.findall(m[3]):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id"):
                    if name == "id" and tag in HEADINGS:
                        continue  # repeats the heading's words
                    own = [part for part in value.split() if not MODIFIER.match(part)]
                    whole.update(own)
                    for part in own:
                        words = NAME_PART.findall(part)
                        heading = name == "id" and tag == "section"
                        (slug if heading else names).update(words)
                        strong = strong or not (heading and up.inside) and is_strong(words)
                    if name == "class" and value:
                        label = f"{tag}.{'.'.join(sorted(value.split()))}"
                elif name == "role":
                    role = value
        inside = up.inside or tag in ("article", "main")
        weak = False
        if tag in ("article", "main"):
            noise, soft = tag == "article" and strong, False
        else:
            if up.inside:  # there, a part of a name is only a hint, and the node's importance decides
                named = bool(whole & NOISE_NAMES) or strong
                weak = bool(names & NOISE_NAMES) and not named
            else:
                named = strong if lenient else bool((names | slug) & NOISE_NAMES)
            named = named and tag not in ("html", "body")
            noise = tag in NOISE_TAGS or tag == "header" and not up.inside or role in NOISE_ROLES or named
            soft = noise and not strong and (tag == "form" or tag not in NOISE_TAGS and tag != "header" and role not in NOISE_ROLES)
        node = Node(tag, f"{up.path}/{label}", noise, soft, tag in PLAIN and label == tag and not weak, inside)
        if tag in ("article", "main") and not noise:
            for n in open_:
                n.noise = n.noise and not n.soft
        up.children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            # lower() may change lengths beyond ASCII; then search the text itself
            close = (lower if len(lower) == end else page).find(f"</{tag}", at)
            at = end if close < 0 else close
            if tag == "title":
                continue
        open_.append(node)
    return root


def is_strong(words: list[str]) -> bool:
    """Whether the parts of a name say noise: the last one does, or it only says what kind of box it is."""
    return any(w in STRONG_NAMES for w in words) and (words[-1] in STRONG_NAMES or words[-1] in BOX_NAMES or words[-1].isdigit())


def squeezed(text: str) -> str:
    return " ".join(htmllib.unescape(text).split())


def walk(root: Node) -> Iterator[Node]:
    """The nodes that aren't in noise, in page order."""
    todo = [root]
    while todo:
        n = todo.pop()
        if n.noise:
            continue
        yield n
        todo += [c for c in reversed(n.children) if isinstance(c, Node)]


def h64(*parts: str) -> int:
    x = xxhash.xxh64_intdigest("\x00".join(parts))
    return x - (1 << 64) if x >> 63 else x


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def node_key(host: str, path: str) -> int:
    return h64("n", host, path)


def page_rows(url: str | None, page: str | None) -> list[tuple[int, int, int, int | None, list[int] | None]]:
    """(page, node, value, meta, up) for styles and texts.

    A style has meta = 2 * child elements + prunable, and the keys of its branch upwards; a
    text has no meta, and the key of itself.  Keys of nodes hold the host.
    """
    if not page:
        return []
    host = host_of(url)
    ph = h64("p", host, page)
    styles: dict[str, list[str]] = defaultdict(list)
    texts: dict[str, set[str]] = defaultdict(set)
    count: dict[str, int] = defaultdict(int)
    prunable: dict[str, bool] = {}
    for n in walk(parse(page)):
        if not n.path or n.tag in ("html", "body"):
            continue
        kids = [c.tag for c in n.children if isinstance(c, Node)]
        styles[n.path].append(",".join(kids))
        count[n.path] = max(count[n.path], len(kids))
        prunable[n.path] = not kept_by_place(n)
        own = own_text(n)
        if own:
            texts[n.path].add(own)
    out = []
    for path, seq in styles.items():
        steps = path.split("/")
        ups = [node_key(host, "/".join(steps[:k])) for k in range(2, len(steps) + 1)]
        out.append((ph, ups[-1], h64("s", *seq), 2 * count[path] + prunable[path], ups))
        # the list: the key by which the text is removed from the page
        out += [(ph, ups[-1], h64("t", t), None, [text_key(ups[-1], h64("t", t))]) for t in texts[path]]
    return out


ROWS = pa.schema([("page", pa.int64()), ("node", pa.int64()), ("value", pa.int64()), ("meta", pa.int64()), ("up", pa.list_(pa.int64()))])
ROWS_SQL = "page long, node long, value long, meta long, up array<long>"


def tree_rows(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Distinct rows of all pages: copies of a page count once."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [r for u, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in page_rows(u, t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(ROWS.types)], schema=ROWS)

    rows = batches(pages.select(F.col(url).cast("string"), F.col(html).cast("string")), run, ROWS_SQL, TEXTS)
    return rows.dropDuplicates(["page", "node", "value", "meta"])


def node_importance(rows: DataFrame, gamma: float = 0.9) -> DataFrame:
    """(node, pages, presentation, content, importance, prunable) of distinct ``rows``."""
    n = F.col("n").cast("double")
    styled = rows.where("meta is not null").groupBy("node", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.shiftright("meta", 1)).alias("children"), F.min(F.col("meta").bitwiseAND(1)).alias("prunable"),
        F.first("up").alias("up"))
    styles = styled.groupBy("node").agg(
        F.sum("n").alias("pages"), F.sum(n * F.log(n)).alias("nlogn"), F.max("children").alias("children"),
        F.min("prunable").alias("prunable"), F.first("up").alias("up"))
    m = F.col("pages").cast("double")
    styles = styles.withColumn("presentation", F.when(F.col("pages") > 1, (F.log(m) - F.col("nlogn") / m) / F.log(m)).otherwise(F.lit(1.0)))
    texts = (rows.where("meta is null").groupBy("node", "value").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("node").agg(F.sum(F.log(n)).alias("logs"), F.count(F.lit(1)).alias("texts")))
    own = texts.join(styles.select("node", "pages", "up"), "node")
    score = F.col("texts") - F.when(F.col("pages") > 1, F.col("logs") / F.log(m)).otherwise(F.lit(0.0))
    branch = (own.select(F.explode("up").alias("node"), score.alias("score"), "texts")
              .groupBy("node").agg((F.sum("score") / F.sum("texts")).alias("content")))
    out = styles.join(branch, "node", "left")
    g = F.pow(F.lit(gamma), F.col("children").cast("double"))
    return out.select("node", "pages", "prunable", "presentation", "content",
                      ((F.lit(1.0) - g) * F.col("presentation") + g * F.coalesce("content", F.lit(0.0))).alias("importance"))


def common_texts(rows: DataFrame, least_pages: int, shared: float) -> DataFrame:
    """(node): keys of texts that are on ``shared`` of the pages that have their node, and on ``least_pages`` at least."""
    pages = rows.where("meta is not null").groupBy("node").agg(F.countDistinct("page").alias("pages"))
    texts = rows.where("meta is null").groupBy("node", "value").agg(F.count(F.lit(1)).alias("n"), F.first("up").alias("up"))
    texts = texts.where(F.col("n") >= least_pages)
    return texts.join(pages, "node").where(F.col("n") >= shared * F.col("pages")).select(F.col("up")[0].alias("node"))


def main_text(page: str | None, removed: set[int], host: str = "") -> str:
    """Blocks of the page without noise and ``removed`` nodes and texts.

    A main element, or else the articles, are the page's text if at least half of what is left is in them.  If nothing is left, weak names
    are taken for content, and then removed nodes too.
    """
    if not page:
        return ""
    for gone, lenient in ((removed, False), (removed, True), (set(), False), (set(), True)):
        root = parse(page, lenient)
        found = blocks_of(root, gone, host)
        if found:
            tags = {n.tag for n in walk(root)}
            region = next((t for t in ("main", "article") if t in tags), None)
            inside = blocks_of(root, gone, host, region) if region else []
            return "\n".join(inside if 2 * sum(map(len, inside)) >= sum(map(len, found)) else found)
    return ""


def own_text(node: Node) -> str:
    return squeezed(" ".join(c for c in node.children if isinstance(c, str)))


def blocks_of(root: Node, removed: set[int], host: str, region: str | None = None) -> list[str]:
    """Texts of the blocks, of elements ``region`` alone if it is given."""
    out, words = [], []

    def flush() -> None:
        if words and (t := squeezed("".join(words))):
            out.append(t)
        words.clear()

    # an explicit stack: pages may nest deeper than Python's calls
    todo: list[tuple[Node | str | None, bool]] = [(root, region is None)]
    while todo:
        n, on = todo.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            if on:
                words.append(n)
        elif n.noise:
            continue
        else:
            on = on or n.tag == region
            if removed:
                key = node_key(host, n.path)
                gone = not kept_by_place(n) and key in removed
                if gone or n.tag in BLOCK and (own := own_text(n)) and text_key(key, h64("t", own)) in removed:
                    if n.tag in BLOCK:
                        flush()
                    continue
            if n.tag in ("br", "td", "th", "img"):
                words.append(" ")
            if n.tag in BLOCK:
                flush()
                todo.append((None, on))
            todo += [(c, on) for c in reversed(n.children)]
    flush()
    return out


def kept_by_place(n: Node) -> bool:
    """Plain nodes of articles stay as nodes, whatever their importance; their texts may still go."""
    return n.inside and (n.plain or n.tag in ("article", "main"))


def text_key(node: int, text: int) -> int:
    return h64("nt", str(node), str(text))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: float = 0.35,
            least_pages: int = 8, shared: float = 0.8, broadcast_rows: int = 100_000) -> DataFrame:
    """page_id, url and text (main text, blocks joined by newlines) of every row."""
    rows = saved(tree_rows(pages, url, html))
    low = node_importance(rows).where((F.col("importance") < least) & (F.col("pages") >= least_pages) & (F.col("prunable") == 1))
    low = saved(low.select("node"))
    common = saved(common_texts(rows, least_pages, shared))
    by_node = rows.where("meta is not null").select("page", "node").join(small(low, broadcast_rows), "node").select("page", "node")
    by_text = rows.where("meta is null").select("page", F.col("up")[0].alias("node")).join(small(common, broadcast_rows), "node").select("page", "node")
    removed = by_node.union(by_text).groupBy("page").agg(F.collect_set("node").alias("__removed"))
    d = pages.select(F.col(page_id), F.col(url).cast("string"), F.col(html).cast("string"))
    return texts_of(d, saved(removed), page_id, url, html, broadcast_rows)


def texts_of(d: DataFrame, removed: DataFrame, page_id: str, url: str, html: str, broadcast_rows: int) -> DataFrame:
    def keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            k = [h64("p", host_of(u), t) if t else 0 for u, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k, pa.int64())], names=names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            t = [main_text(p, set(r or ()), host_of(u)) for u, p, r in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(t, pa.string())], names=out_names)

    names, out_names = [page_id, url, html, "page"], [page_id, url, "text"]
    kind = d.schema[page_id].dataType.simpleString()
    keyed = batches(d, keys, f"`{page_id}` {kind}, `{url}` string, `{html}` string, page long", TEXTS)
    joined = keyed.join(small(removed, broadcast_rows // 10), "page", "left").select(page_id, url, html, "__removed")
    return batches(joined, run, f"`{page_id}` {kind}, `{url}` string, text string", TEXTS)
