"""Main text of web pages with a site style tree.

Pages of one host are merged into a style tree: a node is a path of elements (tag with class and id) from the root.
Over the host's pages each node has a distribution of presentations (the sequence of its children's tags) and of contents (its
text). A node's importance joins the entropies of both, relative to the largest possible: a branch that looks
and reads the same on every page has importance near 0 and is removed, a branch that differs from page to page is kept. A
node seen on one page only has importance 1. Copies of a page (equal text outside noise elements) count as one page of
their host, and ``SMOOTHING`` lets two pages decide as well as thousands. Only the node that holds a text is judged, never its
ancestors; ``html`` and ``body`` are no nodes, and text that stands right in them is taken.

Entropy alone can't tell an advert that changes with each page from an article. So elements whose tag, role, class or id
says what they are add a prior to the importance of the nodes in them: menus, headers, footers, sidebars, notices, adverts,
forms and reader comments ``NOISE_PRIOR``, which outweighs any entropy, ``article`` and ``main`` ``MAIN_PRIOR``. All
branches are counted, and on every page a block is taken if the importance of its lowest node and its prior are together
at least ``LOW_IMPORTANCE``, so a marked branch is dropped if its text is the same on many pages, and an unmarked one that
differs from page to page is kept beside an article. Scripts, styles and other elements without text to read are cut.

A class or id says so as a whole word, or joined only with words of place or shape (``site-footer``, not ``no-sidebar``); one
of a heading, which names what follows, says nothing. A wrapper is no noise by its name, nor is a form: an element that
holds the page's first ``article`` or ``main``, or its first ``h1``, or, where no article is marked outside it, most of the page's
text. Elements that are noise by tag or role stay so unless they hold both the first article and most of the text, as an unclosed
menu does.

The tree is built by grouped counts, so a host with a third of all pages is summed up before it is shuffled. Each page
meets its host's list of low nodes, by broadcast if the lists are proven small, else by a shuffled join.

Defined results: a null or empty page has an empty text. A null address belongs to host ''. Repeated rows have a text each.
Broken markup is read as far as it goes: unclosed elements end with their parent (scripts, styles, titles and comments with the
page, as in browsers), stray ``<`` are text.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertide.llm.common import staged, table

LOW_IMPORTANCE = 0.2
PRESENTATION_SHARE = 0.2
NOISE_PRIOR = -0.85
MAIN_PRIOR = 0.18
SMOOTHING = 0.4  # unseen pages on which a node differs, added to those seen
BROADCAST_ROWS = 100_000

# Fixed values of the markup language.
BLOCKS = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
select summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CUT = set("audio canvas datalist head iframe noscript object script style svg template textarea title video".split())
NOISE_TAGS = set("aside button dialog footer form input map menu nav search select".split())
NOISE_ROLES = set("banner complementary contentinfo navigation search form dialog alertdialog menu menubar toolbar alert".split())
NOISE_NAMES = set("""ad ads adbox advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie
cookies disclaimer disqus footer form gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo
promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar
widget widgets""".split())
SITE_HEADER = {"header", "masthead", "topbar"}
PLACE_NAMES = set("""area bar block bottom box button buttons container footer global group inner item items left link links list main outer page
primary right secondary section site top wrap wrapper""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = set("base link meta noscript object script style template title".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[-_:.]+")
_node_ids: dict[tuple, int] = {}


def node_id(parent: int, tag: str, names: str) -> int:
    key = (parent, tag, names)
    if key not in _node_ids:
        if len(_node_ids) > 200_000:
            _node_ids.clear()
        digest = hashlib.blake2b(f"{parent} {tag} {names}".encode(), digest_size=8).digest()
        _node_ids[key] = int.from_bytes(digest, "little", signed=True)
    return _node_ids[key]


def text_id(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(100_000)
def says_noise(name: str, header: bool) -> bool:
    """Whether a class or id as a whole says that its element is no main text."""
    telling = NOISE_NAMES | SITE_HEADER if header else NOISE_NAMES
    parts = [p for p in _PARTS.split(name) if p]
    return any(p in telling for p in parts) and all(p in telling or p in PLACE_NAMES or p.isdigit() for p in parts)


@dataclass(slots=True)
class Element:
    tag: str
    node: int
    cut: bool
    noise: tuple[int, ...]  # numbers of the elements around it, itself included, that may be noise
    main: bool
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    blocks: list = field(default_factory=list)  # (node, prior, text)
    presentations: dict = field(default_factory=dict)  # node -> children's tags


def read_page(source: str) -> Page:
    """All blocks of a page with their priors, and the presentation of its nodes."""
    page = Page()
    root = Element("", 0, False, (), False)
    stack, text, at = [root], [], 0
    found_blocks: list[tuple[Element, str]] = []
    by_name: list[bool] = []  # of each element that may be noise: whether its name says so, or it is a form
    first: dict[str, tuple[int, ...]] = {}  # the first h1 and the first article, with what may be noise around them

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                found_blocks.append((next(e for e in reversed(stack) if not e.cut), " ".join(words)))
            text.clear()

    def close(depth: int) -> None:
        while len(stack) > depth:
            done = stack.pop()
            if done.children and not done.cut:
                page.presentations[done.node] = " ".join(done.children)

    for match in _TOKEN.finditer(source):
        if match.start() > at and not stack[-1].cut:
            text.append(source[at:match.start()])
        at = match.end()
        tag = match.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if match.group(2):
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                if any(e.tag in BLOCKS or e.node != stack[depth - 1].node for e in stack[depth:]):
                    flush()
                close(depth)
            continue
        block = tag in BLOCKS
        if tag not in HEAD_ONLY:  # anything else ends an open head
            depth = next((i for i in range(1, min(len(stack), 4)) if stack[i].tag == "head"), 0)
            if depth:
                flush()
                close(depth)
        if block:
            flush()
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open drawing
                if stack[i].tag == "svg":
                    close(i)
                    break
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCKS:
                    break
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPES.get(tag, ()):
                    break
                if stack[i].tag in CLOSES.get(tag, ()):
                    close(i)
                    break
        elif tag == "br":
            text.append(" ")
        parent = stack[-1]
        if not parent.children or parent.children[-1] != tag:
            parent.children.append(tag)
        attributes = match.group(4)
        if tag in VOID or (attributes.endswith("/") and (tag == "svg" or any(e.tag == "svg" for e in stack))):
            continue
        found = [(k.lower(), a or b or c) for k, a, b, c in _NAMES.findall(attributes)] if attributes else []
        names = [n for k, v in found if k != "role" for n in v.lower().split()]
        roles = {v.strip().lower() for k, v in found if k == "role"}
        article = tag in ("article", "main") or "main" in roles or "article" in roles
        cut = parent.cut or tag in CUT
        header = not parent.main
        named = tag not in ("html", "body", "main") and tag not in HEADINGS and any(says_noise(n, header) for n in names)
        noise = parent.noise
        if not cut and (named or tag in NOISE_TAGS or roles & NOISE_ROLES or (header and tag == "header")):
            noise = (*noise, len(by_name))
            by_name.append(not (tag in NOISE_TAGS - {"form"} or roles & NOISE_ROLES - {"form"} or (header and tag == "header")))
        if article and not cut and not all(says_noise(n, header) for n in names or [""]):
            first.setdefault("article", noise)
        elif tag == "h1" and not cut and all(by_name[k] for k in noise):
            first.setdefault("h1", noise)
        if noise != parent.noise:
            flush()
        own = tag not in ("html", "body") and (block or noise != parent.noise)
        node = node_id(parent.node, tag, " ".join(sorted(v for _, v in found))) if own else parent.node
        stack.append(Element(tag, node, cut, noise, parent.main or article))
    if at < len(source) and not stack[-1].cut:
        text.append(source[at:])
    flush()
    close(1)
    chars = [0] * len(by_name)
    for top, words in found_blocks:
        for k in top.noise:
            chars[k] += len(words)
    half = sum(len(words) for _, words in found_blocks) / 2
    around = set(first.get("article", ()))
    wrappers = {k for k, named in enumerate(by_name) if (
        k in around or k in first.get("h1", ()) or ("article" not in first and chars[k] > half) if named
        else k in around and chars[k] > half)}
    for top, words in found_blocks:
        prior = NOISE_PRIOR if not wrappers.issuperset(top.noise) else MAIN_PRIOR if top.main else 0.0
        page.blocks.append((top.node, prior, words))
    return page


def main_text(page: Page, importance: dict[int, float], low_importance: float = LOW_IMPORTANCE) -> str:
    """Blocks joined by a line end whose joint importance is high enough; a node that isn't listed has importance 1."""
    return "\n".join(t for node, prior, t in page.blocks if importance.get(node, 1.0) + prior >= low_importance)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def site_nodes(pages: DataFrame) -> DataFrame:
    """One row per node with text of each page: ``host, page, node, look, content`` (hashes; copies of a page have one
    ``page``; a look is null where a node has none)."""
    def read(batches):
        for batch in batches:
            hosts, copies, nodes, looks, contents = [], [], [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
                page = read_page(source.as_py() or "")
                told = [t for _, prior, t in page.blocks if prior > NOISE_PRIOR]
                copy = text_id("\n".join(told or [t for _, _, t in page.blocks]))
                texts: dict[int, list[str]] = {}
                for node, _, text in page.blocks:
                    if node:
                        texts.setdefault(node, []).append(text)
                for node, body in texts.items():
                    hosts.append(host)
                    copies.append(copy)
                    nodes.append(node)
                    looks.append(node_id(0, "look", page.presentations[node]) if node in page.presentations else None)
                    contents.append(text_id("\n".join(body)))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (copies, nodes, looks, contents))],
                                             names=["host", "page", "node", "look", "content"])

    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    return rows.mapInArrow(read, "host string, page bigint, node bigint, look bigint, content bigint")


def node_importance(nodes: DataFrame) -> DataFrame:
    """``host, node, pages, importance`` from the entropies of presentation and content over a host's distinct pages."""
    nodes = nodes.groupBy("host", "node", "page").agg(F.min("look").alias("look"), F.min("content").alias("content"))

    def entropy(column: str) -> DataFrame:
        counts = nodes.where(F.col(column).isNotNull()).groupBy("host", "node", column).agg(F.count("*").alias("c"))
        per = counts.groupBy("host", "node").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.ln("c")).alias("s"))
        m = F.col("m")
        return per.select("host", "node", m.alias(f"{column}_pages"),
                          F.when(m > 1, ((F.ln(m) - F.col("s") / m) / F.ln(m) * m + SMOOTHING) / (m + SMOOTHING)).otherwise(1.0)
                          .alias(f"{column}_entropy"))

    both = entropy("look").join(entropy("content"), ["host", "node"], "full")
    look, content = F.col("look_entropy"), F.col("content_entropy")
    joined = F.when(content.isNull(), look).when(look.isNull(), content).otherwise(
        look * PRESENTATION_SHARE + content * (1 - PRESENTATION_SHARE))
    return both.select("host", "node", F.greatest("look_pages", "content_pages").alias("pages"), joined.alias("importance"))


def extract_main_text(pages: DataFrame, low_importance: float = LOW_IMPORTANCE) -> DataFrame:
    """``page_id, url, text`` of every page."""
    # Entropies sum in another order on another run: rounding keeps the verdict the same.
    tree = node_importance(staged(site_nodes(pages), "site-nodes"))
    low = (tree.where(F.round("importance", 9) < low_importance)
           .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("node", F.round("importance", 9).alias("importance")))).alias("low")))
    low = staged(low, "site-low")
    bounded = (low.agg(F.coalesce(F.sum(F.size("low")), F.lit(0)).alias("n")).first()["n"] or 0) <= BROADCAST_ROWS
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(low) if bounded else low, "host", "left").drop("host")

    def extract(batches):
        for batch in batches:
            texts = [main_text(read_page(source.as_py() or ""), {x["node"]: x["importance"] for x in nodes.as_py() or ()}, low_importance)
                     for source, nodes in zip(batch.column("html"), batch.column("low"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
