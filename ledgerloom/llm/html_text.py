"""Main text of web pages by removal of a site's recurring subtrees.

Pass one parses each page, hashes every block element's subtree (its tags and
text, not its attributes) and counts, per host, in how many different
surroundings a subtree stands: pages whose text (that of the article or main
element, if there is one) without the subtree is the same have one vote
together, so that copies of a page make no template of its text.
Pass two leaves out the subtrees with enough votes and elements that are never
main text by their tag (navigation, footers, scripts, forms and so on) or that say
so in a whole token of their class, id or role, and keeps the article or main
element if the page has one, else the body. An element that says so stays if it
holds an article or over half of the page's text, but not if it is marked as
comments, an advert or a form: these go wherever and however large they are.

Recurrence removes whole blocks around the text wherever they stand. Inside an
article, headings and paragraphs are prose and no template, nor is a subtree
with over half of its page's text.

Blocks are joined by a space, white space inside a block becomes one space,
character references are decoded, nothing is cut off.

Nulls and odd rows: null and empty html give an empty text; a null url (or one
without a host) is the host ''; rows that share a page_id are extracted each on
its own, equal pages have one vote; malformed markup is closed as browsers
close it, roughly; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import materialise, read, ship, spread_join

#: Elements that are never main text. HTML names.
DROPPED = frozenset("""nav footer aside form script style noscript template iframe object svg canvas
button select option textarea input label fieldset dialog menu head title audio video map""".split())
#: Elements that break the text into blocks. HTML names.
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div
dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main
menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
#: Elements without content. HTML names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup. HTML names.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: What a start tag closes if it is still open, up to the nearest boundary. HTML rules.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Start tags that close an open paragraph.
ENDS_P = BLOCKS - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "body", "html"}
#: Words of a class, id or role (parted by signs) that mark a block as no main text.
MARKS = re.compile(r"""ads?|adsbygoogle|advert\w*|sponsor\w*|promo\w*|comments?|disqus|respond|reply|replies|
    newsletters?|subscri(?:be|ption)\w*|login|signup|search|banner|cookies?|consent|gdpr|notices?|popup|modal|
    overlay|shar(?:e|ing)|social|related|recommend\w*|sidebar|widgets?|menu|navbar|nav|navigation|breadcrumbs?|
    masthead|footer|toolbar|pagination|pager|skip|alert|complementary|contentinfo|copyright|legal""",
                   re.IGNORECASE | re.VERBOSE)
#: Those of adverts, comments and forms; such a block stays out however large it is.
NEVER = re.compile(r"""ads?|adsbygoogle|advert\w*|sponsor\w*|promo\w*|comments?|disqus|respond|reply|replies|
    newsletters?|subscri(?:be|ption)\w*|login|signup""", re.IGNORECASE | re.VERBOSE)
#: Words of place, shape and kind that may stand beside them; any other word makes a
#: token say something else (no-sidebar, with-header, search-results).
BESIDE = frozenset("""site page main global top bottom left right primary secondary sticky fixed box bar block list
area container wrapper wrap inner outer link links button buttons icon icons form section user users reader readers
post posts article articles story stories blog thread threads slot slots unit zone signup content contents item items
feed text title count info warning error success hint message side mobile desktop""".split())
#: The same, but only outside article and main, as the header element.
HEADER = re.compile(r"(?:site|page|main|global|top)?[_-]?header", re.IGNORECASE)
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre br table thead tbody tr td th ol ul li dl dt dd figure figcaption".split())
MAIN = frozenset({"article", "main"})

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)
    |</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)
    |<([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">]|["'](?=[^"'>]*>))*)(?:>|$)""", re.DOTALL | re.VERBOSE)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_UNSEEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)


def _says(token: str) -> int:
    """1 if a class, id or role token marks a block as no main text, 2 if as an advert,
    comments or a form, else 0."""
    words = [w for w in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", token) if w and not w.isdigit()]
    marks = [w for w in words if MARKS.fullmatch(w)]
    if not marks or any(w.lower() not in BESIDE for w in words if w not in marks):
        return 0
    return 2 if any(NEVER.fullmatch(w) for w in marks) else 1


def _marked(attrs: str, in_main: bool) -> int:
    """Whether the attributes hide an element or say that it is no main text; as
    :func:`_says`."""
    found = 0
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for token in value.split():
                found = max(found, _says(token), int(not in_main and bool(HEADER.fullmatch(token))))
        elif name in ("itemprop", "itemtype") and re.search(r"(?:^|[\s/])comment\s*$", value, re.IGNORECASE):
            found = 2
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" \
                or name == "style" and _UNSEEN.search(value):
            found = max(found, 1)
    return found


class Node:
    __slots__ = ("tag", "inside", "out")

    def __init__(self, tag: str, out: bool):
        self.tag, self.inside, self.out = tag, [], out


def parse(html: str | None) -> Node:
    """The element tree: nodes, text (decoded) between them."""
    root = Node("", False)
    open_ = [root]
    marked: list[Node] = []
    html = html or ""
    at = 0

    def text(a: int, b: int) -> None:
        if a < b:
            open_[-1].inside.append(unescape(html[a:b]))

    def close(names, until=frozenset({"table", "article", "main", "body", "section", "div", ""})) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in names:
                del open_[i:]
                return
            if open_[i].tag in until:
                return

    pos = 0
    while (m := _TOKEN.search(html, pos)) is not None:
        text(at, m.start())
        at = pos = max(m.end(), m.start() + 1)
        ended, name = m.group(1), m.group(2)
        if ended:
            ended = ended.lower()
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == ended:
                    del open_[i:]
                    break
                # an inline end tag does not reach out of its block
                if ended not in BLOCKS and open_[i].tag in BLOCKS:
                    break
        elif name:
            name = name.lower()
            attrs = m.group(3)
            if name in ENDS_P:
                close({"p"})
            if name in CLOSES:
                close(CLOSES[name], frozenset({"ul", "ol", "dl", "table", "select", ""}))
            in_main = any(n.tag in MAIN for n in open_)
            out = name in DROPPED or name == "header" and not in_main
            node = Node(name, out)
            if not out and attrs and name not in ("html", "body", "main"):
                says = _marked(attrs, in_main)
                # an article is left out only as a comment or an advert
                if says and (name != "article" or says == 2):
                    node.out = True
                    if says == 1:
                        marked.append(node)
            open_[-1].inside.append(node)
            if name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                at = pos = end.start() if end else len(html)
                if end:
                    pos = at = (html.find(">", end.end()) + 1) or len(html)
            elif name not in VOID and not attrs.rstrip().endswith("/"):
                open_.append(node)
    text(at, len(html))
    if marked:
        _spare(root, marked)
    return root


def _spare(root: Node, marked: list[Node]) -> None:
    """Marked elements stay if they hold over half of the page's text, that of
    elements left out by tag aside, or, outside article and main, one of these.
    Adverts, comments and forms are not among them."""
    own = {id(n) for n in marked}
    sizes: dict[int, tuple[int, bool]] = {}
    order, todo = [], [(root, False)]
    while todo:
        n, inside = todo.pop()
        order.append((n, inside))
        todo.extend((c, inside or n.tag in MAIN) for c in n.inside
                    if isinstance(c, Node) and (not c.out or id(c) in own))
    for n, _ in reversed(order):
        size, main = 0, n.tag in MAIN
        for c in n.inside:
            if isinstance(c, str):
                size += len(" ".join(c.split()))
            elif id(c) in sizes:
                size += sizes[id(c)][0]
                main = main or sizes[id(c)][1]
        sizes[id(n)] = size, main
    total = sizes[id(root)][0]
    for n, inside in order:
        if id(n) in own:
            size, main = sizes[id(n)]
            n.out = not (2 * size > total or main and not inside)


def walk(node: Node, visit, above: tuple = ()) -> tuple[str, int, int]:
    """Children before parents: each block's subtree string, its text's length and
    the sum of the hashes of its text's pieces go to ``visit``. Pieces in elements
    left out by tag or mark (seen from the root) do not enter the sum, nor, on a
    page with an article or main element, pieces outside it.

    Iterative, so that deep nesting is no limit. Returns the root's own.
    """
    done: dict[int, tuple[str, int, int]] = {}
    everywhere = not _mains(node)
    todo = [(node, False, False, False)]
    while todo:
        n, ready, inside_main, out = todo.pop()
        if not ready:
            out = out or n.out
            todo.append((n, True, inside_main, out))
            deeper = inside_main or n.tag in MAIN
            todo.extend((c, False, deeper, out) for c in n.inside if isinstance(c, Node))
            continue
        parts, size, sums = [n.tag, "("], 0, 0
        for c in n.inside:
            if isinstance(c, Node):
                own, k, s = done.pop(id(c))
                parts.append(own)
                size += k
                sums += s
            else:
                t = " ".join(c.split())
                parts.append(t)
                size += len(t)
                if t and not out and (everywhere or inside_main or n.tag in MAIN):
                    sums += _hash(t)
        parts.append(")")
        whole = "".join(parts)
        if len(whole) > 200:  # keep parents short, however large the page is
            whole = f"{n.tag}#{_hash(whole)}"
        done[id(n)] = (whole, size, sums)
        if n.tag in BLOCKS and size:
            visit(n, whole, size, sums, inside_main)
    return done[id(node)]


def _hash(s: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _candidates(html: str | None) -> tuple[Node, int, dict[int, list[tuple[Node, int]]]]:
    """The root, the sum of its text's hashes, and subtree hash -> (node, its sum)
    for every block that a template could be."""
    root, found = parse(html), []
    _, total, sums = walk(root, lambda *block: found.append(block))
    out: dict[int, list[tuple[Node, int]]] = {}
    for n, whole, size, own, in_main in found:
        if 2 * size <= total and n.tag not in MAIN and not (in_main and n.tag in PROSE):
            out.setdefault(_hash(whole), []).append((n, own))
    return root, sums, out


def subtrees(html: str | None) -> dict[int, list[Node]]:
    """Subtree hash -> its nodes, for every block that a template could be."""
    root, _, blocks = _candidates(html)
    return {**{h: [n for n, _ in own] for h, own in blocks.items()}, 0: [root]}


def surroundings(html: str | None) -> dict[int, int]:
    """Subtree hash -> a hash of the page's text without this subtree, wherever it
    stands on the page."""
    _, sums, blocks = _candidates(html)
    rest = {h: (sums - sum(s for _, s in own)) % (1 << 64) for h, own in blocks.items()}
    return {h: r - (1 << 64) if r >> 63 else r for h, r in rest.items() if h}


def extract(html: str | None, templates: frozenset[int] | set[int]) -> str:
    """The main text without the blocks whose subtree hash is in ``templates``."""
    nodes = subtrees(html)
    root = nodes.pop(0)[0]
    for h in templates:
        for n in nodes.get(h, ()):
            n.out = True
    # an article inside main is the narrower choice
    kept: list[str] = []
    for top in _mains(root) or [root]:
        kept.extend(_text(top if top.tag != "main" else _article_in(top)))
    return " ".join("".join(kept).split())


def _mains(root: Node) -> list[Node]:
    """The outermost article and main elements that are not left out."""
    mains: list[Node] = []
    todo = [root]
    while todo:
        n = todo.pop()
        if n.out:
            continue
        if n.tag in MAIN:
            mains.append(n)
            continue
        todo.extend(c for c in reversed(n.inside) if isinstance(c, Node))
    return mains


def _article_in(main: Node) -> Node:
    found, todo = [], [main]
    while todo:
        n = todo.pop()
        if n.tag == "article" and not n.out:
            found.append(n)
        elif not n.out:
            todo.extend(c for c in n.inside if isinstance(c, Node))
    return found[0] if len(found) == 1 else main


def _text(top: Node) -> Iterator[str]:
    todo: list = [top]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            yield n
        else:
            if n.tag in BLOCKS:  # a block that is left out still parts the text around it
                yield " "
                todo.append(" ")
            if not n.out:
                todo.extend(reversed(n.inside))


def host(url: Column) -> Column:
    """The host of a url in lower case, without user and port; '' if there is none."""
    got = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(got), F.lit(""))


def site_templates(pages: DataFrame, *, min_pages: int = 5, url: str = "url",
                   html: str = "html") -> DataFrame:
    """(page, hash): which template subtrees stand on which page.

    ``page`` is the pair of hashes of url and html, so equal rows share it. A
    subtree is a template of its host if it stands on at least ``min_pages`` of
    its pages that differ in the rest of their text, however many pages there are.
    """
    ship(pages.sparkSession)

    def blocks_of(batches):
        for b in batches:
            rows = []
            for t, *page in zip(b.column("t"), *(b.column(c).to_pylist() for c in ("u", "p", "host"))):
                rows.extend((*page, h, rest) for h, rest in surroundings(t.as_py()).items())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                names=["u", "p", "host", "hash", "rest"])

    rows = pages.select(*_page(url, html), host(F.col(url)).alias("host"), F.col(html).cast("string").alias("t"))
    blocks = materialise(rows.mapInArrow(blocks_of, "u long, p long, host string, hash long, rest long"), "blocks")
    # different surroundings first, each once; n: rows of the subtree
    votes = blocks.groupBy("host", "hash", "rest").agg(F.count("*").alias("n"))
    common = materialise(votes.groupBy("host", "hash").agg(F.count("*").alias("votes"), F.sum("n").alias("n"))
                         .where(F.col("votes") >= min_pages).select("host", "hash", "n"), "templates")
    # a menu that very many pages have is dealt to several tasks
    return spread_join(blocks.select("u", "p", "host", "hash"), common, ["host", "hash"], "n").select("u", "p", "hash")


def _page(url: str, html: str) -> list[Column]:
    return [F.xxhash64(url).alias("u"), F.xxhash64(html).alias("p")]


def extract_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html",
                 min_pages: int = 5) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html."""
    own = (site_templates(pages, min_pages=min_pages, url=url, html=html)
           .groupBy("u", "p").agg(F.collect_set("hash").alias("hashes")))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                        F.col(html).cast("string").alias("t"), *_page(url, html))
    joined = rows.join(own, ["u", "p"], "left").select("page_id", "url", "t", "hashes")

    def run(batches):
        for b in batches:
            text = [extract(t.as_py(), set(h or ())) for t, h in
                    zip(b.column("t"), b.column("hashes").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array(list(map(len, text)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return joined.mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return extract_text(read(spark, sf_dir, "pages"))
