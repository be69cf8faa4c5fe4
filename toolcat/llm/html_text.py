"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text in them; their paths of tags and generalised classes (lower case,
without digits) get the page's votes, which Spark adds up per host. A host's winning paths, in the order of their
votes, then say from which containers its pages are extracted again. A page that holds none of them, or most of its
unlinked text elsewhere, uses its own best container. An article or main around the container is taken whole; without
one, all other unlinked text counts too, except in paths that the host's pages usually fill with little text.

Null html counts as empty; a null or odd url has the host ''. Markup that isn't closed runs to where an outer
element closes, or to the end. Text outside any container belongs to the page itself. Repeated rows are extracted
each. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from toolcat.llm.common import join_groups, materialize

#: Paths for which a page votes, and the share of a host's votes that a winning path needs.
VOTES, WIN_SHARE = 3, 0.1
#: A container's weight falls by this factor for each container between it and the text.
DECAY, MAIN_BONUS = 0.7, 1.5
#: A path is minor on a host if over half of its pages, and so many at least, hold it, mostly with less than this share.
MINOR_SHARE, MINOR_PAGES = 0.1, 3

_START = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|[!?/])")
_STOP = re.compile("[>\"']")
#: Elements whose content isn't text of the page.
_RAW = frozenset("script style noscript template svg math textarea select iframe object canvas video audio title".split())
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd link mark meta nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_LAYOUT = frozenset("body div section article main td center".split())
_OPEN = _LAYOUT | frozenset(
    "html head nav header footer aside form ul ol li dl dd dt table thead tbody tfoot tr th blockquote figure figcaption "
    "details summary fieldset button dialog menu label pre".split()
)
_DROPPED = frozenset("head nav footer aside button dialog menu label".split())
# Words in a class, id or role that mark what isn't the article wherever they stand, those that do so only
# alone or beside words of the same kinds, and words that may stand beside them.
_NOISE = frozenset(
    "advert adverts advertisement advertising breadcrumb breadcrumbs consent contentinfo cookie cookies disqus masthead modal nav navbar "
    "newsletter outbrain pagination popup promo promoted promotion sidebar signup sponsor sponsored subscribe subscription taboola toolbar".split()
)
_WEAK = frozenset(
    "ad ads adv banner comment comments footer header menu navigation notice notices recommended related replies reply responses search share "
    "sharing social widget widgets".split()
)
_BESIDE = frozenset(
    "area article articles bar block bottom box button buttons col column container content count entry footer form global group icon icons inner "
    "item items left link links list main media mobile more news outer page panel post posts primary reader right row section secondary site slot "
    "space story stories sub text thread top topics unit user wrap wrapper".split()
)
_ARTICLE = frozenset("article entry post single story".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


def _kind(token: str) -> str:
    """noise, header (an article's own) or nothing, for one class, id or role."""
    words = [w.lower() for w in _WORDS.findall(token)]
    if any(w in _NOISE or w.startswith("comment") and len(w) > 8 for w in words):
        return "noise"
    weak = [w for w in words if w in _WEAK]
    if not weak or any(w not in _WEAK and w not in _BESIDE for w in words):
        return ""
    return "header" if weak == ["header"] and not _ARTICLE.isdisjoint(words) else "noise"


def _labels(attributes: str) -> tuple[str, str]:
    """The generalised classes, and whether class, id or role marks noise or an article's header."""
    classes, kinds = [], set()
    for m in _NAMED.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        kinds |= {_kind(x) for x in value.split()}
        if m[1].lower() == "class":
            classes = sorted({c for x in value.lower().split() if (c := re.sub(r"\d+", "", x).strip("-_"))})
    return "".join(f".{c}" for c in classes), "noise" if "noise" in kinds else "header" if "header" in kinds else ""


def _tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, name, whether it closes, and attributes of each tag; raw elements and comments go as one nameless
    tag. A quote that is never closed is an ordinary sign; what never ends is text."""
    last_end, last_quote = html.rfind(">"), {q: html.rfind(q) for q in "\"'"}
    pos = 0
    while m := _START.search(html, pos):
        begin = m.start()
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            pos = len(html) if end < 0 else end + 3
            yield begin, pos, "", False, ""
            continue
        if begin > last_end:
            return
        end = m.end()
        while stop := _STOP.search(html, end):
            sign, end = stop[0], stop.end()
            if sign == ">":
                break
            if end <= last_quote[sign]:
                end = html.index(sign, end) + 1
        if not stop:  # quotes that don't match
            end = html.index(">", m.end()) + 1
        name = (m[2] or "").lower()
        if name in _RAW and not m[1]:
            closing = re.compile(rf"</{name}\s*>", re.I).search(html, end)
            pos = closing.end() if closing else len(html)
            yield begin, pos, "", False, ""
            continue
        pos = end
        yield begin, end, name, bool(m[1]), html[m.end() : end - 1]


class Page:
    """A page's blocks of text, and the tree of its containers' paths: a node for each path of generalised labels,
    with its parent, which comes before it, and a key that is the same on every page."""

    def __init__(self) -> None:
        self.parent, self.key, self.main = [-1], [0], [False]
        self.children: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []  # node, text, length of linked text

    def child(self, node: int, label: str, main: bool) -> int:
        if (node, label) not in self.children:
            self.children[node, label] = len(self.parent)
            self.parent.append(node)
            self.key.append(xxhash.xxh64_intdigest(f"{self.key[node]}/{label}") - (1 << 63))
            self.main.append(main)
        return self.children[node, label]

    def below(self, node: int) -> list[bool]:
        """Of each node whether it is the given one or below it."""
        out = [n == node for n in range(len(self.parent))]
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.parent[n]]
        return out


def parse(html: str, forms: bool = False) -> Page:
    """The blocks outside dropped elements, in page order. A form is dropped, but where forms hold most of the page's
    unlinked text the page lies in them, and only their controls are."""
    page, stack = Page(), []  # the stack holds tag, node, kept, inside a form, inside an article's header
    parts: list[str] = []
    open_tags: Counter = Counter()
    linked = in_link = at = node = in_heading = in_forms = 0
    kept, form, header, skipped = True, False, False, False
    inline, depth = "", 0  # the inline element of noise that is open, and how many of its kind

    def flush() -> None:
        nonlocal linked, parts, in_forms
        if parts:
            text = " ".join("".join(parts).split())
            if text and form and not forms:
                in_forms += len(text) - min(linked, len(text))
            elif text:
                page.blocks.append((node, text, min(linked, len(text))))
            parts = []
        linked = 0

    def read(text: str) -> None:
        nonlocal linked
        if text and kept and not skipped and not inline and (not header or in_heading):  # of an article's header only headings are text
            text = unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) * (in_link > 0)

    for begin, end, tag, closing, attributes in _tags(html):
        read(html[at:begin])
        at = end
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "a":
                in_link = max(0, in_link + (-1 if closing else 1))
            if inline:
                depth += (tag == inline) * (-1 if closing else 1)
                inline = inline if depth else ""
            elif not closing and "=" in attributes and not attributes.endswith("/") and _labels(attributes)[1] == "noise":
                inline, depth = tag, 1
            continue
        flush()
        inline, skipped = "", False
        if tag in _HEADINGS:
            in_heading = 0 if closing else 1
        if tag not in _OPEN:  # a paragraph of noise ends with the next tag of a block
            skipped = not closing and "=" in attributes and _labels(attributes)[1] == "noise"
            continue
        in_link = in_heading = 0
        if closing:
            while open_tags[tag]:
                name = stack.pop()[0]
                open_tags[name] -= 1
                if name == tag:
                    break
        elif not attributes.endswith("/"):
            if tag == "body":
                stack = [x for x in stack if x[0] == "html"]  # a head that wasn't closed ends here
                open_tags = Counter(x[0] for x in stack)
            labels, kind = _labels(attributes) if attributes.strip() else ("", "")
            above, ok, inside, top = stack[-1][1:] if stack else (0, True, False, False)
            ok = ok and tag not in _DROPPED and not (kind == "noise" and tag not in ("html", "body", "article", "main"))
            ok = ok and (tag != "header" or open_tags["article"] + open_tags["main"] > 0)
            own = page.child(above, tag + labels, tag in ("article", "main")) if tag in _LAYOUT else above
            stack.append((tag, own, ok, inside or tag == "form", top or tag == "header" or kind == "header"))
            open_tags[tag] += 1
        node, kept, form, header = stack[-1][1:] if stack else (0, True, False, False)
    read(html[at:])
    flush()
    if in_forms > sum(len(text) - size for _, text, size in page.blocks):
        return parse(html, forms=True)
    return page


def path_scores(page: Page) -> list[tuple[int, float]]:
    """The nodes of the best paths with their shares of the page's votes, the best first."""
    scores = [0.0] * len(page.parent)
    held = [False] * len(page.parent)
    for node, text, linked in page.blocks:
        scores[node] += float(len(text) - linked) or 0.01
        held[node] = True
    for n in range(len(scores) - 1, 0, -1):
        scores[page.parent[n]] += DECAY * scores[n]
        held[page.parent[n]] = held[page.parent[n]] or held[n]
    found = [(s * (MAIN_BONUS if page.main[n] else 1.0), page.key[n], n) for n, s in enumerate(scores) if held[n]]
    best = sorted(found, key=lambda x: (-x[0], x[1]))[:VOTES]
    total = sum(s for s, _, _ in best)
    return [(n, s / total) for s, _, n in best]


def shares(page: Page) -> dict[int, float]:
    """Each node's share of the page's unlinked text, without what lies below it."""
    sizes: dict[int, int] = {}
    for node, text, linked in page.blocks:
        sizes[node] = sizes.get(node, 0) + len(text) - linked
    total = sum(sizes.values()) or 1
    return {n: size / total for n, size in sizes.items()}


def extract(page: Page, winners: list[int], minor: frozenset | set = frozenset()) -> str:
    """The main text: from the first of the ``winners`` (keys of paths) that holds most of the page's unlinked text
    outside the ``minor`` paths, or from the page's own best path, up to its article or main, or else all that holds
    unlinked text outside the minor paths."""
    own = [n for n, _ in path_scores(page)[:1]]
    place = {key: n for n, key in enumerate(page.key)}
    counted = [(node, len(text) - linked, page.key[node] in minor) for node, text, linked in page.blocks]
    for node in [*(place[k] for k in winners if k in place), *own]:
        below = page.below(node)
        covered = sum(size for n, size, _ in counted if below[n])
        other = sum(size for n, size, small in counted if not below[n] and not small)
        if node not in own and (covered < other or not any(below[n] for n, _, _ in counted)):
            continue
        top = node
        while top > 0 and not page.main[top]:
            top = page.parent[top]
        if page.main[top]:
            whole = page.below(top)
            return "\n".join(text for n, text, _ in page.blocks if whole[n])
        return "\n".join(
            text for (n, text, linked), (_, _, small) in zip(page.blocks, counted, strict=True) if below[n] or (not small and 2 * linked < len(text))
        )
    return ""


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, size, paths, minor``: each host's number of pages, the keys of its winning paths, and of the paths that
    most of its pages hold with a small share of their text. ``pages``: ``host, html``."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, html in enumerate(batch.column(1).to_pylist()):
                page = parse(html)
                votes, held = dict(path_scores(page)), shares(page)
                rows += [(i, page.key[n], votes.get(n, 0.0), int(n in held), int(held.get(n, 1.0) < MINOR_SHARE)) for n in votes.keys() | held.keys()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[4] for r in rows], pa.int64())], names=["host", "path", "votes", "held", "small"],
            )

    votes = pages.select("host", "html").mapInArrow(vote, "host string, path long, votes double, held long, small long")
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"), F.sum("held").alias("held"), F.sum("small").alias("small"))
    votes = materialize(votes, "votes")
    sizes = pages.groupBy("host").agg(F.count("*").alias("size"))
    minor = votes.filter(F.col("held") >= MINOR_PAGES).filter("2 * small > held").join(sizes, "host").filter("2 * held > size")
    minor = minor.groupBy("host").agg(F.collect_list("path").alias("minor"))
    votes = votes.filter("votes > 0")
    # Few paths stand for a host, whatever the number of its pages.
    order = W.partitionBy("host").orderBy(F.desc("votes"), "path")
    votes = votes.withColumn("rank", F.row_number().over(order)).withColumn("most", F.max("votes").over(W.partitionBy("host")))
    won = votes.filter(F.col("votes") >= WIN_SHARE * F.col("most"))
    won = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("paths"))
    paths = F.transform("paths", lambda x: x["path"]).alias("paths")
    return sizes.join(won, "host", "left").join(minor, "host", "left").select("host", "size", paths, "minor")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col("url"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#:]*)", 1)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    rows = pages.select("page_id", "url", host.alias("host"), html)
    paths = materialize(host_paths(rows), "paths")
    total = paths.agg(F.sum("size")).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            texts = [extract(parse(h), winners or [], set(minor or [])) for h, winners, minor in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    known = join_groups(rows, paths, "host", "size", total).select("page_id", "url", "html", "paths", "minor")
    id_type = rows.schema["page_id"].dataType.simpleString()
    texts = known.mapInArrow(run, f"page_id {id_type}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
