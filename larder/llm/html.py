"""Main text of web pages by container paths that the pages of a host agree on.

Every page is parsed into blocks, each below its chain of containers.  Each page
scores its containers (text, less link text, weighted by what tag and class names
say) and votes for the best one by its generalised path: tag and class names with
digits removed.  Spark adds the votes up per host and path, and each page is then
extracted again from the containers on its host's winning path; a page without
such a container uses its own best one.

Menus, headers, footers, forms, scripts, styles and whatever is hidden are left out
by their tags and attributes.  A class, id or role that says sidebar, notice,
advert, comments and the like only makes text count less: each such container
scores `FAINT` of its text, unless that is in an article or main element of its
own, so it wins where it wraps the page.  Below the chosen container such
containers are left out, but for those that still outweigh all else in it.  White
space inside a block becomes one space, blocks are joined by a line feed.

Edge cases: a null or empty html, and a page without any text outside
boilerplate tags, have an empty text; a page without a host (null or odd url) votes in
the group of the empty host; repeated rows vote repeatedly; unclosed and
unopened tags end where their parent ends or are ignored; a page that ends
inside a tag, comment or script is read up to there; a tag with a quote that is
never closed ends at its first ">".  The work is linear in a page's length,
however deep its tags are nested and whatever is left open in it.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp "
                   "rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl div article section main body html blockquote".split())
NO_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                 "h5 h6 header hr main menu nav ol p pre section table ul".split())
# Tags that never hold main text, and the ones that may.
BOILER_TAGS = frozenset("nav header footer aside form script style noscript template iframe svg canvas object audio "
                        "video button select option textarea input fieldset dialog menu head title math".split())
BOILER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"overlay|newsletter|subscri\w*|signup|login|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|widgets?|"
    r"footer|footnav|header|masthead|topbar|toolbar|comments?|commentlist|disqus|replies|respond|share|sharing|social|"
    r"complementary|contentinfo|related|recommend\w*|more-from|tags|pagination|pager|skip|search|legal|copyright|disclaimer)(?:$|[\s_-])")
GOOD_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text|page)(?:$|[\s_-])")
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)", re.S)
OTHER = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)", re.S)
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|$)")  # a quote in it is left open: it counts as a letter
QUOTE_SCANS = 64  # pages' lengths that may be read in vain for closing quotes; then every tag is read as a plain one
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
DIGITS = re.compile(r"\d+")
FAINT = 0.25  # what text counts for in a container named as boilerplate


STATES = re.compile(r"(?<![\w-])(?:has|with|without|no|not|is)-[\w-]+")  # of a wrapper: it names what is beside it
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _words(names: str) -> str:
    return f" {STATES.sub(' ', CAMEL.sub('-', names).lower())} " if names else ""


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated name the first one counts."""
    found: dict[str, str] = {}
    for name, x, y, z in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), x or y or z)
    return found


def _hidden(found: dict[str, str]) -> bool:
    return (found.get("hidden", "until-found").strip().lower() != "until-found"
            or found.get("aria-hidden", "").strip().lower() == "true" or bool(NO_DISPLAY.search(found.get("style", ""))))


class Node:
    __slots__ = ("tag", "step", "parent", "boiler", "named", "clears", "weight", "good", "text", "links", "order",
                 "in_article", "in_main")

    def __init__(self, tag: str, names: str, parent: Node | None, hidden: bool, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.step = tag if tag in ("html", "body") else tag + "".join(
            "." + n for n in DIGITS.sub("", names).replace(">", "").split())
        within_article, within_main = (parent.in_article, parent.in_main) if parent is not None else (False, False)
        self.in_article, self.in_main = within_article or tag == "article", within_main or tag == "main"
        said = _words(names)
        body = tag in ("html", "body", "main", "article")
        article_head = tag == "header" and within_article
        self.boiler = (parent is not None and parent.boiler) or (not body and not article_head and (
            tag in BOILER_TAGS or hidden))
        matched = bool(names and BOILER_NAMES.search(said))
        self.named = matched and not body and not article_head
        # an article inside another one may be a reader's comment
        self.clears = tag in ("article", "main") and not matched and not within_article and not within_main
        weight = parent.weight if parent is not None else 1.0
        self.weight = 1.0 if self.clears else weight * FAINT if self.named else weight
        self.good = tag in ("article", "main") or bool(names and GOOD_NAMES.search(said))
        self.text = self.links = 0

    @property
    def path(self) -> str:
        """The steps from the page down; built only for the container that is voted for."""
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return ">".join(reversed(steps))


def on_path(nodes: list[Node], path: str) -> list[Node]:
    """The containers with this path, found by one pass from the parents down."""
    steps = path.split(">")
    matched = [0] * len(nodes)  # steps of the path that a node ends, 0 if it is off the path
    found = []
    for n in nodes:  # parents come first
        above = 0 if n.parent is None else matched[n.parent.order]
        if (n.parent is None or above) and above < len(steps) and steps[above] == n.step:
            matched[n.order] = above + 1
            if above + 1 == len(steps):
                found.append(n)
    return found


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All containers, and the blocks (container, text) in page order; boilerplate tags and hidden ones give no blocks."""
    top = Node("", "", None, False, 0)
    nodes, blocks, parts = [top], [], []
    open_: list[tuple[str, Node]] = []  # every open tag with its container
    places: dict[str, list[int]] = {}  # of each tag: its places among the open ones
    scopes: list[int] = [-1]  # the places of tags that a missing end tag does not reach over
    at, here, links, linked = 0, top, 0, 0

    def push(tag: str, node: Node) -> None:
        places.setdefault(tag, []).append(len(open_))
        if tag in SCOPE:
            scopes.append(len(open_))
        open_.append((tag, node))

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text and not here.boiler:
                blocks.append((here, text))
                here.text += len(text)
                here.links += min(linked, len(text))
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not here.boiler:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text.strip())

    def close(k: int) -> None:
        nonlocal here, links
        if any(t not in INLINE for t, _ in open_[k:]):
            flush()
        links -= sum(t == "a" for t, _ in open_[k:])
        for t, _ in open_[k:]:
            places[t].pop()
        while scopes[-1] >= k:
            scopes.pop()
        del open_[k:]
        here = open_[-1][1] if open_ else top

    size, seek, wasted = len(page), 0, 0
    while at < size:
        start = page.find("<", seek)
        if start < 0:
            say(page[at:])
            break
        m = TOKEN.match(page, start) if wasted < QUOTE_SCANS * size else None
        if m is None:
            m = PLAIN_TAG.match(page, start)
            if m is None:  # a mere sign
                m = OTHER.match(page, start)
            elif wasted < QUOTE_SCANS * size:
                wasted += size - start
            if m is None:
                seek = start + 1
                continue
        say(page[at:start])
        at = seek = m.end()
        tag = m.group(2) if m.re is not OTHER else None
        if tag is None:
            if page.startswith("<![CDATA[", start):
                say(page[start + 9:at].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m.group(1):  # an end tag
            if places.get(tag):
                close(places[tag][-1])
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            if not m.group(3).rstrip().endswith("/") or tag in ("script", "style", "title"):
                end = re.compile(f"</{tag}\\b[^>]*+(?:>|$)", re.I).search(page, at)
                at = seek = end.end() if end else size
            continue
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" and parts else "")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in NO_P and places.get("p") and places["p"][-1] > scopes[-1]:  # a paragraph ends where a block begins
            close(places["p"][-1])
        if tag in CLOSES:
            inside = [held[k] for t in CLOSES[tag] if (held := places.get(t)) and (k := bisect_right(held, scopes[-1])) < len(held)]
            if inside:
                close(min(inside))
        attributes = m.group(3)
        found = _attributes(attributes) if attributes else {}
        names = " ".join(v for k, v in found.items() if v and k in ("class", "id", "role"))
        hidden = bool(found) and _hidden(found)
        if tag in INLINE and not hidden and not (names and BOILER_NAMES.search(_words(names))):
            links += tag == "a"
            push(tag, here)
            if attributes.rstrip().endswith("/"):
                close(len(open_) - 1)
            continue
        if tag not in INLINE:
            flush()
        elif parts:  # a hidden or boilerplate span: what came before it is no part of it
            flush()
        here = Node(tag, names, here, hidden, len(nodes))
        nodes.append(here)
        links += tag == "a"
        push(tag, here)
        if attributes.rstrip().endswith("/") and tag not in ("p", "div", "span", "a"):
            close(len(open_) - 1)
    flush()
    return nodes, blocks


LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd td th tr tbody thead tfoot table pre blockquote figure figcaption "
                 "caption span a b i em strong address details summary center font".split())


def best_container(nodes: list[Node]) -> tuple[Node | None, float]:
    """The container whose text, less links, is worth most; what lies deeper counts less for an ancestor."""
    score: dict[int, float] = {}
    held = [n.weight * max(0.0, n.text - 2.0 * n.links) for n in nodes]
    for n in reversed(nodes):  # children come after their parents
        worth = held[n.order]
        if not worth:
            continue
        if n.tag not in LEAF and n.tag not in ("", "html"):
            score[n.order] = worth * (1.25 if n.good else 1.0)
            worth *= 0.8
        if n.parent is not None and not n.named:  # what is named as boilerplate is no merit of its surroundings
            held[n.parent.order] += worth
    if not score:
        return None, 0.0
    k = max(score, key=lambda k: (score[k], -k))
    return nodes[k], score[k]


def extract(page: str, path: str | None = None) -> tuple[str, str | None, float]:
    """(main text, path voted for, score of that vote); `path` is the host's, if known."""
    nodes, blocks = parse(page)
    best, score = best_container(nodes)
    chosen = [n for n in on_path(nodes, path) if not n.boiler] if path else []
    texts = _texts_under(nodes, blocks, chosen)
    if not texts:
        texts = _texts_under(nodes, blocks, [best if best is not None else nodes[0]])
    return "\n".join(texts), best.path if best is not None else None, score


def _texts_under(nodes: list[Node], blocks: list[tuple[Node, str]], chosen: list[Node]) -> list[str]:
    """Texts of the blocks in the chosen containers, less the containers below that are named as boilerplate.

    Such a container stays if what it counts for is more than all that stands beside it.
    """
    roots = {n.order for n in chosen}
    zone: list[int | None] = []  # of each node: the innermost container named as boilerplate, -1 for none below the chosen
    up, worth, factor = {}, {-1: 0.0}, {}
    for n in nodes:  # parents come first
        z = zone[n.parent.order] if n.parent is not None else None
        if n.order in roots:
            z = -1 if z is None else z
        elif z is not None and n.named:
            up[n.order], worth[n.order], factor[n.order] = z, 0.0, FAINT
            z = n.order
        if z is not None:
            worth[z] += max(0.0, n.text - 2.0 * n.links)
            if n.clears and z in factor:
                factor[z] = 1.0
        zone.append(z)
    total = dict(worth)
    for z in reversed(up):
        total[z] *= factor[z]
        total[up[z]] += total[z] if up[z] != -1 else 0.0
    stays = {-1}
    for z, above in up.items():
        if above in stays and total[z] > worth[above]:
            stays.add(z)
    return [t for n, t in blocks if zone[n.order] in stays]


HOST_ROWS = 20_000  # up to so many hosts are broadcast; more are joined by a shuffle


def host_votes(pages: DataFrame) -> DataFrame:
    """(host, path) with the largest sum of scores per host; ties go to the smallest path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes: dict[tuple[str, str], float] = {}
            for host, page in zip(b.column("host").to_pylist(), b.column("html"), strict=True):
                _, path, score = extract(page.as_py() or "")
                if path is not None:
                    votes[host, path] = votes.get((host, path), 0.0) + round(score)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], pa.string()),
                                              pa.array([k[1] for k in votes], pa.string()),
                                              pa.array([int(v) for v in votes.values()], pa.int64())],
                                             ["host", "path", "score"])

    votes = pages.select("host", "html").mapInArrow(run, "host string, path string, score long")
    sums = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("score"), "path")).alias("path"))


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and the container path used per row of `pages` (page_id, url, html)."""
    src = with_host(pages)
    paths = materialize(host_votes(src), "host-paths")
    small = paths.limit(HOST_ROWS + 1).count() <= HOST_ROWS
    joined = src.join(F.broadcast(paths) if small else paths, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(page.as_py(), path)[0]
                     for page, path in zip(b.column("html"), b.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), b.column("path")],
                ["page_id", "url", "text", "n_chars", "path"])

    return joined.select("page_id", "url", "html", "path").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, path string")


def op3_html(pages: DataFrame) -> DataFrame:
    return main_text(pages).drop("path")
