"""Main text of web pages by a site style tree.

The DOMs of one host are merged: elements on the same path of labels (tag,
class, id, role) are one node of the host's tree. A node's presentation is
the sequence of its children's labels, its content the texts of the blocks
right under it. What varies from page to page is important, what repeats is
template: both are measured by entropy over the host's pages, presentation
and content together give the importance of a branch. A branch is removed
from each page if its own importance and that of all branches below it are
low, with an allowance for how few pages have them; so what varies is kept
however much template surrounds it, and a host whose pages vary nowhere
(one page, or copies of it) loses nothing.

Elements that say what they are (nav, footer, an advert's class, article)
need no statistics. A name alone never removes html, body, or a wrapper of the main element or of most
of the page's text: the tree judges those.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import bounded, cut, fields

LOW = 0.35  # branches less important are removed
DOUBT = 0.9  # added to an importance, divided by the pages that have the branch: two can't tell, three must agree
DECAY = 0.9  # weight that each child label takes from the presentation
DEEPEST = 48  # elements below belong to the branch above them
LABEL = 60  # characters of a label
BRANCHES = 50_000  # removed branches that travel with the tasks; beyond, they are joined by host

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                 r"|<([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/]|\Z)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# HTML's element kinds, and names by which sites call parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCK - frozenset("body caption head html legend optgroup option tbody td tfoot th thead tr".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select"}}
NOISE_TAGS = frozenset("head nav footer aside button select menu dialog input label fieldset audio video canvas object applet map".split()) | RAW
NOISE_NAMES = frozenset("nav navbar navigation menu menubar sidebar footer masthead ad ads adv advert adverts advertisement advertising adsense adbox banner promo "
                        "adsbygoogle promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
                        "social share sharing related recommended recommendations comment comments commentlist disqus respond reply replies breadcrumb breadcrumbs "
                        "pagination pager toolbar widget widgets login search copyright complementary contentinfo dialog form paywall disclaimer discussion rail teaser teasers "
                        "aside".split())
DISCUSSION = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: A name made of these and of words for boxes is no wrapper's, whatever it holds; with another word (has-ads, comments-open) it may be.
NEVER = DISCUSSION | frozenset("ad ads adv advert adverts advertisement advertising adsense adbox adsbygoogle banner promo promotion sponsor sponsored "
                               "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall disclaimer".split())
BOXES = frozenset("area bar block body bottom box container content inner list main outer section thread top wrap wrapper".split())
HEAD_NAMES = frozenset("header topbar".split())
MAIN_NAMES = frozenset("article article-body article-content articlebody main main-content content post post-body post-content entry entry-content story story-body".split())
RAW_END = {tag: re.compile(rf"</{tag}", re.I) for tag in RAW}


@dataclass
class Block:
    text: str
    path: str
    noise: bool
    anchor: int  # length of the path up to the main element, 0 outside of one
    heading: bool


@dataclass
class Page:
    """Blocks in page order, and for every path the labels of the children that its elements have."""

    blocks: list[Block] = field(default_factory=list)
    styles: dict[str, list[str]] = field(default_factory=dict)
    settled: set[str] = field(default_factory=set)
    strong: bool = False  # an article or main element is there
    named: _Named = field(default_factory=lambda: _Named())


@dataclass
class _Open:
    tag: str
    path: str
    depth: int
    noise: bool
    anchor: int
    heading: bool
    named: int = 0  # the innermost element that only its name (or a form tag) calls noise, 0 for none
    main: bool = False
    sure: bool = False  # noise by more than a name


@dataclass
class _Named:
    """Elements called noise by a name alone, by number of their start tag; 0 stands for the rest of the page."""

    above: dict[int, int] = field(default_factory=dict)
    discussion: set[int] = field(default_factory=set)
    never: set[int] = field(default_factory=set)  # adverts, notices and discussions by name, that are no main element themselves
    blocks: Counter[int] = field(default_factory=Counter)  # block elements under each, not under the next one
    chars: Counter[int] = field(default_factory=Counter)  # of text right under each, not under the next one
    main: Counter[int] = field(default_factory=Counter)  # of these, inside a main element

    def wrappers(self) -> frozenset[int]:
        """Those that hold several blocks and most of the page's text, or its main element and more text than is outside of all.

        What is an advert, a notice or a discussion by its whole name is none;
        another discussion is none if the main element has text outside of it.
        """
        under, main, blocks = Counter(self.chars), Counter(self.main), Counter(self.blocks)
        for i in sorted(self.above, reverse=True):
            if self.above[i]:
                under[self.above[i]] += under[i]
                main[self.above[i]] += main[i]
                blocks[self.above[i]] += blocks[i]
        total, free, free_main = self.chars.total(), self.chars[0], self.main[0]
        below: dict[int, list[int]] = {}
        for i, above in self.above.items():
            below.setdefault(above, []).append(i)
        found: set[int] = set()
        level = below.get(0, [])
        while level:
            new = [i for i in level if i not in self.never and not (i in self.discussion and free_main)
                   and (2 * under[i] > total and blocks[i] > 1 or main[i] and not free_main and under[i] > free)]
            found.update(new)
            free += sum(self.chars[i] for i in new)
            free_main += sum(self.main[i] for i in new)
            level = [j for i in new for j in below.get(i, [])]
        return frozenset(found)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _names(attributes: dict[str, str]) -> tuple[set[str], set[str]]:
    """Whole names of class, id, role and itemprop, and the words they are made of."""
    whole = [name for k in ("class", "id", "role", "itemprop") for name in attributes.get(k, "").split()]
    return {n.lower() for n in whole}, {w.lower() for n in whole for w in WORD.findall(n)}


def _is_never(name: str) -> bool:
    words = {w.lower() for w in WORD.findall(name)}
    return bool(words & NEVER) and words <= NEVER | BOXES


def _label(tag: str, attributes: dict[str, str]) -> str:
    marks = [f"{k[0]}={re.sub(r'[0-9]+', '#', attributes[k].strip())}" for k in ("class", "id", "role") if attributes.get(k)]
    label = re.sub(r"[\s>]+", ".", "|".join([tag, *marks]))
    return label if len(label) <= LABEL else f"{label[:LABEL - 16]}{xxhash.xxh64_hexdigest(label)}"


def parse(source: str | None) -> Page:
    """The page's blocks and merged style nodes; a broken or cut-off page gives what it holds."""
    page = _parse(source or "", frozenset())
    wrappers = page.named.wrappers()
    return _parse(source or "", wrappers) if wrappers else page


def _parse(source: str, wrappers: frozenset[int]) -> Page:
    """The page, with the names of ``wrappers`` (numbers of start tags) not taken for noise."""
    page, n = Page(), 0
    root = _Open("", "", 0, False, 0, False)
    stack, text = [root], []
    open_: Counter[str] = Counter()  # so that the stack is only searched for what it holds

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                top = stack[-1]
                page.blocks.append(Block(" ".join(words), top.path, top.noise, top.anchor, top.heading))
                if not top.sure:
                    size = len(page.blocks[-1].text)
                    page.named.chars[top.named] += size
                    if top.main:
                        page.named.main[top.named] += size

    def pop_to(depth: int) -> None:
        if any(e.tag in BLOCK for e in stack[depth:]):
            flush()
        open_.subtract(e.tag for e in stack[depth:])
        del stack[depth:]

    at = 0
    for m in iter(lambda: TAG.search(source, at), None):
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for i in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[i].tag == tag:
                    pop_to(i)
                    break
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag == "br":
            text.append(" ")
        elif tag == "hr":
            flush()
        if tag in VOID:
            continue
        if tag in ENDS_P and open_["p"]:
            p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if p and not any(e.tag in ("td", "th", "button", "object") for e in stack[p:]):
                pop_to(p)
        if tag in CLOSES and any(open_[t] for t in CLOSES[tag]):
            fence = FENCE.get(tag, {"table"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in fence:
                    break
                if stack[i].tag in CLOSES[tag]:
                    pop_to(i)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
        if tag in BLOCK:
            flush()
        if tag in RAW:
            end = RAW_END[tag].search(source, at)
            at = end.start() if end else len(source)
            continue
        if m.end() == len(source) and not m[0].endswith(">"):
            break  # the page was cut off inside this tag
        above = stack[-1]
        a = _attributes(m[3])
        label = _label(tag, a)
        path = above.path if above.depth >= DEEPEST else f"{above.path}>{label}" if above.path else label
        whole, words = _names(a) if a else (set(), set())
        n += 1
        by_name = tag == "form" or tag not in ("html", "body") and bool((whole | words) & NOISE_NAMES)
        hidden = tag in NOISE_TAGS or "hidden" in a \
            or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
        noise = above.noise or hidden or by_name and n not in wrappers
        anchor = above.anchor
        sure = tag in ("article", "main") or a.get("role", "").lower() == "main" or "articlebody" in whole
        main = above.main or sure or bool(whole & MAIN_NAMES)
        if not anchor and not noise:
            if sure:
                page.strong = True
            # A named element counts less than a real one: its path length is negative.
            anchor = len(path) if sure else -len(path) if whole & MAIN_NAMES else 0
        elif anchor < 0 and tag in ("article", "main"):
            anchor, page.strong = len(path), True
        if not anchor and tag == "header":
            noise = hidden = True
        elif not anchor and words & HEAD_NAMES and tag not in ("html", "body"):
            by_name, noise = True, noise or n not in wrappers
        named = above.named
        if by_name and not hidden and not above.sure:
            page.named.above[n], named = named, n
            if words & DISCUSSION:
                page.named.discussion.add(n)
            if not sure and any(_is_never(name) for name in whole):
                page.named.never.add(n)
        if tag in BLOCK and above.named and not above.sure:
            page.named.blocks[above.named] += 1
        page.styles.setdefault(above.path, []).append(label)
        if noise:
            page.settled.add(path)
        open_[tag] += 1
        stack.append(_Open(tag, path, above.depth + 1, noise, anchor, above.heading or tag in HEADINGS, named, main, above.sure or hidden))
    else:
        if at < len(source):
            text.append(source[at:])
    if text and "<" in text[-1] and re.search(r"<[a-zA-Z/!][^>]*\Z", text[-1]):
        text[-1] = text[-1][:text[-1].rindex("<")]
    flush()
    return page


def main_text(source: str | None, low: frozenset[str] | set[str] = frozenset()) -> str:
    """The page's main text, given the host's branches of low importance.

    Noise by name goes. If the page has a main element only what is in it
    stays. Of the rest, blocks under a low branch go, unless the main element
    (without one the whole page, branch "") is low itself: then its text is
    repeated as a whole on other pages. Headings in the main element stay.
    """
    page = parse(source)
    blocks = [b for b in page.blocks if not b.noise]
    inside = [b for b in blocks if b.anchor > 0] if page.strong else [b for b in blocks if b.anchor]
    kept = []
    for b in inside or blocks:
        anchor = b.path[:abs(b.anchor)]
        if not (low and anchor not in low and not (anchor and b.heading)
                and any(p in low for p in _branches(b.path) if len(p) > len(anchor))):
            kept.append(b.text)
    return " ".join(kept)


def _branches(path: str) -> list[str]:
    """The path and all paths above it."""
    parts = path.split(">")
    return [">".join(parts[:i]) for i in range(1, len(parts) + 1)]


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch, how many pages of a host have each feature of each path."""
    for batch in batches:
        seen: Counter[tuple] = Counter()
        for host, source in zip(batch["host"], batch["html"]):
            page = parse(source)
            for path, labels in page.styles.items():
                if path:
                    seen[host, path, 0, xxhash.xxh64_intdigest(" ".join(labels)) >> 1, path in page.settled] += 1
            own: dict[str, set[int]] = {}
            for b in page.blocks:
                if b.path:
                    own.setdefault(b.path, set()).add(xxhash.xxh64_intdigest(b.text) >> 1)
            for path, texts in own.items():
                settled = path in page.settled
                if path not in page.styles:
                    seen[host, path, 0, 0, settled] += 1
                for t in texts:
                    seen[host, path, 1, t, settled] += 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["host", "path", "kind", "feature", "settled", "n"])


_FEATURES = fields(host="string", path="string", kind="int", feature="long", settled="boolean", n="long")


def style_tree(pages: DataFrame) -> DataFrame:
    """The hosts' merged trees: host, path, n_pages, settled, presentation, content, importance.

    ``pages`` has host and html. ``presentation`` is the entropy of the
    children's sequences over the node's pages, ``content`` one less the mean
    entropy of the texts under the branch, both to the base of the number of
    pages, so between 0 (template) and 1. The importance mixes them: the more
    kinds of children sequences, the more presentation counts. Named noise
    (settled) doesn't count as content of what is around it; a branch that
    holds nothing else has a null importance.
    """
    features = pages.mapInPandas(_merge, _FEATURES).groupBy("host", "path", "kind", "feature").agg(
        F.sum("n").alias("n"), F.min("settled").alias("settled"))
    style, content = F.col("kind") == 0, F.col("kind") == 1
    n = F.col("n").cast("double")
    nodes = features.groupBy("host", "path").agg(
        F.sum(F.when(style, F.col("n"))).alias("n_pages"), F.min("settled").alias("settled"),
        F.sum(F.when(style, n * F.log(n))).alias("style_sum"), F.count(F.when(style & (F.col("feature") != 0), 1)).alias("styles"),
        F.coalesce(F.sum(F.when(content, F.log(n))), F.lit(0.0)).alias("text_sum"), F.count(F.when(content, 1)).alias("texts"))
    base = F.log(F.greatest(F.col("n_pages"), F.lit(2)).cast("double"))
    entropy = F.log(F.col("n_pages").cast("double")) - F.col("style_sum") / F.col("n_pages")
    nodes = nodes.withColumn("shared", F.col("text_sum") / base) \
        .withColumn("presentation", F.when(F.col("n_pages") > 1, entropy / base).otherwise(1.0))
    nodes = cut(nodes)  # read twice below; without this the pages would be too
    # What a branch holds is what the nodes under it hold; a path names all nodes above it.
    open_ = ~F.col("settled")
    branch = nodes.where("texts > 0").select("host", F.explode(_with_above("path")).alias("path"), "settled", "shared", "texts") \
        .groupBy("host", "path").agg(
            F.struct(F.sum("shared").alias("shared"), F.sum("texts").alias("texts")).alias("all"),
            F.struct(F.sum(F.when(open_, F.col("shared"))).alias("shared"), F.sum(F.when(open_, F.col("texts"))).alias("texts")).alias("open"))
    tree = nodes.drop("shared", "texts").join(branch, ["host", "path"]) \
        .withColumn("held", F.when(F.col("settled"), F.col("all")).otherwise(F.col("open")))
    left = F.pow(F.lit(DECAY), F.least(F.col("styles"), F.lit(10)).cast("double"))
    tree = tree.withColumn("content", 1 - F.col("held.shared") / F.col("held.texts"))
    both = (1 - left) * F.col("presentation") + left * F.col("content")
    return tree.select("host", "path", "n_pages", "settled", "presentation", "content",
                       F.when(F.col("styles") == 0, F.col("content")).otherwise(both).alias("importance"))


def _with_above(path: str) -> Column:
    """The path and all paths above it; ``""``, the page, is none of them."""
    steps = F.split(path, ">")
    return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), ">"))


def low_branches(tree: DataFrame, low: float = LOW, doubt: float = DOUBT) -> DataFrame:
    """host and path of the branches that, with all below them, matter less than ``low``.

    Path "" stands for the whole page: a host has it if none of its branches
    matters. Named noise goes anyway, so it neither counts nor needs an entry.
    """
    sure = F.col("importance") + F.lit(doubt) / F.col("n_pages")
    within = F.concat(F.array(F.lit("")), _with_above("path"))
    return tree.where(~F.col("settled")).select("host", F.explode(within).alias("path"), sure.alias("sure")) \
        .groupBy("host", "path").agg(F.max("sure").alias("sure")).where(F.col("sure") < low).select("host", "path")


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def extract(pages: DataFrame, url: str = "url", source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with a string column ``name``: each page's main text, empty if it has none.

    Every row and column stays, repeated rows too; an input column of that
    name is replaced. Null html is an empty page; pages without a host share
    the empty one. The pages are read twice, once for the trees and once for
    the texts. Removed branches go along with the tasks while there are at
    most BRANCHES of them; beyond that they are joined by host.
    """
    host = host_of(F.col(f"`{url}`"))
    tree = style_tree(pages.select(host.alias("host"), F.col(f"`{source}`").alias("html")))
    found, n = bounded(low_branches(tree), BRANCHES)
    if n <= BRANCHES:
        by_host: dict[str, set[str]] = {}
        for r in found.collect():
            by_host.setdefault(r["host"], set()).add(r["path"])

        @F.pandas_udf(T.StringType())
        def told(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for hosts, sources in batches:
                yield pd.Series([main_text(s, by_host.get(h, frozenset())) for h, s in zip(hosts, sources)], dtype=object)

        return pages.withColumn(name, told(host, F.col(f"`{source}`")))

    @F.pandas_udf(T.StringType())
    def joined(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for paths, sources in batches:
            yield pd.Series([main_text(s, frozenset(() if p is None else p)) for p, s in zip(paths, sources)], dtype=object)

    # A struct holds the input's columns, so none of them can clash with those of the join.
    lists = found.groupBy("host").agg(F.collect_set("path").alias("low"))
    rows = pages.select(host.alias("host"), F.struct("*").alias("page")).join(lists, "host", "left") \
        .withColumn("text", joined(F.col("low"), F.col(f"page.`{source}`")))
    kept = [F.col("text").alias(name) if c.lower() == name.lower() else F.col(f"page.`{c}`") for c in pages.columns]
    return rows.select(*kept, *([] if name.lower() in map(str.lower, pages.columns) else [F.col("text").alias(name)]))
