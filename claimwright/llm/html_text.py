"""Main text of web pages: a suffix array over each host's pages, and page structure.

A page is cut into blocks, each with a part of the page it stands in. Menus, footers,
forms, adverts and the like go. For all other text the host decides: the token streams
of a host's pages are put one after the other and sorted as suffixes, and runs of RUN tokens
or more that stand on different pages are boilerplate and are cut. Structure says how much
that takes. Text outside articles goes if any other page has it. Text inside an article
or main element is the page's own: only a run on at least half of the pages, and on
MANY, is a notice and goes, and an article such runs would take more than half of is a
changed copy and stays whole.

Pages of a host are dealt by hash into groups of about GROUP_PAGES, which are compared by
one suffix array each. What stands outside articles is compared over all groups as well:
groups hand on a hash of each of these runs, the host counts them, and those on several
pages come back to the groups. Groups depend on the pages alone, not on partitions.
"""

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from claimwright.llm.common import map_batches
from claimwright.llm.fm_index import suffix_array
from claimwright.session import stage

RUN = 8
MANY = 5
LARGE_HOSTS = 100_000
GROUP_PAGES = 512
GROUP_CHARS = 24 << 20
CONTENT, CHROME, UNKNOWN, WEAK = range(4)
ARTICLE = (CONTENT, WEAK)

# Element and class names by their use in HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object",
       "select", "title", "button", "canvas", "math", "video", "audio")
CHROME_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "head"}
CONTAINERS = {"article", "main", "header", "section", "div", "ul", "ol", "dl", "table",
              "body", "figure", "details", "blockquote", "fieldset", *CHROME_TAGS}
BREAKS = {"p", "br", "hr", "li", "dt", "dd", "tr", "pre", "caption", "figcaption", "summary",
          "legend", "address", "center", "option", "h1", "h2", "h3", "h4", "h5", "h6",
          "html", *CONTAINERS}
CLOSED_BY_BREAK = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "span"}
CHROME_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor",
    "sponsored", "promo", "promotion", "sidebar", "menu", "nav", "navbar", "navigation",
    "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "social",
    "share", "sharing", "comment", "comments", "disqus", "reply", "replies", "footer", "footnav",
    "masthead", "related", "recommended", "widget", "pagination", "pager", "toolbar", "skip",
    "login", "search", "copyright", "complementary", "contentinfo", "alert", "hidden",
}
CONTENT_NAMES = {"article", "main"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[\"'>]")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
NAMES = re.compile(
    r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""",
                    re.IGNORECASE)


def part_of(tag: str, rest: str, inside: int) -> int:
    """The part of the page that an element opens, given the part it stands in.

    A main element is never inside a menu: there the menu was left open. Names count as
    whole classes, ids or roles, and not at all on body and article elements.
    """
    if tag == "main":
        return CONTENT
    if inside == CHROME or tag in CHROME_TAGS:
        return CHROME
    if rest and tag != "body":
        names = set()
        for m in NAMES.finditer(rest):
            names.update((m[1] or m[2] or m[3] or "").lower().split())
        if names & CHROME_NAMES and tag != "article" or HIDDEN.search(rest):
            return CHROME
        if names & CONTENT_NAMES and tag in CONTAINERS:
            return CONTENT
    if tag in CONTENT_NAMES:
        return CONTENT
    if tag == "header":
        return WEAK if inside in (CONTENT, WEAK) else CHROME
    return inside


def pieces_of(page: str):
    """(start, end, closing, tag, rest) of the tags of a page, in order; comments,
    declarations and raw elements have no tag.

    What a search did not find is not searched again, so broken pages take linear time:
    without a further `>` there is no further tag, and after a quote that is never closed
    tags end at the next `>`.
    """
    at, gt, quoted = 0, -1, True
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, "", "", ""
            continue
        if gt <= start:
            gt = page.find(">", start + 1)
            if gt < 0:
                comment = page.find("<!--", start)
                if comment >= 0:
                    yield comment, len(page), "", "", ""
                return
        if page[start + 1] in "!?":
            at = gt + 1
            yield start, at, "", "", ""
            continue
        found = TAG.match(page, start)
        if not found:
            at = start + 1
            continue
        tag, place, end = found[2].lower(), found.end(), -1
        if tag in RAW_END and not found[1]:
            closed = RAW_END[tag].search(page, gt + 1)
            at = closed.end() if closed else len(page)
            yield start, at, "", "", ""
            continue
        while quoted:
            stop = STOP.search(page, place)
            if stop and stop[0] == ">":
                end = stop.start()
                break
            place = page.find(stop[0], stop.end()) + 1 if stop else 0
            quoted = place > 0
        if end < 0:
            end = gt
        at = end + 1
        yield start, at, found[1], tag, page[found.end():end]


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(part, text) of the blocks of a page, in order, without empty ones."""
    out, text, at = [], [], 0
    stack: list[tuple[str, int]] = [("", UNKNOWN)]
    opened: Counter = Counter()

    def flush():
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            out.append((stack[-1][1], joined))
        text.clear()

    def close(depth: int):
        opened.subtract(name for name, _ in stack[depth:])
        del stack[depth:]

    for start, end, closing, tag, rest in pieces_of(page):
        if start > at:
            text.append(page[at:start])
        at = end
        if not tag:
            continue
        breaks = tag in BREAKS
        if not breaks and tag not in ("td", "th") and not opened[tag] \
                and not (rest and NAMES.search(rest)):
            continue
        if breaks:
            flush()
        elif tag in ("td", "th"):
            text.append(" ")
        if closing:
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                if not breaks:
                    flush()
                close(depth)
            continue
        if breaks and stack[-1][0] in CLOSED_BY_BREAK and tag != "br":
            close(len(stack) - 1)
        if tag == "body":
            close(1)
        part = part_of(tag, rest, stack[-1][1])
        if rest.endswith("/") or tag in ("br", "hr", "img", "input", "link", "meta"):
            continue
        if tag in CONTAINERS or part != stack[-1][1]:
            if not breaks:
                flush()
            stack.append((tag, part))
            opened[tag] += 1
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


def run_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of every run of RUN words."""
    if len(words) < RUN:
        return np.zeros(0, np.int64)
    each = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    out = np.zeros(len(words) - RUN + 1, np.uint64)
    for step in range(RUN):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[step:len(each) - RUN + 1 + step]
    return out.view(np.int64)


def outside_stretches(blocks: list[tuple[int, str]]) -> list[tuple[int, int, list[str]]]:
    """(first block, end block, words) of neighbouring blocks outside articles."""
    out, at = [], 0
    while at < len(blocks):
        end = at
        while end < len(blocks) and blocks[end][0] not in ARTICLE:
            end += 1
        if end > at:
            out.append((at, end, [w for _, t in blocks[at:end] for w in t.split()]))
        at = end + 1
    return out


def covered_words(pages: list[list[tuple[int, str]]], names: list,
                  repeated: np.ndarray | None = None) -> list[list[np.ndarray]]:
    """For each page and block: which of its words stand in runs that are boilerplate.

    Pages of one name, and pages of equal text, are one page. `repeated` has the hashes of
    further runs that several pages of the host have outside articles.
    """
    ids: dict[str, int] = {}
    text, owner, inside = [], [], []
    spans, wholes, articles = [], [], []
    for number, blocks in enumerate(pages):
        own, whole, article = [], [], []
        for part, block in blocks:
            words = [ids.setdefault(w, len(ids) + 1) for w in block.split()]
            own.append((len(text), len(text) + len(words)))
            text += words
            owner += [number] * len(words)
            inside += [part in ARTICLE] * len(words)
            whole += words
            article += words if part in ARTICLE else []
        spans.append(own)
        wholes.append(tuple(whole))
        articles.append(tuple(article))
        text.append(0)
        owner.append(number)
        inside.append(False)
    stream, owner, inside = np.array(text, np.int64), np.array(owner), np.array(inside)
    separators = np.flatnonzero(stream == 0)
    told = stream + len(separators)
    told[separators] = np.arange(len(separators))
    order = suffix_array(told)
    # Neighbours in the order that agree in RUN tokens make a group.
    padded = np.concatenate([told, -1 - np.arange(RUN)])
    same = np.ones(max(0, len(order) - 1), bool)
    for step in range(RUN):
        same &= padded[order[1:] + step] == padded[order[:-1] + step]
    group = np.concatenate([[0], np.cumsum(~same)])

    def kinds(labels: list, at: np.ndarray) -> np.ndarray:
        """How many different labels the pages of each group's places `at` have."""
        numbers: dict = {}
        kind = np.array([numbers.setdefault(k, len(numbers)) for k in labels], np.int64)[owner[order[at]]]
        pairs = np.unique(group[at] * max(1, len(numbers)) + kind)
        return np.bincount(pairs // max(1, len(numbers)), minlength=group[-1] + 1)

    def hit(at: np.ndarray, streams: list, least: int) -> np.ndarray:
        """The words in runs of `at` on at least so many pages that differ in name and text."""
        # Most runs stand in one place; they need no look at their pages.
        at = at[np.bincount(group[at], minlength=group[-1] + 1)[group[at]] >= least]
        found = np.minimum(kinds(names, at), kinds(streams, at)) >= least
        return spread(order[at[found[group[at]]]])

    def spread(starts: np.ndarray) -> np.ndarray:
        change = np.zeros(len(stream) + RUN + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + RUN, -1)
        return np.cumsum(change)[:len(stream)] > 0

    anywhere = hit(np.arange(len(order)), wholes, 2)
    if repeated is not None and len(repeated):
        starts = []
        for own, blocks in zip(spans, pages):
            for first, end, words in outside_stretches(blocks):
                places = np.concatenate([np.arange(*own[i]) for i in range(first, end)])
                starts.append(places[np.flatnonzero(np.isin(run_hashes(words), repeated))])
        anywhere |= spread(np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64))
    # A run is the article's if all its words are.
    ahead = np.concatenate([[0], np.cumsum(inside), np.full(RUN, inside.sum())])
    wholly = ahead[RUN:RUN + len(stream)] - ahead[:len(stream)] == RUN
    with_article = [i for i, x in enumerate(articles) if x]
    distinct = min(len({names[i] for i in with_article}), len({articles[i] for i in with_article}))
    often = hit(np.flatnonzero(wholly[order]), articles, max(MANY, -(-distinct // 2)))
    covered = np.where(inside, often, anywhere)
    return [[covered[a:b] for a, b in page] for page in spans]


def main_texts(pages: list[list[tuple[int, str]]], names: list,
               repeated: np.ndarray | None = None) -> list[tuple[str, int]]:
    """(text, number of blocks that words were cut from) of pages of one group.

    An article covered by more than a half is a changed copy of others and stays whole.
    """
    out = []
    for blocks, covered in zip(pages, covered_words(pages, names, repeated)):
        article = [c for (part, _), c in zip(blocks, covered) if part in ARTICLE]
        copy = 2 * sum(int(c.sum()) for c in article) > sum(map(len, article))
        kept, cut = [], 0
        for (part, text), c in zip(blocks, covered):
            if c.any() and not (copy and part in ARTICLE):
                cut += 1
                text = " ".join(w for w, gone in zip(text.split(), c.tolist()) if not gone)
            if text:
                kept.append(text)
        out.append(("\n".join(kept), cut))
    return out


def dealt(pages: DataFrame, group_pages: int) -> DataFrame:
    """The pages with their host, a hash of their id, and `_group`, by hash; `_groups` where
    their host has several.

    Only hosts of several groups are looked up; they are broadcast if they are few.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#:]*)", 1))
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("_host"),
        F.xxhash64("page_id").alias("_name"))
    groups = F.greatest(
        F.ceil(F.count("*") / group_pages), F.ceil(F.sum(F.length("html")) / GROUP_CHARS))
    large = stage(rows.groupBy("_host").agg(groups.cast("bigint").alias("_groups")).filter(
        "_groups > 1"), "html-hosts")
    few = large.count() <= LARGE_HOSTS
    found = rows.join(F.broadcast(large) if few else large, "_host", "left")
    return found.withColumn("_group", F.coalesce(
        F.pmod(F.xxhash64("page_id", "url"), F.col("_groups")), F.lit(0)))


def parsed(rows: DataFrame) -> DataFrame:
    """Pages with the blocks that are no menus and the like, and a hash of these."""
    kind = dict(rows.dtypes)["page_id"]
    schema = (f"page_id {kind}, url string, _host string, _name bigint, _group bigint, _whole bigint,"
              " _parts array<int>, _texts array<string>")

    def work(blocks):
        for block in blocks:
            found = [[b for b in blocks_of(page) if b[0] != CHROME] for page in block.pop("html")]
            wholes = [xxhash.xxh64_intdigest("\n".join(t for _, t in b)) - (1 << 63) for b in found]
            yield {**block, "_whole": wholes, "_parts": [[p for p, _ in b] for b in found],
                   "_texts": [[t for _, t in b] for b in found]}

    return map_batches(rows.select("page_id", "url", "html", "_host", "_name", "_group"), schema, work)


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(_host, _group, _run): hashes of runs outside articles that pages of different name and
    text have, anywhere on a host of several groups, for each group that has them.

    Pages of these hosts are parsed once more for it; that costs less than keeping them.
    """
    outside = parsed(rows.filter("_groups IS NOT NULL")).filter(
        "exists(_parts, p -> p NOT IN (%d, %d))" % ARTICLE)
    schema = "_host string, _group bigint, _run bigint, _name bigint, _whole bigint"

    def work(blocks):
        for block in blocks:
            out = {c: [] for c in ("_host", "_group", "_run", "_name", "_whole")}
            for i, (parts, texts) in enumerate(zip(block["_parts"], block["_texts"])):
                runs = {r for *_, words in outside_stretches(list(zip(parts, texts)))
                        for r in run_hashes(words).tolist()}
                out["_run"] += runs
                for c in ("_host", "_group", "_name", "_whole"):
                    out[c] += [block[c][i]] * len(runs)
            yield out

    runs = map_batches(
        outside.select("_host", "_group", "_name", "_whole", "_parts", "_texts"), schema, work)
    ends = [f(c).alias(f"{c}{n}") for c in ("_name", "_whole") for f, n in ((F.min, 0), (F.max, 1))]
    each = runs.groupBy("_host", "_run").agg(F.collect_set("_group").alias("_in"), *ends)
    return each.filter("_name0 < _name1 AND _whole0 < _whole1").select(
        "_host", "_run", F.explode("_in").alias("_group"))


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated) of every page.

    Null html is empty and gives the empty text; a null url is a host of its own; rows
    with one page_id are one page, so a page repeated as a row is no boilerplate. An empty
    table gives no rows; further columns are not read.
    """
    rows = dealt(pages, group_pages)
    kind = dict(pages.dtypes)["page_id"]
    schema = f"page_id {kind}, url string, text string, n_chars bigint, n_repeated int"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def texts(key, own: pa.Table, runs: pa.Table) -> pa.Table:
        blocks = [list(zip(p, t)) for p, t in zip(own["_parts"].to_pylist(), own["_texts"].to_pylist())]
        names = own["page_id"].to_pylist()
        found = main_texts(blocks, names, runs["_run"].to_numpy()) if blocks else []
        columns = [names, own["url"].to_pylist(), [t for t, _ in found], [len(t) for t, _ in found],
                   [n for _, n in found]]
        return pa.table([pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)

    return (parsed(rows).select("_host", "_group", "page_id", "url", "_parts", "_texts")
            .groupBy("_host", "_group")
            .cogroup(repeated_runs(rows).groupBy("_host", "_group")).applyInArrow(texts, schema))
