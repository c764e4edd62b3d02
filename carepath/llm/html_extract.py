"""Main-text extraction with nearest-URL page differencing.

1. Each page is parsed once into its text blocks in order.  A block knows its
   role: *article* inside an article, *main* inside a main element else, *dropped* inside menus,
   headers, footers, sidebars, notices, adverts, forms, comments, scripts and
   the like, else *open*.  Elements are dropped by tag, ARIA role or a class or
   id that is as a whole such a name or made of such names and container words
   (``ad-box``, ``site-footer``; not ``related-work``); inside an article such
   names count on containers only, never on headings, paragraphs or cells.  An
   element whose end tag is missing ends at the next article or main element,
   and drops nothing if the page would be empty otherwise.
2. Every page with text is differenced.  Pages whose article and main blocks hold at
   least half of the characters that aren't dropped (the *marked* side), and the others (no article, or
   a teaser beside the text), are put in a total order of (host, side, path segments, url, id) by
   range partitions, so a page's neighbours in URL space are the rows next to it,
   also on a host with a third of all pages.  Pages of a host and side with equal lines
   (copies) are one page there, in the first one's place.  Neighbours that are near
   copies (see 4) form runs; the pages next to a run on the same host and side are the
   candidates of all its pages, and the one sharing more path segments (the
   earlier one if equal) is the pair.  Where there is no such page, the host's pages of
   the other side are put in order with it, and the pair is the nearest of these (of marked ones, the open blocks).
3. The pair's lines are aligned by longest common subsequence, and lines that
   both pages share are template text and deleted.
4. Two pages are near copies, and delete nothing from one another, where
   the shared lines hold more than ``NEAR_CHARS`` of both pages' characters, or what differs
   shares more than ``NEAR_WORDS`` of its words (a protected block of a marked page counts as one word).
5. The check of every page that follows: where article and main blocks hold at least half of what is
   left of a page with these whole, its open blocks go and its *protected* blocks (those in
   articles, or in main where it has no article) come back, since articles that repeat on a site
   are wanted whole; its other main blocks stay deleted.  Else what is left of the page is its text.

Defined cases: null html is an empty page with empty text; a page alone on its
host, or with near copies only, has no pair and loses no line; a null url is a host of its own;
repeated rows and other copies keep their text and lose what they share with
the nearest page that differs; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, discard, free_shuffles, global_rank

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
DROP_TAGS = frozenset("head title script style noscript template nav header footer aside form button select option textarea input iframe object "
                      "svg math canvas audio video dialog menu".split())
MAIN_TAGS = frozenset(("article", "main"))
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROP_NAMES = frozenset("nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored "
                       "banner cookie cookies consent gdpr notice notices alert popup modal promo newsletter subscribe signup share sharing social "
                       "related recommended breadcrumb breadcrumbs comment comments disqus respond reply replies".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
CONTAINERS = frozenset("area bar block body bottom box container content footer global group holder inner item items left links list main outer page "
                       "panel right section site slot thread top unit widget wrap wrapper".split())
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre td th tr table tbody li dt dd figure figcaption".split()) | INLINE
_NAME = re.compile(r"[a-z0-9]+")
MAIN, OPEN, ARTICLE = 0, 1, 2
NEAR_CHARS, NEAR_WORDS = 0.75, 0.5


def drops(name: str) -> bool:
    """Whether a class or id names a part that isn't main text, as a whole."""
    parts = _NAME.findall(name.lower())
    return any(p in DROP_NAMES for p in parts) and all(p in DROP_NAMES or p in CONTAINERS for p in parts)


class _Blocks(HTMLParser):
    """Collects (role, text) blocks; blocks in dropped elements are left out."""

    def __init__(self, unclosed: frozenset = frozenset(), trusted: bool = True):
        super().__init__(convert_charrefs=True)
        self.unclosed, self.trusted = unclosed, trusted    # tags that lack end tags; whether these may drop anything
        self.stack: list[tuple[str, bool, int]] = []       # tag, dropped, role: with what stands above
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []

    def _state(self):
        return self.stack[-1][1:] if self.stack else (False, OPEN)

    def flush(self):
        if self.text:
            words = " ".join("".join(self.text).split())
            self.text = []
            if words:
                self.blocks.append((self._state()[1], words))

    def _pop(self, i):
        self.flush()
        del self.stack[i:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:                                 # an open paragraph ends before such an element
            for i in range(len(self.stack) - 1, -1, -1):
                above = self.stack[i][0]
                if above == "p":
                    self._pop(i)
                    break
                if above not in INLINE:
                    break
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in ("li", "option", "tr", "td", "th", "dt", "dd") and self.stack and self.stack[-1][0] == tag:
            self._pop(len(self.stack) - 1)
        named = dict(attrs)
        role = (named.get("role") or "").lower()
        if tag in MAIN_TAGS or role in MAIN_TAGS:           # an element that lacks its end tag ends here at the latest
            for i, (above, gone, _) in enumerate(self.stack):
                if gone:
                    if above in self.unclosed:
                        self._pop(i)
                    break
        dropped, within = self._state()
        names = f"{named.get('class') or ''} {named.get('id') or ''}".split()
        if tag in ("html", "body") or within != OPEN and tag in TEXT_TAGS:
            names = []
        elif tag in MAIN_TAGS:                              # an article may be a comment, not a menu
            names = [n for n in names if {"comment", "comments", "reply", "replies"} & set(_NAME.findall(n.lower()))]
        here = tag in DROP_TAGS or role in DROP_ROLES or "hidden" in named or any(map(drops, names))
        dropped = dropped or here and (self.trusted or tag not in self.unclosed or tag in ("script", "style", "head", "title"))
        if "article" in (tag, role):
            within = ARTICLE
        elif within == OPEN and "main" in (tag, role):
            within = MAIN
        self.stack.append((tag, dropped, within))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i) if tag not in INLINE else self._unwrap(i)
                return

    def _unwrap(self, i):
        if any(t not in INLINE for t, _, _ in self.stack[i + 1:]) or self.stack[i][1:] != (self.stack[i - 1][1:] if i else (False, OPEN)):
            self.flush()
        del self.stack[i:]

    def handle_data(self, data):
        if not self._state()[0]:
            self.text.append(data)


_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """(role, text) of the blocks that aren't dropped, in order."""
    html = html or ""
    count: dict[str, int] = {}
    for end, tag in _TAG.findall(html):
        count[tag.lower()] = count.get(tag.lower(), 0) + (-1 if end else 1)
    unclosed = frozenset(tag for tag, n in count.items() if n > 0 and tag not in VOID)
    for trusted in (True, False):
        parser = _Blocks(unclosed, trusted)
        parser.feed(html)
        parser.close()
        parser.flush()
        if parser.blocks or not unclosed:
            break
    return parser.blocks


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` lie on a longest common subsequence with ``b``."""
    out = np.zeros(len(a), bool)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        out[head] = True
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        out[len(a) - 1 - tail] = True
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    if not set(x.tolist()).isdisjoint(y.tolist()):
        keep_x, keep_y = np.isin(x, y), np.isin(y, x)      # lines of one page only can't be on it
        at, x, y = np.flatnonzero(keep_x) + head, x[keep_x], y[keep_y]
        _hirschberg(x, y, at, out)
    return out


def _lengths(x, y):
    """LCS lengths of all of ``x`` with every beginning of ``y``."""
    row = np.zeros(len(y) + 1, np.int64)
    for v in x:
        step = np.where(y == v, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], step))
    return row


def _hirschberg(x, y, at, out):
    """Divide and conquer: memory linear in the lines of a page."""
    todo = [(0, len(x), 0, len(y))]
    while todo:
        i, j, k, m = todo.pop()
        if i >= j or k >= m:
            continue
        if j - i == 1:
            out[at[i]] |= bool((y[k:m] == x[i]).any())
            continue
        mid = (i + j) // 2
        best = k + int(np.argmax(_lengths(x[i:mid], y[k:m]) + _lengths(x[mid:j][::-1], y[k:m][::-1])[::-1]))
        todo += [(i, mid, k, best), (mid, j, best, m)]


def near_copies(texts, lines, sizes, others, other_lines, other_sizes) -> bool:
    """Whether two pages (texts, line hashes and lengths of their blocks) are copies but for
    small changes; a block whose text is None is one word, its line."""
    mine, theirs = shared_lines(lines, other_lines), shared_lines(other_lines, lines)

    def share(lengths, gone):
        return int(lengths[gone].sum()) / max(1, int(lengths.sum()))

    def rest(words, hashes, gone):
        out = set()
        for t, h, g in zip(words, hashes.tolist(), gone):
            if not g:
                out.update((h,) if t is None else t.split())
        return out

    if min(share(sizes, mine), share(other_sizes, theirs)) > NEAR_CHARS:
        return True
    x, y = rest(texts, lines, mine), rest(others, other_lines, theirs)
    return len(x & y) > NEAR_WORDS * len(x | y)


def protected(kinds: np.ndarray) -> np.ndarray:
    """Which blocks of a marked page differencing can't delete: its articles', else those of main."""
    return kinds == (ARTICLE if (kinds == ARTICLE).any() else MAIN)


def kept(kinds: np.ndarray, sizes: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Which blocks are a page's text, once differencing has deleted ``gone``."""
    inside = kinds != OPEN
    if inside.any() and sizes[inside].sum() >= sizes[~inside & ~gone].sum():
        return inside & (~gone | protected(kinds))
    return ~gone


_PAGE = "packed binary, open boolean, kinds array<tinyint>, sizes array<int>, lines array<long>, texts array<string>, key long"
_LINES = ["sizes", "lines", "texts"]                        # what the alignment of two pages reads


def _hashed(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _parsed(pages: DataFrame) -> DataFrame:
    """Add what each page's blocks are: their texts (``packed``), roles, lengths and line hashes, which
    side the page is on, the words of blocks that aren't protected, and a hash of all its lines."""

    def parse(html: pd.Series) -> pd.DataFrame:
        out = []
        for h in html:
            blocks = blocks_of(h)
            words = [t for _, t in blocks]
            kinds, sizes = np.array([k for k, _ in blocks], np.int8), np.array([len(t) for t in words], np.int32)
            inside = kinds != OPEN
            marked = bool(inside.any()) and 2 * int(sizes[inside].sum()) >= int(sizes.sum())
            seen = [None if p else t for t, p in zip(words, protected(kinds))] if marked else words
            raw = [t.encode("utf-8", "surrogatepass") for t in words]
            lines = np.array([_hashed(t) for t in raw], np.int64)
            # A block holds no line break.
            out.append((zlib.compress(b"\n".join(raw)), not marked, kinds, sizes, lines, seen, _hashed(lines.tobytes())))
        return pd.DataFrame(out, columns=["packed", "open", "kinds", "sizes", "lines", "texts", "key"])

    return pages.withColumn("_p", F.pandas_udf(parse, _PAGE)("_html")).drop("_html")


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(``id_col``, ``url_col``, text, n_chars), one row per row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    bare = F.regexp_replace(F.coalesce("_url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|[?#].*$", "")
    rows = rows.withColumns({"_host": F.lower(F.regexp_extract(bare, r"^[^/]*", 0)),
                             "_path": F.filter(F.split(F.regexp_extract(bare, r"^[^/]*(.*)$", 1), "/"), lambda s: s != "")})
    parsed = cut(_parsed(rows).select("_id", "_url", "_host", "_path", "_p.*"), "pages")
    where = ["_host", "open", "key"]                        # a page among its copies

    def same(p, q):
        """Path segments that two pages of one host share, before the first that differs."""
        pairs = F.zip_with(p, q, lambda x, y: F.coalesce(x == y, F.lit(False)))
        first = F.array_position(pairs, False)
        return F.when(first > 0, first - 1).otherwise(F.size(pairs))

    def folded(some):
        """One row per host, side and lines: copies share the first one's place."""
        return (some.where(F.size("lines") > 0).groupBy(*where).agg(F.min(F.struct("_path", "_url", "_id", *_LINES)).alias("_r"))
                .select(*where, "_r.*"))

    def ranked(some):
        """Places in the order of (host, side, path, url, id)."""
        return global_rank(some, ["_host", "open", "_path", "_url", "_id", "key"], "_at")

    def beside(order, *columns):
        return order.select(F.col("_at").alias("_n"), F.col("_host").alias("_h"), F.col("open").alias("_o"), *[F.col(c).alias(f"_{c}_") for c in columns])

    near = F.expr("_h = _host and _o = open")

    def alike(texts: pd.Series, lines: pd.Series, sizes: pd.Series, others: pd.Series, other_lines: pd.Series, other_sizes: pd.Series) -> pd.Series:
        return pd.Series([near_copies(*page) for page in zip(texts, lines, sizes, others, other_lines, other_sizes)], dtype=bool)

    def with_runs(order):
        """Add the first and last place of the row's run of neighbours that are near copies."""
        links = (order.select("_at", "_host", "open", *_LINES).join(beside(order, *_LINES), F.col("_n") == F.col("_at") + 1).where(near)
                 .where(F.pandas_udf(alike, "boolean")("texts", "lines", "sizes", "_texts_", "_lines_", "_sizes_"))
                 .select(F.col("_at").alias("a"), F.col("_n").alias("b")))
        runs = connected_components(links)
        ends = runs.groupBy("component").agg(F.max("node").alias("_end"))
        runs = runs.join(ends, "component").select(F.col("node").alias("_at"), F.col("component").alias("_start"), "_end")
        return (order.select("_at", *where, "_path").join(runs, "_at", "left")
                .withColumns({"_first": F.coalesce("_start", "_at"), "_last": F.coalesce("_end", "_at")}).drop("_start", "_end"))

    def paired(some, order):
        """The place of the pair of each row of ``some`` (with ``_first`` and ``_last``, the ends of its run of near copies)."""
        return (some.withColumn("_n", F.explode(F.array(F.col("_first") - 1, F.col("_last") + 1))).join(beside(order, "_path"), "_n").where(near)
                .groupBy("_at").agg(F.max_by("_n", F.struct(same(F.col("_path"), F.col("__path_")), -F.col("_n"))).alias("_n")))

    def shared(texts: pd.Series, lines: pd.Series, sizes: pd.Series, others: pd.Series, other_lines: pd.Series, other_sizes: pd.Series) -> pd.Series:
        """Places of the blocks that a page shares with its pair; none if they are near copies."""
        return pd.Series([[] if near_copies(t, x, n, s, y, m) else np.flatnonzero(shared_lines(x, y)).astype(np.int32)
                          for t, x, n, s, y, m in zip(texts, lines, sizes, others, other_lines, other_sizes)], dtype=object)

    def differenced(pairs, order, name):
        """What each page of ``pairs`` loses to its pair, written."""
        sides = order.select("_at", *where, *_LINES).join(pairs, "_at").join(beside(order, *_LINES).drop("_h", "_o"), "_n")
        gone = F.pandas_udf(shared, "array<int>")("texts", "lines", "sizes", "_texts_", "_lines_", "_sizes_")
        return cut(sides.select(*where, gone.alias("_gone")), name)

    order = ranked(folded(parsed))
    found = differenced(paired(with_runs(order), order), order, "pairs")
    # What is left has no page of its side that differs beside it; the pages next to it are the other side's.
    lone = order.join(found.select(*where), where, "left_anti").drop("_at").withColumn("_lone", F.lit(True))
    if not lone.isEmpty():
        opens = lambda c: F.transform(F.filter(F.arrays_zip("kinds", c), lambda z: z["kinds"] == OPEN), lambda z: z[c])
        other = parsed.withColumns({c: F.when(F.col("open"), F.col(c)).otherwise(opens(c)) for c in _LINES})
        other = other.withColumn("key", F.when(F.col("open"), F.col("key")).otherwise(F.xxhash64("lines"))).withColumn("open", ~F.col("open"))
        other = folded(other.join(lone.select("_host", "open").distinct(), ["_host", "open"], "left_semi")).withColumn("_lone", F.lit(False))
        mixed = ranked(lone.unionByName(other))
        single = mixed.where("_lone").withColumns({"_first": F.col("_at"), "_last": F.col("_at")})
        found = found.union(differenced(paired(single, mixed.where("not _lone")), mixed, "pairs"))
        discard(mixed)
    discard(order)
    free_shuffles(pages.sparkSession)                       # before the last join, the largest

    def compose(packed: pd.Series, kinds: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for data, k, places in zip(packed, kinds, gone):
            if len(k):
                deleted = np.zeros(len(k), bool)
                if places is not None:
                    deleted[places] = True
                words = zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n")
                stay = kept(k, np.array([len(t) for t in words]), deleted)
                out.append(" ".join([t for t, stays in zip(words, stay) if stays]))
            else:
                out.append("")
        return pd.Series(out, dtype=object)

    texts = F.pandas_udf(compose, "string")("packed", "kinds", "_gone")
    whole = parsed.select("_id", "_url", *where, "packed", "kinds").join(found, where, "left").select("_id", "_url", texts.alias("text"))
    return whole.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
