"""Main text of web pages: declared articles first, a host-wide suffix array for the rest.

A page's blocks are read with their place: in an article, in a main element, in chrome (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments, by element, role, class or
id) or loose. What the markup leaves open, the pages of the host decide: suffix arrays over batches
of their token streams find the distinct substrings, and the pages of each are counted over the
whole host. Open are the loose blocks of pages that declare no article, of which only the runs that
few pages have stay, and the boxes of declared articles: elements with a class or id that says
nothing. A box goes if the host shows all of it around articles too, and in different articles. The
rest of a declared article stays whole: passages that many pages share are content there.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Set
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.storage import written

# Elements and names by which pages mark their parts.
RAW_TEXT = frozenset("script style title textarea noscript iframe xmp noembed template".split())
CHROME_ELEMENTS = frozenset(
    "nav footer aside form button select menu dialog head svg object audio video canvas".split()
)
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar"
    " toolbar form status".split()
)
CHROME_NAMES = frozenset(
    "nav navbar navigation menu submenu sidebar masthead footer ad ads adv advert adverts"
    " advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription"
    " signup login comment comments disqus respond replies reply form search share sharing social"
    " related recommended breadcrumb breadcrumbs pagination pager toolbar widget widgets"
    # Compounds, with "-" for whatever joins them. Parts of other names say nothing: "no-sidebar".
    " site-nav site-navigation main-nav main-navigation main-menu primary-menu primary-nav top-nav"
    " top-menu side-nav side-menu side-bar nav-bar nav-menu nav-links post-navigation menu-item"
    " sidebar-widget widget-area site-footer page-footer main-footer entry-footer post-footer"
    " article-footer footer-nav footer-links footer-menu footer-widgets ad-banner ad-block ad-box"
    " ad-container ad-slot ad-space ad-unit ad-wrapper banner-ad sidebar-ad top-ad google-ad"
    " google-ads sponsored-content sponsored-links promo-box promo-banner cookie-banner cookie-bar"
    " cookie-consent cookie-notice cookie-policy cookie-popup consent-banner gdpr-banner gdpr-notice"
    " privacy-notice alert-box modal-dialog modal-overlay popup-overlay newsletter-box"
    " newsletter-form newsletter-popup newsletter-signup signup-form subscribe-box subscribe-form"
    " login-form comment-form comment-list comments-area comments-list comments-section comment-body"
    " comment-respond disqus-thread reply-form contact-form search-bar search-box search-form"
    " searchform share-bar share-box share-buttons share-links sharing-buttons social-bar"
    " social-buttons social-icons social-links social-media social-share related-articles"
    " related-content related-links related-posts recommended-articles recommended-posts"
    " breadcrumb-nav breadcrumb-trail".split()
)
HEADER_NAMES = frozenset(
    "header topbar top-bar top-header site-header page-header main-header".split()
)
#: A name that begins or ends with one of these words is chrome, unless another word says otherwise.
CHROME_WORDS = frozenset(
    "comment comments commentlist ad ads advert adverts advertisement advertisements".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond".split())
OTHER_WAY = frozenset("no not non has have with without is can hide hidden free".split())
#: Articles of these names only lead to others.
TEASER_WORDS = frozenset("card teaser preview".split())
MAIN_IDS = frozenset("content main main-content page-content site-content".split())
ARTICLE_NAMES = frozenset(
    "article-body article-content articlebody post-content post-body entry-content"
    " story-body".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))")
_MARKS = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_JOINT = re.compile(r"[^a-z0-9]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")

LOOSE, MAIN, ARTICLE, COMMENT = 0, 1, 2, 3


def _said(names: set[str], words: frozenset[str]) -> bool:
    """Whether a name begins or ends with one of the words."""
    parts = [name.split("-") for name in names]
    return any(
        (p[0] in words or p[-1] in words) and OTHER_WAY.isdisjoint(p) for p in parts
    )


@lru_cache(4096)
def _marked(element: str, attributes: str) -> tuple[bool, bool, int, bool]:
    """Whether an element is chrome or a header, the zone that it opens, and whether it is named.

    Classes and ids count as whole names, and make no chrome of a declared article. Comments and
    adverts are told by the first or last word of a name too. An article that is named as a comment
    is a zone of its own, one that is named as a teaser is none.
    """
    chrome, header = element in CHROME_ELEMENTS, element == "header"
    article, main, comment = element == "article", element == "main", False
    names: set[str] = set()
    if _MARKS.search(attributes):
        values = {
            m[0].lower(): (m[1] or m[2] or m[3]).lower() for m in _ATTRIBUTE.findall(attributes)
        }
        named = f"{values.get('class', '')} {values.get('id', '')}"
        names = {_JOINT.sub("-", name).strip("-") for name in named.split()}
        comment = article and _said(names, COMMENT_WORDS)
        article &= not _said(names, TEASER_WORDS)
        article |= values.get("itemprop") == "articlebody" or not ARTICLE_NAMES.isdisjoint(
            named.split()
        )
        if element not in ("html", "body", "main"):
            chrome |= not article and element != "article" and (
                not names.isdisjoint(CHROME_NAMES) or _said(names, CHROME_WORDS)
            )
            header |= not article and not names.isdisjoint(HEADER_NAMES)
            chrome |= values.get("role") in CHROME_ROLES
            main |= values.get("role") == "main" or values.get("id", "").strip() in MAIN_IDS
            rest = _ATTRIBUTE.sub(" ", attributes).lower().replace("/", " ").split()
            chrome |= "hidden" in rest or "hidden" in values
            chrome |= "display:none" in values.get("style", "").replace(" ", "")
    zone = COMMENT if comment else ARTICLE if article else MAIN if main else LOOSE
    return chrome, header, zone, bool(names)


class _Reader:
    """One pass over the tags of a page."""

    def __init__(self) -> None:
        self.found: list[tuple[int, bool, str, int]] = []
        self.text: list[str] = []
        # Elements that opened a zone or a box, and like ones inside, with the zone and box around.
        self.opened: list[tuple[str, int, int]] = []
        self.names: Counter[str] = Counter()
        self.zone, self.box, self.boxes = LOOSE, 0, 0
        self.chrome, self.depth, self.inner = "", 0, 0

    def read(self, html: str) -> list[tuple[int, bool, str, int]]:
        at = 0
        while (tag := _TAG.search(html, at)) is not None:
            if tag.start() > at:
                self.text.append(entities.unescape(html[at : tag.start()]))
            at = tag.end()
            if tag[2] is None:
                continue
            element = tag[2].lower()
            if tag[1]:
                self.end(element)
            elif element in RAW_TEXT:
                close = re.compile(rf"</{re.escape(element)}[^>]*>", re.I).search(html, at)
                at = close.end() if close else len(html)
                self.text.append(" ")
            else:
                self.start(element, tag[3].rstrip("/"))
        self.text.append(entities.unescape(html[at:]))
        self.flush()
        return self.found

    def flush(self) -> None:
        joined = " ".join("".join(self.text).split())
        self.text.clear()
        if joined:
            self.found.append((self.zone, bool(self.chrome), joined, self.box))

    def leave(self) -> str:
        element, self.zone, self.box = self.opened.pop()
        self.names[element] -= 1
        return element

    def start(self, element: str, attributes: str) -> None:
        inline = element in INLINE
        if element in VOID:
            self.text.append(" ") if element == "br" else None if inline else self.flush()
            return
        if not inline:
            self.flush()
            if self.chrome in ("p", "li") and (self.chrome == "p" or element == "li"):
                self.chrome = ""  # these end where the next one begins
            last, zone, box = self.opened[-1] if self.opened and not self.chrome else ("", 0, 0)
            if (zone, box) != (self.zone, self.box) and zone == self.zone:
                if last == "p" or last == element == "li":
                    self.leave()
        if self.chrome:
            self.depth += element == self.chrome
            self.inner += element in ("article", "main")
            return
        if inline and not _MARKS.search(attributes):
            return
        chrome, header, zone, named = _marked(element, attributes)
        box = named and self.zone in (MAIN, ARTICLE) and not inline and element not in HEADINGS
        if chrome or header and self.zone < ARTICLE:
            self.flush()
            self.chrome, self.depth, self.inner = element, 1, 0
        elif zone or box or self.names[element]:
            self.opened.append((element, self.zone, self.box))
            self.names[element] += 1
            self.zone = max(self.zone, zone)
            if zone:
                self.box = 0
            elif box:
                self.boxes += 1
                self.box = self.boxes

    def end(self, element: str) -> None:
        if element not in INLINE:
            self.flush()
        if self.chrome:
            around = element in ("article", "main", "body", "html")
            self.depth -= element == self.chrome
            if not self.depth or around and not self.inner:
                self.flush()
                self.chrome = ""
            elif around:
                self.inner -= 1
            if not around or self.chrome:
                return
        if self.names[element]:
            while self.leave() != element:
                pass


def blocks(html: str) -> list[tuple[int, bool, str, int]]:
    """The text blocks of a page in order: zone, whether chrome, text in single spaces, box.

    A box is an element in a declared zone, no heading, whose class or id does not say what it is.
    Boxes are numbered from 1; a block is of the innermost one, or of 0 where an article or main
    element is nearer.
    """
    return _Reader().read(html)


def chosen_zones(parts: list[tuple[int, str, int]], without: Set[int] = frozenset()) -> set[int]:
    """The zones that are a page's text, by its blocks (zone, text, box) that are no chrome.

    Articles are the text; where the main element around them holds more than they do, it is all of
    that element. Comments are left out, unless a page has nothing else. Some boxes may be left out.
    """
    sizes = [0] * 4
    for zone, text, box in parts:
        sizes[zone] += 0 if box in without else len(text)
    if sizes[ARTICLE] or sizes[MAIN]:
        return {ARTICLE, MAIN} if sizes[MAIN] > sizes[ARTICLE] else {ARTICLE}
    return {LOOSE} if sizes[LOOSE] or not sizes[COMMENT] else {COMMENT}


def _split(found: list[tuple[int, bool, str, int]]) -> tuple[str | None, list[str], list[str]]:
    chosen = chosen_zones([(zone, text, box) for zone, chrome, text, box in found if not chrome])
    inside = [text for zone, chrome, text, _ in found if zone in chosen and not chrome]
    outside = [text for zone, chrome, text, _ in found if zone not in chosen or chrome]
    if chosen == {LOOSE}:
        return None, inside, outside
    return " ".join(inside), [], outside


def read_page(html: str) -> tuple[str | None, list[str], list[str]]:
    """What the page says alone: the declared article's text or None, the loose blocks, and all
    blocks outside the article. Loose blocks and boxes are for the host's pages to judge."""
    return _split(blocks(html))


def boxed_texts(parts: list[tuple[int, str, int]], min_tokens: int) -> dict[int, str]:
    """The text of each box of ``min_tokens`` words or more, of blocks (zone, text, box)."""
    texts: dict[int, list[str]] = {}
    for zone, text, box in parts:
        if box and zone in (MAIN, ARTICLE):
            texts.setdefault(box, []).append(text)
    joined = {box: " ".join(own) for box, own in texts.items()}
    return {box: text for box, text in joined.items() if len(text.split()) >= min_tokens}


def without_boxes(parts: list[tuple[int, str, int]], without: Set[int]) -> str:
    """The declared text without some boxes, or all of it where nothing else is declared."""
    if all(box in without for zone, _, box in parts if zone in (MAIN, ARTICLE)):
        without = frozenset()
    chosen = chosen_zones(parts, without)
    return " ".join(text for zone, text, box in parts if zone in chosen and box not in without)


def article_mark(parts: list[tuple[int, str, int]], min_tokens: int) -> int:
    """The least hash of the substrings of a declared text, boxes left out if there is other text.

    Near copies of an article mostly have the same mark, different articles do not.
    """
    declared = [(text, box) for zone, text, box in parts if zone in (MAIN, ARTICLE)]
    words = " ".join(text for text, box in declared if not box).split()
    if len(words) < min_tokens:
        words = " ".join(text for text, _ in declared).split()
    last = max(len(words) - min_tokens, 0)
    return min(_hash(" ".join(words[i : i + min_tokens])) for i in range(last + 1))


def substrings(
    streams: list[np.ndarray], min_tokens: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The substrings of ``min_tokens`` tokens: their streams, places, classes, and all the text.

    The streams are concatenated, each with an end mark of its own, and the suffixes are sorted by
    doubling prefixes to a depth of at least ``min_tokens``. Neighbours in that order that agree so
    far form one substring, a class. The result is in the order of the classes.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    if not sizes.sum():
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(int(len(sizes)), np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    top = max(int(s.max()) for s in streams if len(s)) + 1
    text = np.empty(int(ends[-1]), np.int64)
    owner = np.repeat(np.arange(len(streams)), sizes + 1)
    left = np.empty(len(text), np.int64)  # tokens up to the stream's end
    for i, (stream, start, size) in enumerate(zip(streams, starts, sizes)):
        text[start : start + size] = stream
        text[start + size] = top + i
        left[start : start + size + 1] = np.arange(size, -1, -1)
    rank, depth = np.unique(text, return_inverse=True)[1], 1
    while depth < min_tokens:
        step = min(depth, min_tokens - depth)
        following = np.zeros_like(rank)
        following[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(text) + 2) + following, return_inverse=True)[1]
        depth += step
    whole = np.flatnonzero(left >= min_tokens)
    order = whole[np.argsort(rank[whole], kind="stable")]
    return owner[order], order, rank[order], text


def covered_tokens(sizes: np.ndarray, places: np.ndarray, min_tokens: int) -> list[np.ndarray]:
    """For each token of streams with end marks, whether a substring at one of the places has it."""
    ends = np.cumsum(sizes + 1)
    change = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + min_tokens, -1)
    covered = np.cumsum(change[:-1]) > 0
    return [covered[end - 1 - n : end - 1] for end, n in zip(ends, sizes)]


def repeated_tokens(
    streams: list[np.ndarray], pages: np.ndarray, min_tokens: int, min_pages: int
) -> list[np.ndarray]:
    """For each token of each stream, whether a substring covers it that starts on ``min_pages``
    different ``pages``."""
    owner, places, classes, text = substrings(streams, min_tokens)
    pairs = np.unique(np.stack([classes, pages[owner]], axis=1), axis=0)
    often = np.bincount(pairs[:, 0], minlength=len(text) + 1) >= min_pages
    sizes = np.array([len(s) for s in streams], np.int64)
    return covered_tokens(sizes, places[often[classes]], min_tokens)


def _hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def substring_keys(
    host: str, words: dict[str, int], text: np.ndarray, places: np.ndarray, min_tokens: int
) -> np.ndarray:
    """64-bit hashes of host and words of the substrings at the places, alike in all processes."""
    hashes = np.array([_hash(word) for word in words], np.int64).view(np.uint64)
    keys = np.full(len(places), _hash(host), np.int64).view(np.uint64)
    for j in range(min_tokens):
        keys ^= hashes[text[places + j]]
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def _numbered(texts: list[str], words: dict[str, int]) -> np.ndarray:
    return np.array([words.setdefault(w, len(words)) for t in texts for w in t.split()], np.int64)


def page_substrings(
    host: str,
    loose: list[list[str]],
    outside: list[list[str]],
    boxed: list[list[str]],
    pages: np.ndarray,
    articles: np.ndarray,
    min_tokens: int,
    min_pages: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``key, page, within, open``: the distinct substrings of some pages of a host.

    A substring has a row for each of its ``min_pages`` smallest different ``pages`` around declared
    articles, and one for each of its ``min_pages`` smallest different ``articles`` that have it
    within a box: whether it is on so many can be told from the rows of all arrays, and a passage on
    all pages has no more rows than any other. ``open`` is set on one row of a substring that a loose
    block, or within articles a box, has.
    """
    words: dict[str, int] = {}
    streams = [_numbered(texts, words) for own in zip(loose, outside, boxed) for texts in own]
    owner, places, classes, text = substrings(streams, min_tokens)
    if not len(places):
        return places, places, places.astype(bool), places.astype(bool)
    first = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]])
    number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(classes)]))
    keys = substring_keys(host, words, text, places[first], min_tokens)
    is_open = np.stack([np.bincount(number, weights=owner % 3 == kind) > 0 for kind in (0, 2)])
    found = []
    for within, marks in enumerate((pages, articles)):
        rows = np.flatnonzero((owner % 3 == 2) == bool(within))
        which, mark = number[rows], marks[owner[rows] // 3]
        order = np.lexsort((mark, which))
        which, mark = which[order], mark[order]
        new = np.r_[True, (which[1:] != which[:-1]) | (mark[1:] != mark[:-1])][: len(which)]
        which, mark = which[new], mark[new]
        begin = np.r_[True, which[1:] != which[:-1]][: len(which)]
        nth = np.arange(len(which)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
        which, mark, nth = (column[nth < min_pages] for column in (which, mark, nth))
        sides = np.full(len(which), bool(within))
        found.append((keys[which], mark, sides, is_open[within][which] & (nth == 0)))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def frequent_tokens(
    host: str, texts: list[list[str]], frequent: np.ndarray, min_tokens: int
) -> list[np.ndarray]:
    """For each word of each list of texts, whether a substring with a ``frequent`` key covers it."""
    words: dict[str, int] = {}
    streams = [_numbered(own, words) for own in texts]
    sizes = np.array([len(s) for s in streams], np.int64)
    places = [np.zeros(0, np.int64)]
    for start, n in zip(np.cumsum(sizes + 1) - sizes - 1, sizes):
        places.append(np.arange(start, start + max(n - min_tokens + 1, 0)))
    end = np.zeros(1, np.int64)
    text = np.concatenate([end[:0], *(part for stream in streams for part in (stream, end))])
    at = np.concatenate(places)
    marked = at[np.isin(substring_keys(host, words, text, at, min_tokens), frequent)]
    return covered_tokens(sizes, marked, min_tokens)


def unique_runs(
    host: str, loose: list[list[str]], frequent: np.ndarray, min_tokens: int
) -> list[str]:
    """The text of each page's loose blocks without the substrings that have a ``frequent`` key."""
    kept = []
    for own, covered in zip(loose, frequent_tokens(host, loose, frequent, min_tokens)):
        tokens = [w for text in own for w in text.split()]
        kept.append(" ".join(w for w, gone in zip(tokens, covered) if not gone))
    return kept


def unboxed_texts(
    host: str, pages: list[list[tuple[int, str, int]]], frequent: np.ndarray, min_tokens: int
) -> list[str]:
    """The declared text of each page, of blocks (zone, text, box), without the boxes that substrings
    with a ``frequent`` key cover from the first word to the last."""
    boxes = [boxed_texts(parts, min_tokens) for parts in pages]
    texts = [[text] for own in boxes for text in own.values()]
    covered = iter(frequent_tokens(host, texts, frequent, min_tokens))
    return [
        without_boxes(parts, {box for box in own if next(covered).all()})
        for parts, own in zip(pages, boxes)
    ]


def main_text(
    pages: DataFrame, min_tokens: int = 8, min_pages: int = 3, pages_per_array: int = 512
) -> DataFrame:
    """``page_id, url, text``: the main text of every page.

    The text of a page that declares an article (or else a main element) is all that stands there
    outside chrome, but for boxes: an element with a class or id goes, if substrings of
    ``min_tokens`` words cover all of its text that ``min_pages`` pages of the host have around their
    articles and ``min_pages`` different articles have in boxes (near copies mostly count as one).
    Any other page gets its loose blocks without substrings of ``min_tokens`` words that
    ``min_pages`` pages of its host repeat. Character references are decoded, white space inside a
    block becomes one space, blocks are joined by one space. Nothing else is dropped.

    A host's pages are dealt by a hash of the page to suffix arrays of about ``pages_per_array``
    pages, so that one host's share of the rows does not matter. The arrays' substrings are counted
    over the whole host, by 64-bit hashes; pages with the same loose blocks count as one. Hosts whose
    pages have neither loose blocks nor boxes leave the arrays nothing to judge and get none. Null
    and empty pages give an empty text, a null url counts as a host of its own. Repeated rows give
    repeated rows. Other columns are left out. Empty tables give no rows.
    """

    lists = pa.list_(pa.string())
    places = pa.list_(pa.struct([("zone", pa.int8()), ("text", pa.string()), ("box", pa.int32())]))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hosts, texts, loose, outside, boxed, blocked, same, marks = ([] for _ in range(8))
            for page_id, url, html in zip(
                part["page_id"].to_pylist(), part["url"].to_pylist(), part["html"]
            ):
                found = blocks(html.as_py() or "")
                text, own, other = _split(found)
                own_blocks = [(zone, t, box) for zone, chrome, t, box in found if not chrome]
                boxes = boxed_texts(own_blocks, min_tokens)
                loose.append(own)
                outside.append(other)
                boxed.append(list(boxes.values()))
                host = _HOST.match(url or "")
                hosts.append(host[1].lower() if host else "")
                # Copies of a page count as one: a page that is copied whole is no boilerplate.
                same.append(_hash("\n".join(own) if own else repr((page_id, url, text, other))))
                marks.append(article_mark(own_blocks, min_tokens) if boxes else 0)
                # What the arrays have to judge gets its text after them.
                texts.append(None if boxes else text)
                blocked.append(
                    [dict(zone=z, text=t, box=b) for z, t, b in own_blocks] if boxes else None
                )
            yield pa.RecordBatch.from_arrays(
                [
                    part["page_id"],
                    part["url"],
                    pa.array(hosts, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(loose, lists),
                    pa.array(outside, lists),
                    pa.array(boxed, lists),
                    pa.array(blocked, places),
                    pa.array(same, pa.int64()),
                    pa.array(marks, pa.int64()),
                ],
                ["page_id", "url", "host", "text", "loose", "outside", "boxed", "blocks", "page",
                 "article"],
            )

    def emit(table: pa.Table) -> pa.Table:
        key, page, within, is_open = page_substrings(
            table["host"][0].as_py(),
            table["loose"].to_pylist(),
            table["outside"].to_pylist(),
            table["boxed"].to_pylist(),
            table["page"].to_numpy(),
            table["article"].to_numpy(),
            min_tokens,
            min_pages,
        )
        arrays = pa.array([table["array"][0].as_py()] * len(key), pa.string())
        return pa.table(
            {"array": arrays, "key": key, "page": page, "within": within, "open": is_open}
        )

    def clean(table: pa.Table, frequent: pa.Table) -> pa.Table:
        texts: list[str | None] = [None] * table.num_rows
        if table.num_rows:
            host, keys = table["host"][0].as_py(), frequent["key"].to_numpy()
            within = frequent["within"].to_numpy().astype(bool)
            loose, declared = {}, {}
            for i, (own, parts) in enumerate(
                zip(table["loose"].to_pylist(), table["blocks"].to_pylist())
            ):
                if parts is None:
                    loose[i] = own
                else:
                    declared[i] = [(p["zone"], p["text"], p["box"]) for p in parts]
            runs = unique_runs(host, list(loose.values()), keys[~within], min_tokens)
            unboxed = unboxed_texts(host, list(declared.values()), keys[within], min_tokens)
            for i, text in zip([*loose, *declared], runs + unboxed):
                texts[i] = text
        return pa.table(
            {"page_id": table["page_id"], "url": table["url"], "text": pa.array(texts, pa.string())}
        )

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html").mapInArrow(
        read,
        f"page_id {kind}, url string, host string, text string,"
        " loose array<string>, outside array<string>, boxed array<string>,"
        " blocks array<struct<zone: tinyint, text: string, box: int>>, page long, article long",
    )
    rows = written(rows, "pages", compression="zstd")
    sizes = (
        rows.groupBy("host")
        .agg(
            F.ceil(F.count("*") / pages_per_array).alias("arrays"),
            F.bool_or(F.col("text").isNull()).alias("any_open"),
        )
        .where("any_open")
    )
    sizes = written(sizes, "hosts")  # as a file of known size the join can tell that it is small
    # One column, so that rows dealt by host alone do not pass for dealt by array.
    number = F.pmod(F.xxhash64("page_id", "url"), F.col("arrays"))
    streams = rows.join(sizes, "host").withColumn("array", F.concat_ws("#", "host", number))
    found = (
        streams.select("host", "array", "loose", "outside", "boxed", "page", "article")
        .groupBy("array")
        .applyInArrow(emit, "array string, key long, page long, within boolean, open boolean")
    )
    found = written(found, "substrings", compression="zstd")
    counted = (
        found.select("key", "within", "page")
        .distinct()
        .groupBy("key")
        .agg(F.count_if(~F.col("within")).alias("around"), F.count_if("within").alias("articles"))
        .where(F.col("around") >= min_pages)
    )
    frequent = (
        found.where("open")
        .join(counted, "key")
        .where(~F.col("within") | (F.col("articles") >= min_pages))
        .select("array", "key", "within")
    )
    judged = (
        streams.where(F.col("text").isNull())
        .select("page_id", "url", "host", "array", "loose", "blocks")
        .groupBy("array")
        .cogroup(frequent.groupBy("array"))
        .applyInArrow(clean, f"page_id {kind}, url string, text string")
    )
    declared = rows.where(F.col("text").isNotNull()).select("page_id", "url", "text")
    return declared.unionByName(judged)
