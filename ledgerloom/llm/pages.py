"""Main text of HTML pages: structure first, and a host's suffix array for what structure leaves open.

A page becomes blocks in page order. Blocks inside the article container are content, blocks inside menus,
headers, adverts and the like are frame; others are open. Structure is in doubt about blocks of an article that
only a name like notice, side or footer marks, and about what lies in ``main`` beside an article. Frame, open and
doubtful blocks of a page form a token stream; the streams of a host form its suffix array. What stands on another page of the host too is
boilerplate: runs of ``DEPTH`` tokens or more wherever they begin, and runs of at least ``MIN_RUN`` tokens,
or whole blocks, from the start of a block on. The array is in two parts: suffixes at blocks, ``DEPTH``
tokens long, give the short runs; a hash of the ``DEPTH`` tokens at every place gives the long ones, since
a run of that length or more is just its places. Unique words of open blocks stay; a
doubtful block goes only if such runs cover it whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import partitions
from .jaccard import _groups

DEPTH = 16  # tokens of a suffix that are compared; a repeated run of as many counts wherever it begins
MIN_RUN = 4  # a repeated run of fewer tokens must be a whole block
COVERED = 0.5  # short runs leave an open block if all runs cover this share of it

CONTENT, OPEN, FRAME, DOUBT = 0, 1, 2, 3
MAIN, MAIN_DOUBT = 4, 5  # inside main, until the page tells whether an article has text

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_RAW = frozenset("script style noscript template textarea title svg annotation annotation-xml iframe canvas select option head audio video".split())
_RAW_ENDS = {t: re.compile(rf"</{t}\s*>|<body\b" if t == "head" else rf"</{t}\s*>", re.I) for t in _RAW}
_FRAME_TAGS = frozenset("nav footer aside form button dialog menu fieldset".split())
_WRAPS = frozenset({"form", "fieldset"})  # around a container these are the page
_LEFT_OPEN = frozenset({"nav", "header", "menu"})  # around the only container these were never closed
_FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_FRAME_WORDS = (
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|footer|masthead|topbar|cookies?|consent|gdpr|notice|banner|ads?|advert\w*|sponsor\w*|promo\w*|"
    r"comments?|commentlist|disqus|replies|reply|respond|share|sharing|social|related|recommended|subscribe|subscription|newsletter|signup|login|search|popup|modal|overlay|widget|pagination|pager|skip|toolbar"
)
# what these name is the same on all pages of a host if it is frame; inside an article they may also name its own parts
_DOUBTFUL_WORDS = r"notice|side|footer|masthead|topbar|banner|menu|nav|search|skip|toolbar"
# with these a frame word still names a piece of frame: share-buttons, but not share-price
_FRAME_PARTS = (
    r"article|articles|area|author|bar|block|blog|body|bottom|box|btns?|buttons?|center|close|col|column|container|content|count|desktop|div|entry|feed|fixed|floating|follow|form|global|group|header|"
    r"icons?|inline|inner|input|item|items|large|left|links?|list|main|message|mobile|more|outer|page|panel|policy|popular|posts?|primary|right|row|secondary|section|site|slot|small|stack|sticky|"
    r"stories|story|strip|tab|thread|title|to|toggle|tools|top|unit|us|widgets|wrap|wrapper|zone|\d+"
)
_FRAME_NAME = re.compile(rf"(?:(?:{_FRAME_PARTS})-)*(?:{_FRAME_WORDS})(?:-(?:{_FRAME_WORDS}|{_FRAME_PARTS}))*")
_DOUBTFUL_NAME = re.compile(rf"(?:(?:{_FRAME_PARTS})-)*(?:{_DOUBTFUL_WORDS})(?:-(?:{_DOUBTFUL_WORDS}|{_FRAME_PARTS}))*")
_ANSWER_NAME = re.compile(rf"(?:(?:{_FRAME_PARTS})-)*(?:comments?|reply|replies|ads?|advert\w*)(?:-(?:{_FRAME_PARTS}))*")
# ids of these are made from headings; they tell what the text is about
_ID_IS_TOPIC = frozenset("h1 h2 h3 h4 h5 h6 section p blockquote pre li dt dd figure figcaption table tbody tr td th caption a span".split())
_PIECE = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][\w:.-]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# an open p ends where a block starts; these end their own kind
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


@lru_cache(maxsize=4096)
def _frame_names(value: str, pattern: re.Pattern = _FRAME_NAME) -> tuple[str, ...]:
    """The whole names of a class or id that are frame words and parts of frames alone."""
    found = []
    for name in value.split():
        words = [w for w in re.split(r"[_-]+", re.sub(r"([a-z])(?=[A-Z])", r"\1-", name).lower()) if w]
        if words != ["social", "media"] and pattern.fullmatch("-".join(words)):
            found.append("-".join(words))
    return tuple(found)


def _framing(tag: str, attributes: str, in_article: bool) -> int | None:
    """``FRAME`` for a tag that begins a frame, ``DOUBT`` if only doubtful names inside an article say so."""
    if tag in _FRAME_TAGS or (tag == "header" and not in_article):
        return FRAME
    if not attributes.strip():
        return None
    kind = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, found = name.lower(), value.strip("\"'")
        value = found.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return FRAME
        if name == "role" and value in _FRAME_ROLES:
            return FRAME
        if (name == "class" or name == "id" and not (in_article and tag in _ID_IS_TOPIC)) and tag not in ("html", "body", "article", "main", "h1") and _frame_names(found):
            if not in_article or not all(map(_DOUBTFUL_NAME.fullmatch, _frame_names(found))):
                return FRAME
            kind = DOUBT
        if not in_article and name in ("class", "id") and tag == "div" and re.search(r"(?:^|[\s_-])header(?=$|[\s_-])", value):
            return FRAME
        if tag == "article" and name in ("class", "id") and _frame_names(found, _ANSWER_NAME):
            return FRAME
    return kind


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks with text, in page order.

    Character references are decoded, white space inside a block becomes one space. If no ``article`` has text outside
    frames, ``main`` counts, and if neither has, a container inside a menu or header, which was then left open; without
    any, no block is content. A form around a container is no frame. ``DOUBT`` are blocks of the container under a
    doubtful name, and those of ``main`` beside an article. Text of ``noscript`` and ``iframe`` is left out, as
    are annotations of formulas; formulas and what ``object`` holds stay.
    """
    if not page:
        return []
    blocks, lost = _blocks(page, _WRAPS)
    if lost and not any(kind == CONTENT for kind, _ in blocks):
        blocks, _ = _blocks(page, _WRAPS | _LEFT_OPEN)
    return blocks


def _blocks(page: str, around: frozenset[str]) -> tuple[list[tuple[int, str]], bool]:
    """The blocks, where tags ``around`` a container are no frame; whether a container lies in a frame."""
    lost = False
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, int, bool]] = []  # tag, frame, container: 1 for main, 2 for article, doubt
    pieces: list[str] = []
    frames = mains = articles = doubts = 0
    at, end = 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                inner = (DOUBT, MAIN_DOUBT) if doubts else (CONTENT, MAIN)
                out.append((FRAME if frames else inner[0] if articles else inner[1] if mains else OPEN, text))
            pieces.clear()

    def pop() -> None:
        nonlocal frames, mains, articles, doubts
        _, frame, container, doubt = stack.pop()
        frames -= frame
        doubts -= doubt
        mains -= container == 1
        articles -= container == 2

    while at < end:
        found = _PIECE.search(page, at)
        if found is None:
            pieces.append(page[at:])
            break
        if found.start() > at:
            pieces.append(page[at : found.start()])
        at = found.end()
        closing, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        single = found[3].rstrip().endswith("/")
        if tag in _RAW and not closing:
            stop = None if single else _RAW_ENDS[tag].search(page, at)
            if stop:
                at = stop.start() if stop[0].lower().startswith("<body") else stop.end()
            elif not single and tag in ("script", "style", "textarea"):
                at = end
            continue
        if tag in _BLOCKS:
            flush()
        if tag == "br":
            pieces.append(" ")
        if tag in _VOID:
            continue
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                while len(stack) > depth:
                    pop()
            continue
        if single:
            continue
        ends = _CLOSES.get(tag, {"p"} if tag in _BLOCKS else set())
        # an element left open, inline ones inside it too, ends where a block of its kind starts
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ends:
                while len(stack) > k:
                    pop()
                break
            if stack[k][0] in _BLOCKS and stack[k][0] != "p":
                break
        inside = mains + articles > 0
        framing = _framing(tag, found[3], inside)
        frame, doubt = framing == FRAME, framing == DOUBT
        container = 2 if tag == "article" else int(tag == "main" or bool(re.search(r"role\s*=\s*[\"']?main\b", found[3])))
        if framing is not None:
            flush()
        elif container and frames and not inside:
            stack = [(t, f and t not in around, c, d) for t, f, c, d in stack]
            frames = sum(f for _, f, _, _ in stack)
            lost = lost or frames > 0
        stack.append((tag, frame, container, doubt))
        frames += frame
        doubts += doubt
        mains += container == 1
        articles += container == 2
    flush()
    beside = any(kind == CONTENT for kind, _ in out)
    settled = {MAIN: DOUBT, MAIN_DOUBT: FRAME} if beside else {MAIN: CONTENT, MAIN_DOUBT: DOUBT}
    return [(settled.get(kind, kind), text) for kind, text in out], lost


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def main_text(blocks: list[tuple[int, str]]) -> str:
    return "\n".join(text for kind, text in blocks if kind == CONTENT)


def _outside(source: str | None) -> tuple[str, list[tuple[int, int, str]]]:
    """The article's text, and the other blocks: kind, blocks of the article before it, text.

    With an article, open blocks lie outside and are frame. Doubtful blocks wait for what other pages repeat, as open ones do.
    """
    blocks = blocks_of(source)
    settled, before, others = any(kind == CONTENT for kind, _ in blocks), 0, []
    for kind, text in blocks:
        if kind == CONTENT:
            before += 1
        else:
            others.append((FRAME if settled and kind == OPEN else kind, before, text))
    return main_text(blocks), others


def _streams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Host and blocks outside the article of every page that has some."""
    for frame in frames:
        rows = [(host_of(u), k, [t for _, _, t in _outside(h)[1]]) for u, k, h in zip(frame["url"], frame["key"], frame["html"])]
        yield pd.DataFrame([r for r in rows if r[2]], columns=["host", "key", "others"])


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The article's text; the other blocks come along where some of them may belong to it."""
    for frame in frames:
        rows = []
        for page, url, key, source in zip(frame["page_id"].astype("Int64"), frame["url"], frame["key"], frame["html"]):
            text, others = _outside(source)
            others = others if any(kind in (OPEN, DOUBT) for kind, _, _ in others) else []
            rows.append((page, url, key, text, [k for k, _, _ in others], [n for _, n, _ in others], [t for _, _, t in others]))
        yield pd.DataFrame(rows, columns=["page_id", "url", "key", "text", "kinds", "places", "others"])


def _tokens(text: str) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) & 0xFFFFFFFF for w in text.split()]


def _suffixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per distinct suffix of a batch and host: its tokens, the smallest and the largest page key."""
    for frame in frames:
        found: dict[tuple[str, bytes, int], list[int]] = {}
        for host, key, others in zip(frame["host"], frame["key"], frame["others"]):
            streams = [_tokens(t) for t in others]
            stream, starts = [t for s in streams for t in s], np.cumsum([0, *map(len, streams)]).tolist()
            for start, own in zip(starts, streams):
                tokens = np.array(stream[start : start + DEPTH], dtype=">u4").tobytes()
                keys = found.setdefault((host, tokens, min(len(own), DEPTH)), [key, key])
                keys[0], keys[1] = min(keys[0], key), max(keys[1], key)
        rows = [(h, xxhash.xxh3_64_intdigest(t[:4]) >> 1, t, own, low, high) for (h, t, own), (low, high) in found.items()]
        yield pd.DataFrame(rows, columns=["host", "shard", "tokens", "own", "low", "high"])


def _common(a: bytes, b: bytes) -> int:
    """Tokens that two suffixes share at the front."""
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return (n - (differing.bit_length() + 7) // 8) // 4


def _repeated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffixes whose run is on another page too, and how many tokens it has.

    In suffix order, the longest run that a suffix shares with another page is with its nearest neighbour
    before or after it that is not on the same single page.
    """
    for frame, bounds in _groups(frames, ["host", "shard"]):
        hosts, rows = frame["host"].tolist(), list(zip(frame["tokens"], frame["own"], frame["low"], frame["high"]))
        out = []
        for a, b in zip(bounds, bounds[1:]):
            array = rows[a:b]
            merged: list[list] = []  # equal suffixes of several batches
            for tokens, _, low, high in array:
                if merged and merged[-1][0] == tokens:
                    merged[-1][1], merged[-1][2] = min(merged[-1][1], low), max(merged[-1][2], high)
                else:
                    merged.append([tokens, low, high])
            best = [len(t) // 4 if low != high else 0 for t, low, high in merged]
            for order in (range(len(merged)), range(len(merged) - 1, -1, -1)):
                before, other = None, 0  # other: shared with the last suffix of another page than the one before
                for k in order:
                    tokens, low, high = merged[k]
                    if before is not None:
                        step = _common(before[0], tokens)
                        differs = before[1] != before[2] or low != high or before[1] != low
                        other = step if differs else min(other, step)
                        best[k] = max(best[k], other)
                    before = merged[k]
            runs = {tokens: run for (tokens, _, _), run in zip(merged, best)}
            for tokens, own, _, _ in {(r[0], r[1], 0, 0) for r in array}:
                if runs[tokens] >= min(own, MIN_RUN):
                    out.append((hosts[a], tokens, own, runs[tokens]))
        yield pd.DataFrame(out, columns=["host", "tokens", "own", "run"])


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for host, key, others in zip(frame["host"], frame["key"], frame["others"]):
            streams = [_tokens(t) for t in others]
            stream, starts = [t for s in streams for t in s], np.cumsum([0, *map(len, streams)]).tolist()
            for start, own in zip(starts, streams):
                rows.append((host, np.array(stream[start : start + DEPTH], dtype=">u4").tobytes(), min(len(own), DEPTH), key, start))
        yield pd.DataFrame(rows, columns=["host", "tokens", "own", "key", "start"])


def _grams(host: str, tokens: list[int]) -> np.ndarray:
    """A hash of the host and the DEPTH tokens from every place on that has as many."""
    n = max(len(tokens) - DEPTH + 1, 0)
    mixed = np.array(tokens, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    out = np.full(n, xxhash.xxh3_64_intdigest(host), dtype=np.uint64)
    for k in range(DEPTH):
        out = out * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def _long(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every place of a page with DEPTH tokens from there on."""
    for frame in frames:
        grams = [_grams(host, [t for text in others for t in _tokens(text)]) for host, others in zip(frame["host"], frame["others"])]
        sizes = [len(g) for g in grams]
        if sum(sizes):
            starts = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            yield pd.DataFrame({"gram": np.concatenate(grams), "key": np.repeat(frame["key"].to_numpy(), sizes), "start": starts})


def _left(words: list[str], covered: np.ndarray, long: np.ndarray) -> str:
    """What stays of an open block: all but its long runs, and but its short ones if little else is there."""
    gone = covered if covered.sum() >= COVERED * len(words) else long
    return " ".join(w for w, g in zip(words, gone.tolist()) if not g)


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts, repeated = [], []
        for text, kinds, places, others, found in zip(frame["text"], frame["kinds"], frame["places"], frame["others"], frame["runs"]):
            runs = [] if found is None else list(found)
            blocks = [block.split() for block in others]
            size = max(sum(map(len, blocks)), max((r["start"] + r["run"] for r in runs), default=0))
            covered, long = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
            for r in runs:
                covered[r["start"] : r["start"] + r["run"]] = True
                if r["run"] >= DEPTH:
                    long[r["start"] : r["start"] + r["run"]] = True
            repeated.append(int(covered.sum()))
            article = text.split("\n") if text else []  # no block holds a line end
            at, placed, whole = 0, 0, []
            for kind, place, words in zip(kinds, places, blocks):
                part = slice(at, at + len(words))
                if kind == DOUBT:  # goes as a whole or not at all
                    left = "" if covered[part].all() else " ".join(words)
                else:
                    left = _left(words, covered[part], long[part]) if kind == OPEN else ""
                if left:
                    whole += [*article[placed:place], left]
                    placed = place
                at += len(words)
            texts.append("\n".join(whole + article[placed:]))
        yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts], "n_repeated": repeated})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated of every row of ``pages`` (page_id, url, html).

    ``text``: the blocks of the article in page order, joined by \\n, empty if there is none; blocks inside an
    article container stay even if they are on other pages too. Without a container, the open blocks less
    what other pages of the host repeat; a block that keeps some of its words is one line. Blocks of which structure is in
    doubt (see ``blocks_of``) stay in their place unless other pages repeat all of them. ``n_repeated``: tokens outside the article
    that other pages of the host repeat. Pages with equal url and html are one page where repetition is
    counted. A null html is empty, a null or broken url is of the host ''. Other columns are not read; an
    empty table gives no row.
    """
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    rows = rows.withColumn("key", F.xxhash64("url", "html"))
    # read and parsed twice, so that texts are never written between
    streams = materialise(rows.mapInPandas(_streams, "host string, key long, others array<string>"), "streams")
    suffixes = streams.mapInPandas(_suffixes, "host string, shard long, tokens binary, own int, low long, high long")
    sharded = suffixes.repartition(partitions(pages), "host", "shard").sortWithinPartitions("host", "shard", "tokens")
    repeated = materialise(sharded.mapInPandas(_repeated, "host string, tokens binary, own int, run int"), "repeated")
    starts = streams.mapInPandas(_starts, "host string, tokens binary, own int, key long, start int")
    places = streams.mapInPandas(_long, "gram long, key long, start int")
    elsewhere = places.groupBy("gram").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("gram")
    covered = starts.join(repeated, ["host", "tokens", "own"]).select("key", "start", "run")
    covered = covered.union(places.join(elsewhere, "gram").select("key", "start", F.lit(DEPTH).alias("run"))).distinct()
    runs = covered.groupBy("key").agg(F.collect_list(F.struct("start", "run")).alias("runs"))
    parsed = rows.mapInPandas(_parse, "page_id long, url string, key long, text string, kinds array<int>, places array<int>, others array<string>")
    return parsed.join(runs, "key", "left").mapInPandas(_finish, "page_id long, url string, text string, n_chars long, n_repeated long")
