"""Personal data in texts: exact base patterns, and spans a character tagger adds.

Base spans follow fixed patterns, leftmost and without overlap per kind; a match that
fails its check is dropped and not tried again. The tagger reads windows of WINDOW
characters every half window over the whole text. Every span that can pass has an "@", or
lies in a stretch of digits and the marks between them that has enough digits for a kind,
so only windows with such an anchor and those beside them are read. Windows that follow
each other are a run: the label scores of its windows are averaged, the more the nearer a
position is to the middle, and the best labels are those of the whole run; a run of more
than RUN_WINDOWS is decoded in parts that overlap by OVERLAP windows, each half of which
counts for its own side, so a text of any length is held in bounded memory. A tagged address is taken
to the ends of its local part and of its host, however long they are. A tagged span is
added when it passes the check of its kind and overlaps no other span; base spans always
stay.

Defined cases: a null text is an empty one and has no spans; positions are code points;
a very long text is read whole; repeated rows are treated alike; an empty table gives no
rows; any other columns pass unchanged, one named ``spans`` is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .tagger import KINDS, WINDOW, Weights, best_labels, char_codes, luhn, trained, window_scores

STRIDE = WINDOW // 2
ANCHOR = re.compile("[0-9@]")
SLICE_WINDOWS = 4096  # windows read at once
RUN_WINDOWS, OVERLAP = 1024, 16
# Stretches of digits and marks; a passing span without "@" has at least so many digits, or so many dots between some.
_STRETCH = re.compile(r"[0-9][0-9\s().+/_-]*")
LEAST_DIGITS, LEAST_DOTS = 9, 3

# The base patterns. Local part and host of an address are looked for
# from its "@", and dotted numbers from their first digit, which gives the same
# matches in linear time.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(map(_byte, four)):
                yield at, at + length
            at += length + 1


def _is_card(text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= sum(c in "0123456789" for c in text) <= 15


def base_spans(text: str) -> list[Span]:
    """By kind, then by start."""
    if not ANCHOR.search(text):
        return []
    found = [Span("email", a, b, True) for a, b in _emails(text)]
    found += [Span("ip", a, b, True) for a, b in _addresses(text)]
    found += [Span("card", *m.span(), True) for m in _CARD.finditer(text) if _is_card(m.group())]
    return found + [Span("phone", *m.span(), True) for m in _PHONE.finditer(text) if _is_phone(m.group())]


def _passes(kind: str, text: str) -> bool:
    """Whether a tagged text is of its kind, written in whatever way."""
    if kind == "email":
        return re.fullmatch(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text) is not None
    parts = re.findall("[0-9]+", text)
    if kind == "ip":
        return len(parts) == 4 and all(map(_byte, parts)) and re.fullmatch(r"[0-9]+(\s?\.\s?[0-9]+){3}", text) is not None
    if kind == "card":
        return _is_card(text) and re.fullmatch(r"[0-9]([\x20./_-]?[0-9])+", text) is not None
    return _is_phone(text) and len(parts) > 2 and re.fullmatch(r"[+(]?[0-9][\x20().0-9-]+[0-9]", text) is not None


def _anchors(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text that hold all its spans' digits and "@"."""
    at = text.find("@")
    while at >= 0:
        yield at, at + 1
        at = text.find("@", at + 1)
    for m in _STRETCH.finditer(text):
        part = m.group()
        if len(part) >= LEAST_DIGITS and len(re.sub("[^0-9]", "", part)) >= LEAST_DIGITS or part.count(".") >= LEAST_DOTS:
            yield m.span()


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """First and last window, as numbers of half windows, of the runs to read: those with an anchor and the ones beside them."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    clipped = lambda block: min(max(block, 0), last)
    near = sorted((clipped(a // STRIDE - 2), clipped((b - 1) // STRIDE + 1)) for a, b in _anchors(text))
    begin = end = None
    for a, b in near:
        if end is not None and a <= end + 1:
            end = max(end, b)
            continue
        if end is not None:
            yield begin, end
        begin, end = a, b
    if end is not None:
        yield begin, end


class _Part(NamedTuple):
    """Windows of a run that are decoded together, and from where to where their labels count."""

    text: int
    first: int
    last: int
    begin: int
    end: int


def _parts(texts: list[str]) -> Iterator[_Part]:
    for i, text in enumerate(texts):
        for first, last in _runs(text):
            at, begin = first, STRIDE * first
            while last - at >= RUN_WINDOWS:
                stop = at + RUN_WINDOWS
                middle = STRIDE * (stop - OVERLAP // 2)
                yield _Part(i, at, stop - 1, begin, middle)
                at, begin = stop - OVERLAP, middle
            yield _Part(i, at, last, begin, len(text))


# How much each position of a window counts.
_NEARNESS = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def _joined(length: int, starts: list[int], scores: np.ndarray) -> np.ndarray:
    """Mean of the windows' values at each position, by nearness to a window's middle; 0 where none was read."""
    each = (-1, *[1] * (scores.ndim - 2))
    whole, total = np.zeros((length, *scores.shape[2:]), np.float32), np.zeros(length, np.float32)
    for start, found in zip(starts, scores, strict=True):
        n = min(WINDOW, length - start)
        whole[start : start + n] += found[:n] * _NEARNESS[:n].reshape(each)
        total[start : start + n] += _NEARNESS[:n]
    return whole / np.maximum(total, 1).reshape(each)


def _tagged(whole: np.ndarray) -> Iterator[tuple[str, int, int]]:
    kind = (whole + 1) // 2
    at = np.flatnonzero(whole)
    if not len(at):
        return
    opens = (whole[at] % 2 == 1) | np.r_[True, (np.diff(at) > 1) | (np.diff(kind[at]) != 0)]
    starts = at[opens]
    ends = np.r_[at[np.flatnonzero(opens)[1:] - 1], at[-1]] + 1
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        yield KINDS[kind[a] - 1], a, b


def _whole(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """A tagged address to the ends of its local part and host; other spans as they are."""
    at = text.find("@", a, b) if kind == "email" else -1
    if at < 0:
        return a, b
    end = at - (text[at - 1 : at].isspace())
    start = end
    while start > 0 and text[start - 1] in _LOCAL_CHARS:
        start -= 1
    host = _HOST.match(text, at + 1 + text[at + 1 : at + 2].isspace())
    return (start, host.end()) if start < end and host else (a, b)


def with_tagged(text: str, base: list[Span], tagged: Iterator[tuple[str, int, int]]) -> list[Span]:
    """Base spans and the tagged ones that pass and touch no other, by kind and start."""
    found = list(base)
    # What is taken, as stretches apart from each other in order.
    begins: list[int] = []
    ends: list[int] = []
    for s in sorted(base, key=lambda s: s.start):
        if ends and s.start < ends[-1]:
            ends[-1] = max(ends[-1], s.end)
        else:
            begins.append(s.start)
            ends.append(s.end)
    for kind, a, b in tagged:
        part = text[a:b]
        a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
        a, b = _whole(kind, text, a, b)
        after = bisect_right(ends, a)  # the first stretch that ends beyond a
        if a < b and (after == len(begins) or begins[after] >= b) and _passes(kind, text[a:b]):
            found.append(Span(kind, a, b, False))
            begins.insert(after, a)
            ends.insert(after, b)
    return sorted(found, key=lambda s: (KINDS.index(s.kind), s.start))


def _labelled(texts: list[str], parts: list[_Part], weights: Weights) -> Iterator[tuple[int, str, int, int]]:
    """Tagged spans (text, kind, start, end) of parts whose windows are read together."""
    windows = np.zeros((sum(p.last - p.first + 1 for p in parts), WINDOW), np.uint8)
    row = 0
    for p in parts:
        for start in range(STRIDE * p.first, STRIDE * p.last + 1, STRIDE):
            codes = char_codes(texts[p.text][start : start + WINDOW])
            windows[row, : len(codes)] = codes
            row += 1
    scores, row = window_scores(weights, windows), 0
    joined: list[np.ndarray] = []
    for p in parts:
        count = p.last - p.first + 1
        length = min(len(texts[p.text]) - STRIDE * p.first, STRIDE * (count - 1) + WINDOW)
        joined.append(_joined(length, [STRIDE * i for i in range(count)], scores[row : row + count]))
        row += count
    for p, labels in zip(parts, best_labels(weights, joined), strict=True):
        offset = STRIDE * p.first
        # A span that begins in this part's share is whole here, as the overlap is longer than it.
        for kind, a, b in _tagged(labels):
            if p.begin <= offset + a < p.end:
                yield p.text, kind, offset + a, offset + b


def spans_of(texts: list[str], weights: Weights) -> list[list[Span]]:
    """The spans of each text; windows of many texts are read together, those of a long one in slices."""
    tagged: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    waiting: list[_Part] = []
    held = 0

    def read() -> None:
        for i, kind, a, b in _labelled(texts, waiting, weights):
            tagged[i].append((kind, a, b))
        waiting.clear()

    for part in _parts(texts):
        count = part.last - part.first + 1
        if held + count > SLICE_WINDOWS and waiting:
            read()
            held = 0
        waiting.append(part)
        held += count
    if waiting:
        read()
    return [with_tagged(text, base_spans(text), iter(found)) for text, found in zip(texts, tagged, strict=True)]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def spans(text: Column | str, weights: Weights) -> Column:
    """The spans of a text, by kind as listed in KINDS, then by start."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = spans_of(batch.to_pylist(), weights)
            yield pa.array([[s._asdict() for s in one] for one in found], kind)

    return find(text_of(text))


def find_personal(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its spans."""
    kept = [c for c in df.columns if c != "spans"]
    return df.select(*kept, spans(text, trained()).alias("spans"))


def mask(text: str, found: list[Span]) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the first, longest one."""
    out, at = [], 0
    for s in sorted(found, key=lambda s: (s.start, -s.end, KINDS.index(s.kind))):
        if s.start >= at:
            out += [text[at : s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def masked(text: Column | str, weights: Weights) -> Column:
    """A text without its personal data; null stays null."""

    @F.arrow_udf("string")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            found = spans_of([t or "" for t in texts], weights)
            yield pa.array([t if not s else mask(t, s) for t, s in zip(texts, found, strict=True)], pa.string())

    return replace(F.col(text) if isinstance(text, str) else text)
