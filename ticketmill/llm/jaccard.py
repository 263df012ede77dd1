"""Similarity join of texts on word n-grams, with Jaccard similarity num / den or more.

A text's set: the hashes of its distinct runs of ``width`` words (A-Z lower-cased; with
fewer words the whole sequence). Texts with equal sets are one class, and only classes
are joined.

1. Tiles. Sizes are cut into bands. In a band two sets that link differ in at most k
   elements, so when the elements are dealt to more than k buckets by their hash, some
   bucket is equal in both. Classes that share (band, bucket, content) form a tile;
   a set near the upper end of a band also joins the tiles of the next one. No tile
   holds classes that merely share a frequent passage.
2. Bitmaps. Inside a tile, ordered by size, the bit count of two parity bitmaps' exclusive
   or is a lower bound of the difference, which bounds the overlap from above. Large
   tiles are cut into blocks, and each pair of blocks is a task's work of bounded size.
3. Pairs that pass are verified by intersecting the sorted arrays of hashes.

For components, pairs inside one component need no test: a round tests, for each class,
a few partners; later rounds take the next partners, of other components only, until none
is left. So a group of any size gives rows in proportion to its members. ``links`` tests
every pair instead.

Defined cases: null is an empty text; a text without words has no set and links with
nothing; rows with equal keys are rows like any others; null keys are allowed; no
rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, join_hot, stored, text_of
from .components import roots
from .words import ASCII_SPACES, LETTER, PLAIN, REST, SPACE, slices, split

CUTS = ((LETTER, SPACE), (PLAIN, SPACE), (REST, SPACE))
BAND_RATIO = 1.4
BLOCK = 1024  # classes in a block of a large tile
PARTNERS = 1  # partners tested in the first round; each later round takes eight times as many
PORTION = 1000  # texts worked on at once
SHIPPED_KEYS = 1 << 20  # ids are sent to all tasks up to this number, else joined

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _portions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: what is made of a text is a multiple of its size."""
    for batch in batches:
        for at in range(0, batch.num_rows, PORTION):
            yield batch.slice(at, PORTION)
        pa.default_memory_pool().release_unused()


class Rule(NamedTuple):
    """Sets link when den * |intersection| >= num * |union|."""

    width: int = 5
    num: int = 80
    den: int = 100

    def needed(self, total: np.ndarray | int) -> np.ndarray | int:
        """The overlap two sets of ``total`` elements together must have."""
        return -(-self.num * total // (self.den + self.num))

    def bands(self) -> np.ndarray:
        """The least size of each band."""
        ratio = max(BAND_RATIO, self.den / self.num + 0.1)
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, int(np.ceil(lows[-1] * ratio))))
        return np.array(lows)

    def difference(self, largest: int) -> int:
        """The most elements two linked sets of at most ``largest`` elements differ in."""
        return 2 * largest * (self.den - self.num) // (self.den + self.num)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return x ^ (x >> np.uint64(31))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted element hashes of each text."""
    for some in slices(texts):
        chunks = split(pc.ascii_lower(some), ASCII_SPACES, CUTS)
        words = [c.strip(ASCII_SPACES) for c in chunks.values.cast(pa.binary()).to_pylist()]
        hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        is_word = np.array([bool(w) for w in words], bool)[chunks.codes]
        ends = np.concatenate([[0], np.cumsum(is_word)])[chunks.bounds]
        h = hashed[chunks.codes][is_word]
        runs = h[: max(0, len(h) - width + 1)].copy()
        for i in range(1, width):
            runs = runs * _C[0] + h[i : len(runs) + i]
        runs = mix(runs)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a >= width:
                yield _distinct(runs[a : b - width + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for x in h[a:b]:
                    whole = whole * _C[0] + x
                yield mix(whole ^ _C[3])
            else:
                yield np.zeros(0, np.uint64)


def key_of(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def bitmap(elements: np.ndarray) -> bytes:
    """Parity of the elements at each of 1 to 2 bits per element."""
    bits = max(64, 1 << (len(elements) - 1).bit_length())
    places = (mix(elements ^ _C[4]) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def signatures(elements: np.ndarray, rule: Rule, lows: np.ndarray) -> np.ndarray:
    """The tiles of a set, as 64-bit numbers."""
    own = int(np.searchsorted(lows, len(elements), "right")) - 1
    bands = [own] + [own + 1] * bool(len(elements) * rule.den // rule.num >= lows[own + 1])
    found = []
    spread = mix(elements ^ _C[3])
    for band in bands:
        most = rule.difference(int(lows[band + 1]) - 1)
        if most == 0:
            continue  # only equal sets link
        buckets = most + 1
        buckets += max(3, buckets // 10)  # some stay empty
        bucket = ((elements >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        salt = np.array([band + 1], np.uint64) * _C[2]
        filled = bucket[starts]
        found.append(mix(np.add.reduceat(spread, starts) + mix(filled * _C[0] + salt)))
        if len(starts) <= most:  # equal buckets might all be empty ones
            empty = np.setdiff1d(np.arange(buckets, dtype=np.uint64), filled)
            found.append(mix(mix(empty * _C[0] + salt) ^ _C[4]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


# --- the steps ----------------------------------------------------------------


def _described(df: DataFrame, rule: Rule) -> DataFrame:
    """_id, n, key, short (of the key), bitmap of each row of (_id, _text)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            found = list(sets(batch.column("_text"), rule.width))
            keys = [key_of(f) if len(f) else None for f in found]
            columns = [
                batch.column("_id"),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([None if k is None else _short(k) for k in keys], pa.int64()),
                pa.array([bitmap(f) if len(f) else None for f in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n", "key", "short", "bitmap"])

    kind = df.schema["_id"].dataType.simpleString()
    return df.mapInArrow(describe, f"_id {kind}, n long, key binary, short long, bitmap binary")


def _short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _signed(df: DataFrame, rule: Rule, hot: dict[bytes, object]) -> DataFrame:
    """sig, short: the tiles of each row's set. A hot class is entered by its first row only."""
    lows = rule.bands()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            sigs, shorts, met = [], [], set()
            ids = batch.column("_id")
            for i, elements in enumerate(sets(batch.column("_text"), rule.width)):
                key = key_of(elements) if len(elements) else None
                if key is None or key in met or (key in hot and hot[key] != ids[i].as_py()):
                    continue
                met.add(key)
                found = signatures(elements, rule, lows)
                sigs.append(found.view(np.int64))
                shorts.append(np.full(len(found), _short(key), np.int64))
            columns = [np.concatenate(x or [np.zeros(0, np.int64)]) for x in (sigs, shorts)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sig", "short"])

    return df.mapInArrow(sign, "sig long, short long")


def _runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[list, np.ndarray]]:
    """Whole runs of rows equal in the first ``keys`` columns: columns, and where runs start (and end)."""
    held: list | None = None
    for batch in batches:
        columns = [pa.concat_arrays([h, c]) for h, c in zip(held, batch.columns, strict=True)] if held else batch.columns
        if not len(columns[0]):
            continue
        change = np.zeros(len(columns[0]), bool)
        change[0] = True
        for c in columns[:keys]:
            x = c.to_numpy()
            change[1:] |= x[1:] != x[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield [c.slice(0, starts[-1]) for c in columns], starts
        held = [c.slice(starts[-1]) for c in columns]
    if held and len(held[0]):
        yield held, np.array([0, len(held[0])])


def _tiles(signed: DataFrame) -> DataFrame:
    """tile, short: the members of each signature that two classes or more share; equal tiles once."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for (sig, short), _ in _runs(batches, 1):
            sig, short = sig.to_numpy(), short.to_numpy()
            new = np.r_[True, (sig[1:] != sig[:-1]) | (short[1:] != short[:-1])]
            sig, short = sig[new], short[new]
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            sizes = np.diff(np.r_[starts, len(sig)])
            total = np.add.reduceat(mix(short.view(np.uint64)), starts)
            tile = mix(total + sizes.astype(np.uint64) * _C[0])
            first = np.zeros(len(tile), bool)
            first[np.unique(tile, return_index=True)[1]] = True
            first &= sizes > 1
            first[first] = [t not in seen for t in tile[first].tolist()]
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(tile[first].tolist())
            kept = np.repeat(first, sizes)
            out = [np.repeat(tile.view(np.int64), sizes)[kept], short[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(o) for o in out], names=["tile", "short"])

    # The exchange is by the signature alone; rows of one are sorted, never held whole in memory.
    dealt = signed.repartition("sig").sortWithinPartitions("sig", "short")
    return dealt.mapInArrow(gather, "tile long, short long").distinct()


def _passing(n: np.ndarray, bitmaps: list[bytes], block: np.ndarray, crossing: bool, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """For each member, ordered by size: the later members whose bitmap allows a link."""
    least = min(map(len, bitmaps))
    rows = np.zeros((len(bitmaps), least // 8), np.uint64)
    for i, b in enumerate(bitmaps):
        words = np.frombuffer(b, np.uint64)
        while len(words) > least // 8:  # parity bitmaps fold
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        rows[i] = words
    last = np.searchsorted(n, n * rule.den // rule.num, "right")
    for i in range(len(n) - 1):
        after = slice(i + 1, last[i])
        if after.stop <= after.start:
            continue
        differ = np.bitwise_count(rows[after] ^ rows[i]).sum(axis=1, dtype=np.int64)
        total = n[i] + n[after]
        fits = (total - differ) // 2 >= rule.needed(total)
        if crossing:
            fits &= block[after] != block[i]
        found = np.flatnonzero(fits)
        if len(found):
            yield i, found + i + 1


def _ranked(size: int, passing: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All passing pairs, and for each its lower place among the partners of either side."""
    a = np.concatenate([np.full(len(p), i) for i, p in passing])
    b = np.concatenate([p for _, p in passing])

    def place(side: np.ndarray, other: np.ndarray) -> np.ndarray:
        order = np.lexsort((other, side))
        found = np.empty(len(side), np.int64)
        begins = np.searchsorted(side[order], np.arange(size))
        found[order] = np.arange(len(side)) - begins[side[order]]
        return found

    node, partner = np.concatenate([a, b]), np.concatenate([b, a])
    ranks = place(node, partner)
    return a, b, np.minimum(ranks[: len(a)], ranks[len(a) :])


def _candidates(members: DataFrame, classes: DataFrame, rule: Rule, first: int, last: int) -> DataFrame:
    """a, b, tile: pairs whose place is from ``first`` up to ``last``; a null pair where a tile has later ones.

    ``members``: tile, key, label; bitmaps are joined to them for the one exchange that
    needs them. Pairs with equal labels are left out.
    """
    large = members.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks")).filter("blocks > 1")
    block = F.pmod(F.xxhash64("key"), "blocks").cast("int")
    # A block meets each block once: the cell of two blocks holds both.
    cells = (
        members.join(large, "tile", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "label", "block")
        .join(classes.select("key", "n", "bitmap"), "key")
        .select("tile", "i", "j", "n", "key", "bitmap", "label", "block")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, starts in _runs(batches, 3):
            out: list[tuple] = []
            tile, i, j, n, key, bits, label, block = columns
            numbers = [c.to_numpy() for c in (tile, i, j, n, block)]
            keys, labels = key.to_pylist(), label.to_pylist()
            bits = bits.to_pylist()
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(tile)], strict=True):
                if e - s < 2:
                    continue
                crossing = numbers[1][s] != numbers[2][s]
                passing = list(_passing(numbers[3][s:e], bits[s:e], numbers[4][s:e], crossing, rule))
                if not passing:
                    continue
                a, b, place = _ranked(e - s, passing)
                apart = np.array([labels[s + x] != labels[s + y] for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                now = apart & (place >= first) & (place < last)
                out += [(keys[s + x], keys[s + y], None) for x, y in zip(a[now].tolist(), b[now].tolist(), strict=True)]
                if (apart & (place >= last)).any():
                    out.append((None, None, int(numbers[0][s])))
            kinds = (pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], k) for c, k in enumerate(kinds)], names=["a", "b", "tile"])

    dealt = cells.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "n", "key")
    found = dealt.mapInArrow(compare, "a binary, b binary, tile long")
    # A pair may meet in tiles of both orders, and in many of them.
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "tile").distinct()


def _verified(pairs: DataFrame, df: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """a, b: the pairs whose sets do link. ``pairs`` is stored."""
    nodes = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = stored(nodes.join(classes.select("key", F.col("first_id").alias("_id")), "key").select("_id").distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= SHIPPED_KEYS else wanted
    rows = df.alias("d").join(wanted.alias("w"), F.col("d._id").eqNullSafe(F.col("w._id")), "left_semi")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            found = [f for f in sets(batch.column("_text"), rule.width) if len(f)]
            columns = [pa.array([key_of(f) for f in found], pa.binary()), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "elements"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                kept.append(int((both[1:] == both[:-1]).sum()) >= rule.needed(len(x) + len(y)))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    elements = rows.mapInArrow(arrays, "key binary, elements binary")
    one = elements.select(F.col("key").alias("b"), F.col("elements").alias("y"))
    two = elements.select(F.col("key").alias("a"), F.col("elements").alias("x"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "x", "y").mapInArrow(check, "a binary, b binary").distinct()


class Prepared(NamedTuple):
    rows: DataFrame  # _id, _text
    described: DataFrame  # _id, n, key
    classes: DataFrame  # key, short, size, first_id, n, bitmap
    members: DataFrame  # tile, key
    total: int


def _prepare(df: DataFrame, key: str, text: str, rule: Rule) -> Prepared:
    rows = df.select(F.col(key).alias("_id"), text_of(text).alias("_text"))
    described = stored(_described(rows, rule), "sets")
    total = described.count()
    classes = (
        described.filter("key IS NOT NULL")
        .groupBy("key", "short")
        .agg(F.count("*").alias("size"), F.min("_id").alias("first_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"))
    )
    classes = stored(classes, "classes")
    # At most 1 / HOT_SHARE classes, however many rows there are.
    hot = {bytes(r.key): r.first_id for r in classes.filter(F.col("size") > total * HOT_SHARE).select("key", "first_id").collect()}
    tiles = stored(_tiles(_signed(rows, rule, hot)), "tiles")
    members = tiles.join(classes.select("short", "key"), "short").drop("short")
    return Prepared(rows, described.drop("bitmap", "short"), classes, stored(members, "members"), total)


def links(df: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """Every link: (first_a, first_b) of two classes, and (key, first) of each row with a set."""
    p = _prepare(df, key, text, rule)
    pairs = _candidates(p.members.withColumn("label", F.col("key")), p.classes, rule, 0, 1 << 60)
    found = _verified(stored(pairs.select("a", "b"), "pairs"), p.rows, p.classes, rule)
    first = p.classes.select("key", "first_id")
    found = found.join(first.toDF("a", "first_a"), "a").join(first.toDF("b", "first_b"), "b").select("first_a", "first_b")
    member = join_hot(p.described.filter("key IS NOT NULL"), p.classes.select("key", "first_id", "size"), "key", "size", p.total)
    return found, member.select(F.col("_id").alias(key), F.col("first_id").alias("first"))


def components(df: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """key, n_shingles, component_id (least key reachable by links) of each row."""
    p = _prepare(df, key, text, rule)
    members, found, least, last = p.members.withColumn("label", F.col("key")), None, 0, PARTNERS
    label = None
    while True:
        pairs = stored(_candidates(members, p.classes, rule, least, last), "pairs")
        new = _verified(pairs.filter("a IS NOT NULL").select("a", "b"), p.rows, p.classes, rule)
        found = stored(new if found is None else found.unionByName(new), "links")
        label = roots(found).toDF("key", "label")
        waiting = pairs.filter("tile IS NOT NULL").select("tile").distinct()
        members = p.members.join(waiting, "tile", "left_semi").join(label, "key", "left")
        members = members.withColumn("label", F.coalesce("label", "key"))
        mixed = members.groupBy("tile").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("tile")
        members = stored(members.join(mixed, "tile", "left_semi"), "members")
        if members.isEmpty():
            break
        least, last = last, last * 8
    linked = p.classes.select("key", "size", "first_id").join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
    whole = linked.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count("*").alias("_classes"))
    named = linked.join(whole, "label").filter("size > 1 OR _classes > 1").select("key", "size", "component_id")
    rows = join_hot(p.described, stored(named, "named"), "key", "size", p.total, "left")
    own = F.when(F.col("component_id").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return rows.select(F.col("_id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))
