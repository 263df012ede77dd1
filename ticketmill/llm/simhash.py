"""SimHash fingerprints, and all fingerprints within a Hamming radius, in DataFrame operations.

A text's terms are its runs of WIDTH words (at the end, shorter ones); each occurrence
of a term votes with the 64 bits of its hash, so a term weighs as often as it occurs.
A bit of the fingerprint is set when more than half of the votes are. Votes for bits
i and i + 32 are summed in one number.

For a radius r the 64 bits are cut into blocks; for each choice of all but r blocks
there is a table keyed by the bits of those blocks. Two fingerprints within r bits
agree in at least one choice, so they meet in a table; a pair counts in the first.

Defined cases: null is an empty text; a text without words has the fingerprint 0;
equal texts have equal fingerprints; null keys sort after all others; rows with equal
keys are ordered by their text; a single row follows itself; keys are whole numbers.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

WIDTH = 3
RADIUS = 3
BLOCKS = 5
RANGE_ROWS = 2000  # rows in one range of keys
MAX_RANGES = 1 << 16  # so many numbers reach the driver at most
SPACES = " \t\n\x0b\x0c\r"
_LANES = 1 | 1 << 32


def words(text: Column) -> Column:
    """Words of a text; null where it has none."""
    plain = F.btrim(text, F.lit(SPACES))
    return F.when(plain != "", F.split(plain, r"[\x20\x09-\x0D]+"))


def term_rows(df: DataFrame, text: str, *kept: str) -> DataFrame:
    """A row per occurrence of a term, with its hash; a text without words has one null hash."""
    split = df.select(*kept, words(F.col(text)).alias("_w"))
    shifted = [F.col("_w").alias("_0")]
    shifted += [F.slice("_w", i + 1, F.greatest(F.size("_w"), F.lit(0))).alias(f"_{i}") for i in range(1, WIDTH)]
    zipped = split.select(*kept, F.arrays_zip(*[F.when(F.col("_w").isNotNull(), c).alias(f"_{i}") for i, c in enumerate(shifted)]).alias("_z"))
    rows = zipped.select(*kept, F.inline_outer("_z"))
    return rows.select(*kept, F.when(F.col("_0").isNotNull(), F.xxhash64(*[f"_{i}" for i in range(WIDTH)])).alias("_term"))


def fingerprints(terms: DataFrame, *keys: str) -> DataFrame:
    """``fingerprint`` (a whole number of 64 bits) of each key, from ``term_rows``."""
    lanes = [F.sum(F.shiftrightunsigned("_term", i).bitwiseAND(F.lit(_LANES))).alias(f"_l{i}") for i in range(32)]
    votes = terms.groupBy(*keys).agg(*lanes, F.count("_term").alias("_n"))
    half = F.col("_n")
    bits = []
    for i in range(32):
        low, high = F.col(f"_l{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"_l{i}", 32)
        bits.append(F.when(low * 2 > half, F.lit(1 << i)).otherwise(F.lit(0)))
        top = 1 << (i + 32)
        bits.append(F.when(high * 2 > half, F.lit(top if i < 31 else top - (1 << 64))).otherwise(F.lit(0)))
    return votes.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _bounds(df: DataFrame, key: str) -> list[int]:
    """Keys that part ``df`` into ranges of about RANGE_ROWS rows."""
    ranges = min(MAX_RANGES, -(-df.count() // RANGE_ROWS))
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * ranges))).first()[0] or []
    return sorted(set(found))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below a key, looked for among blocks of bounds, then inside the block."""
    if not bounds:
        return F.lit(0)
    size = max(1, int(len(bounds) ** 0.5))
    heads = F.array(*[F.lit(b).cast("long") for b in bounds[size - 1 :: size]])
    block = F.size(F.filter(heads, lambda b: b < key))
    inside = F.slice(F.array(*[F.lit(b).cast("long") for b in bounds]), block * size + 1, F.lit(size))
    return block * size + F.size(F.filter(inside, lambda b: b < key))


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """_range, _at, key, _text, _next and _extra: each row with the text of the next one.

    Order: falling key, after the last row the first. Rows are parted into ranges
    of keys; each range also gets the first row of the range after it (_extra), so
    that no order over all rows is needed. Only that one row per range is copied.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    rows = df.select(F.col(key).alias(key), order.alias("_order"), text_of(text).alias("_text"))
    bounds = _bounds(rows, "_order")
    rows = rows.withColumn("_range", _range_of(F.col("_order"), bounds))
    first = sorted(rows.groupBy("_range").agg(F.max("_order")).collect())
    after = [(r, first[i - 1][1]) for i, (r, _) in enumerate(first)]
    target = df.sparkSession.createDataFrame(after, "_target int, _order long")
    extra = (
        rows.join(F.broadcast(target), "_order")
        .groupBy("_target")
        .agg(F.min(F.struct("_text", key)).alias("_row"))
        .select(F.col(f"_row.{key}").alias(key), F.lit(None).cast("long").alias("_order"), "_row._text", F.col("_target").alias("_range"), F.lit(True).alias("_extra"))
    )
    both = rows.withColumn("_extra", F.lit(False)).unionByName(extra)
    by_order = Window.partitionBy("_range").orderBy("_extra", F.desc("_order"), "_text")
    return both.select(
        "_range", F.row_number().over(by_order).alias("_at"), key, "_text", F.lead("_text").over(by_order).alias("_next"), "_extra"
    )


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, and as numbers: fingerprint, edited_fingerprint, next_fingerprint.

    The edited text has its last third replaced by the start of the next text.
    """
    rows = with_next(df, key, text)
    chars = F.char_length("_text")
    third = F.floor(chars / 3).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), chars - third), F.substring(F.col("_next"), F.lit(1), third))
    rows = rows.select("_range", "_at", key, "_extra", "_text", chars.cast("long").alias("n_chars"), F.when(~F.col("_extra"), edited).alias("_edited"))
    kept = ["_range", "_at", key, "_extra", "n_chars", "edited_sha256"]
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("_edited"), 256))
    texts = F.array(F.struct(F.lit(False).alias("_is_edited"), F.col("_text").alias("_t")), F.struct(F.lit(True).alias("_is_edited"), F.col("_edited").alias("_t")))
    both = rows.select(*kept, F.inline(texts)).filter("NOT (_extra AND _is_edited)")
    found = fingerprints(term_rows(both, "_t", *kept, "_is_edited"), *kept, "_is_edited")
    paired = found.groupBy(*kept).agg(
        F.max(F.when(~F.col("_is_edited"), F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_is_edited"), F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    following = F.lead("fingerprint").over(Window.partitionBy("_range").orderBy("_at"))
    out = paired.withColumn("next_fingerprint", following).filter("NOT _extra")
    return out.select(key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")


def _masks(radius: int, blocks: int) -> list[int]:
    """For each choice of all but ``radius`` blocks the bits of those blocks, as signed numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within(queries: DataFrame, all_: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """query, fingerprint: every fingerprint of ``all_`` within ``radius`` bits of one of ``queries``.

    Both have one column ``fingerprint``, each value once.
    """
    masks = _masks(radius, blocks)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        tables = [F.struct(F.lit(i).alias("_table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("_bits")) for i, m in enumerate(masks)]
        return df.select(F.col("fingerprint").alias(name), F.inline(F.array(*tables)))

    differ = F.col("query").bitwiseXOR(F.col("_other"))
    meet = F.lit(None).cast("int")
    for i, m in reversed(list(enumerate(masks))):
        meet = F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)).otherwise(meet)
    asked, kept = keyed(queries, "query"), keyed(all_, "_other")
    near = (asked["_table"] == kept["_table"]) & (asked["_bits"] == kept["_bits"])
    near = near & (F.bit_count(differ) <= radius) & (asked["_table"] == meet)
    return asked.join(kept, near).select("query", F.col("_other").alias("fingerprint"))


def count_within(fingerprinted: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """fingerprint and n_within: rows within the radius of each fingerprint of an ``asked`` row, itself included."""
    sizes = fingerprinted.groupBy("fingerprint").agg(F.count("*").alias("_rows"))
    queries = fingerprinted.filter(asked).select("fingerprint").distinct()
    pairs = within(queries, sizes.select("fingerprint"), radius)
    return pairs.join(sizes, "fingerprint").groupBy(F.col("query").alias("fingerprint")).agg(F.sum("_rows").alias("n_within"))


def report(df: DataFrame, key: str = "doc_id", text: str = "text", every: int = 100) -> DataFrame:
    """Fingerprints as text with their likenesses; for keys divisible by ``every`` the rows within RADIUS."""
    found = stored(edited_fingerprints(df, key, text), "fingerprints")
    asked = F.col(key) % every == 0
    counts = count_within(found, asked).withColumn("_asked", F.lit(True))
    marked = found.withColumn("_asked", F.when(asked, F.lit(True)))
    rest = marked.filter("_asked IS NULL").withColumn("n_within", F.lit(None).cast("long"))
    some = marked.filter("_asked").join(counts, ["fingerprint", "_asked"], "left")
    return rest.unionByName(some).select(
        key,
        "n_chars",
        "edited_sha256",
        as_hex(F.col("fingerprint")).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "n_within",
    )
