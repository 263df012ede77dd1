"""SimHash, the Jaccard join, components and sharding against brute force."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ticketmill.llm import components, jaccard, sharding, simhash

SCHEMA = "doc_id long, text string"


def _edits(rows):
    """(id, chars, digest of the edited text, next id) in falling order of ids."""
    ordered = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1] or ""))
    for i, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        yield key, len(text), hashlib.sha256(edited.encode()).hexdigest(), edited, following


@pytest.mark.parametrize("rows_per_range", [2000, 3])
def test_fingerprints(spark, odd_rows, monkeypatch, rows_per_range):
    monkeypatch.setattr(simhash, "RANGE_ROWS", rows_per_range)
    rng = random.Random(1)
    rows = odd_rows + [(30 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60)))) for i in range(40)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", fingerprint int")
    got = simhash.edited_fingerprints(df).collect()
    want = list(_edits(rows))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter(w[:3] for w in want)
    # The fingerprint of each text on its own.
    texts = sorted({t for w in want for t in (w[3], w[4])})
    alone = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    prints = {texts[r.i]: r.fingerprint for r in simhash.fingerprints(simhash.term_rows(alone, "t", "i"), "i").collect()}
    assert prints[""] == 0
    by_edit = {(w[0], w[2]): (prints[w[3]], prints[w[4]]) for w in want}
    assert all((r.edited_fingerprint, r.next_fingerprint) == by_edit[r.doc_id, r.edited_sha256] for r in got)
    plan = simhash.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_votes(spark):
    """Each bit is the majority of the term hashes, counted as often as the term occurs."""
    df = spark.createDataFrame([(1, "a b c a b c a b c d")], "i int, t string")
    hashes = [r._term for r in simhash.term_rows(df, "t", "i").collect()]
    assert len(hashes) == 10
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    got = simhash.fingerprints(simhash.term_rows(df, "t", "i"), "i").first().fingerprint
    assert got & (1 << 64) - 1 == want
    assert df.select(simhash.as_hex(F.lit(got)).alias("x")).first().x == f"{want:016x}"


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 5), (7, 9)])
def test_block_tables_find_all(spark, radius, blocks):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = set()
    for s in seeds:
        for _ in range(25):
            x = s
            for b in rng.sample(range(64), rng.randint(0, 9)):
                x ^= 1 << b
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = Counter(tuple(r) for r in simhash.within(df.limit(60), df, radius, blocks).collect())
    queries = {r.fingerprint for r in df.limit(60).collect()}
    want = {(q, p) for q in queries for p in prints if ((q ^ p) & (1 << 64) - 1).bit_count() <= radius}
    assert set(got) == want and set(got.values()) == {1}


def _near_texts(seed, count=260):
    """Copies with a few words changed, of texts of many lengths."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmno") + rng.choice("pqrst")
    bases = [[word() for _ in range(n)] for n in (1, 2, 3, 5, 9, 14, 30, 60, 61, 120, 300, 900) for _ in range(2)]
    texts = []
    for _ in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 1, 2, 3, len(words) // 12))):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [word() for _ in range(rng.randint(0, 2))] or [word()]
        texts.append(" ".join(words).upper() if rng.random() < 0.1 else " ".join(words))
    return texts


def _sets(rows, rule):
    for key, text in rows:
        w = (text or "").encode().lower().split()
        runs = {tuple(w[i : i + rule.width]) for i in range(len(w) - rule.width + 1)} if len(w) >= rule.width else {tuple(w)} - {()}
        yield key, frozenset(runs)


def _groups(rows, rule):
    sets = list(_sets(rows, rule))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
            parent[root(j)] = root(i)
    least = defaultdict(list)
    for i, (key, _) in enumerate(sets):
        least[root(i)].append(key)
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in least.items()}
    return Counter((key, len(s), name[root(i)]) for i, (key, s) in enumerate(sets))


RULES = [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 80, 100), jaccard.Rule(1, 50, 100)]


@pytest.mark.parametrize("rule", RULES)
def test_components_of_near_texts(spark, rule, odd_rows, monkeypatch):
    rows = odd_rows + [(50 + i, t) for i, t in enumerate(_near_texts(1))]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", key string").repartition(3)
    assert Counter(tuple(r) for r in jaccard.components(df, rule=rule).collect()) == _groups(rows, rule)


def test_blocks_and_rounds(spark, monkeypatch):
    """Large tiles cut into blocks, with more rounds than one."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "PARTNERS", 1)
    monkeypatch.setattr(jaccard, "SHIPPED_KEYS", 0)
    rule = jaccard.Rule(1, 80, 100)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(40)]
    chain = [" ".join(base[i // 2 : i // 2 + 30]) + f" z{i}" for i in range(20)]
    star = [" ".join(w for w in base if w != f"w{i}") + f" y{i}" for i in range(40)]
    rows = list(enumerate([*chain, *star, " ".join(base)]))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(tuple(r) for r in jaccard.components(df, rule=rule).collect()) == _groups(rows, rule)


def test_every_link(spark):
    rule = jaccard.Rule(3, 80, 100)
    rows = list(enumerate(_near_texts(2, 150)))
    links, member = jaccard.links(spark.createDataFrame(rows, SCHEMA), rule=rule)
    first = {}
    for key, s in sorted(_sets(rows, rule)):
        first.setdefault(s, key)
    classes = [(s, k) for s, k in first.items() if s]
    want = {
        frozenset((k, m))
        for (a, k), (b, m) in itertools.combinations(classes, 2)
        if rule.den * len(a & b) >= rule.num * len(a | b)
    }
    got = [frozenset((r.first_a, r.first_b)) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.doc_id: r.first for r in member.collect()} == {k: first[s] for k, s in _sets(rows, rule) if s}


def test_bitmaps_never_exclude_a_link():
    import numpy as np

    rng = np.random.default_rng(3)
    rule = jaccard.Rule(3, 80, 100)
    for _ in range(300):
        n = int(rng.integers(2, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, n // 20 + 1, dtype=np.uint64)])
        a, b = sorted((a, b), key=len)
        linked = len(np.intersect1d(a, b)) >= rule.needed(len(a) + len(b))
        if linked and len(b) <= len(a) * rule.den // rule.num:
            sizes = np.array([len(a), len(b)])
            assert list(jaccard._passing(sizes, [jaccard.bitmap(a), jaccard.bitmap(b)], np.zeros(2), False, rule))
            lows = rule.bands()
            equal = jaccard.key_of(a) == jaccard.key_of(b)
            assert equal or np.isin(jaccard.signatures(a, rule, lows), jaccard.signatures(b, rule, lows)).any()


def test_join_empty(spark):
    assert jaccard.components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert jaccard.components(spark.createDataFrame([(1, None)], SCHEMA)).collect()[0] == (1, 0, 1)


def test_roots(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.roots(df).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components.roots(df.limit(0)).count() == 0


def test_table_is_filled_in_turns():
    shards, slots = [f"s{i}" for i in range(5)], 101
    table = [None] * slots
    orders = []
    for s in shards:
        offset, step = sharding.preference(s, slots)
        orders.append(iter([(offset + i * step) % slots for i in range(slots)]))
    turn = itertools.cycle(range(5))
    while None in table:
        s = next(turn)
        slot = next(x for x in orders[s] if table[x] is None)
        table[slot] = s
    assert sharding.fill(shards, slots) == table
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1


def test_a_shard_that_leaves_moves_little():
    shards = [f"s{i}" for i in range(16)]
    before, after = sharding.fill(shards), sharding.fill(shards[:-1])
    moved = sum(a != b for a, b in zip(before, after, strict=True) if b != 15 and a != 15)
    assert moved < 0.05 * sharding.SLOTS


def test_placing_rows(spark, odd_rows, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in odd_rows], SCHEMA + ", shard string")
    got = sharding.place(df, ["a", "b", "c"], slots=31).collect()
    table = sharding.fill(["a", "b", "c"], 31)
    assert len(got) == len(odd_rows) and all(r.shard == "abc"[table[r.slot]] for r in got)
    assert len({r.slot for r in got if r.doc_id == 2}) == 1
    sharding.write_shards(df, str(tmp_path / "out"), ["a", "b", "c"], slots=31)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(odd_rows)
    assert sharding.place(df.limit(0), ["a"], slots=31).count() == 0
    for wrong in (lambda: sharding.fill([], 31), lambda: sharding.fill(["a"], 30), lambda: sharding.fill(["a", "a"], 31)):
        with pytest.raises(ValueError):
            wrong()


def test_columns_of_placed_rows_may_have_any_name(spark):
    df = spark.createDataFrame([(1, 5, 6, 7)], "doc_id long, _slot int, row int, `a.b` int")
    (got,) = sharding.place(df, ["a"], slots=31).collect()
    assert tuple(got)[:4] == (1, 5, 6, 7) and got.shard == "a" and 0 <= got.slot < 31
