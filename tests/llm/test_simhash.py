import re

import numpy as np
import pytest
import xxhash
from brute import LONG, ROWS, STORY, frame
from pyspark.sql import functions as F

from leadlink.llm import simhash


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(grams))


def roots(prints, radius):
    prints = np.array(prints, np.uint64)
    root = np.arange(len(prints))
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= radius) for p in prints]
    while True:
        new = np.array([root[n].min() for n in near])
        if (new == root).all():
            return root
        root = new


TEXTS = [
    "", " \t\n ", "One", "one TWO  three", "a b c d", "a  b\tc\nd\x0be", "ÀÉ Élan ΣΑΣ \x1c x   y", "a a a a a a a a", " lead and trail ", STORY, LONG[:300_000], "x" * 100_000,
]


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_fingerprint_by_hand(k):
    assert simhash.fingerprint(TEXTS[k].encode()) == plain(TEXTS[k])


def test_chunks_do_not_matter():
    text = LONG[:50_000].encode()
    assert simhash.fingerprint(text, chunk=100) == simhash.fingerprint(text)


def same_components(links, prints, radius):
    root = {int(p): int(p) for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(int(a)), find(int(b))
        root[max(a, b)] = min(a, b)
    want = roots(prints, radius)
    got = [find(int(p)) for p in prints]
    pairs = set(zip(want.tolist(), got))
    return len(pairs) == len(set(want.tolist())) == len(set(got))


def crowd(n, seed=1):
    """Distinct fingerprints: random ones, chains of few flipped bits, one dense ball and the two extremes."""
    rng = np.random.default_rng(seed)
    out = [0, 2**64 - 1, 1, *(int(x) for x in rng.integers(0, 2**64, n // 2, np.uint64))]
    while len(out) < n * 3 // 4:
        x = out[int(rng.integers(len(out)))]
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    centre = out[10]
    out += [centre ^ 1 << int(i) ^ 1 << int(j) for i, j in rng.integers(0, 64, (n // 4, 2))]
    return np.array(sorted(set(out)), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 4, 8])
def test_forest_equals_brute_force(radius):
    prints = crowd(1500)
    prints = prints[np.lexsort(simhash.counts(prints)[:, simhash.ORDER[::-1]].T)]
    links = simhash.forest(prints, prints, radius, same=True)
    assert len(links) < len(prints)
    assert all(np.bitwise_count(prints[i] ^ prints[j]) <= radius for i, j in links)
    assert same_components([(prints[i], prints[j]) for i, j in links], prints, radius)


def test_tiles_skip_nothing_that_links(spark):
    prints = crowd(3000, seed=2)
    rows = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    got = simhash.links(rows, len(prints), radius=4, side=200).collect()
    links = [(np.array([r.a, r.b]).view(np.uint64)) for r in got]
    assert all(np.bitwise_count(a ^ b) <= 4 for a, b in links)
    assert same_components(links, prints, 4)


def test_far_tiles_are_not_paired(spark):
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 2**64, 40_000, np.uint64))
    rows = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    cut = simhash.tiles(rows, len(prints), side=500)
    n = cut.count()
    assert simhash.tile_pairs(cut, 4).count() < 0.6 * n * (n + 1) / 2


@pytest.mark.parametrize("rows", [[], ROWS, [(None, STORY, "en"), (None, STORY, None)], [(k, f"{STORY} {STORY.replace('fox', 'cat')} {'end ' * (k % 3)}", "en") for k in range(200, 0, -1)] + [(None, STORY, "de")] * 100 + [(7, None, "x")] * 100])
def test_components_equal_brute_force(spark, rows):
    got = simhash.linked(frame(spark, rows)).collect()
    prints = [plain(r[1]) for r in rows]
    root = roots(prints, 4) if rows else []
    least = {}
    for (i, *_), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain(r.text) for r in docs]
    root = roots(prints, 4)
    least = {}
    for r, c in zip(docs, root):
        least[c] = min(r.doc_id, least.get(c, r.doc_id))
    got = simhash.op11_simhash_dedup(spark, sf)
    assert {tuple(r) for r in got.collect()} == {(r.doc_id, f"{p:016x}", least[c]) for r, p, c in zip(docs, prints, root)}


def test_fingerprint_hash_is_the_engine_one(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first().h & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)
