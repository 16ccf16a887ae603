"""Exact and near duplicates, against brute force."""

import random

import numpy as np
import pytest
from brute import ROWS, frame, grams, jaccard, near_classes, normal
from leadlink.llm import exact_dedup, near_dedup


@pytest.mark.parametrize("heavy", [1, 1024])
def test_exact(spark, heavy):
    got = exact_dedup.mark(frame(spark), heavy=heavy).collect()
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(normal(t), []).append(i)
    want = []
    for i, t, _ in ROWS:
        g = groups[normal(t)]
        least = min((x for x in g if x is not None), default=None)
        want.append((i, least, len(g), i == least))
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=repr) == sorted(want, key=repr)


def test_exact_heavy_hitters_are_settled_before_the_shuffle(spark):
    rows = [(k, "same" if k % 3 else f"own {k}", "en") for k in range(3000)]
    got = exact_dedup.mark(frame(spark, rows), heavy=4).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(1, 2000)}
    assert sum(r.kept for r in got) == 1001


def test_exact_remove(spark):
    got = exact_dedup.remove(frame(spark))
    assert got.columns == frame(spark).columns
    # Row 2 repeats id and text of another row 2, both go for row 1; 4 is the smallest of the empty texts.
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4, 6, 7, 8, 10, 11, 12, 13]
    assert exact_dedup.remove(frame(spark, [])).collect() == [] and exact_dedup.mark(frame(spark, [])).collect() == []


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    for spread in (1, 3, 40):
        ca, cb = rng.integers(1, 2 * spread, 300), np.maximum(0, rng.integers(0, 2 * spread, 300))
        sign = near_dedup.bag_minhash([(a, ca), (a[cb > 0], cb[cb > 0])], 4000)
        want = np.minimum(ca, cb).sum() / np.maximum(ca, cb).sum()
        assert np.isfinite(sign).all() and abs((sign[0] == sign[1]).mean() - want) < 0.04


def test_multiset_overlap_is_exact():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (" ".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(2))
        assert near_dedup.similarity(near_dedup.expanded(a), near_dedup.expanded(b)) == pytest.approx(jaccard(grams(a), grams(b)))


def group(seed, n, size=120, edits=(0, 7)):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(size)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("few_pairs, tile", [(1024, 256), (0, 16)])
def test_near_classes(spark, few_pairs, tile):
    texts = group(1, 150) + group(2, 20) + group(3, 2, edits=(0, 2)) + [f"{t} tail" for t in group(4, 3, 30)]
    rows = list(enumerate(texts))
    random.Random(9).shuffle(rows)
    got = near_dedup.classes(frame(spark, [(i, t, "en") for i, t in rows]), few_pairs=few_pairs, tile=tile).collect()
    want = near_classes(rows)
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = {c: list(want.values()).count(c) for c in set(want.values())}
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_defined_cases(spark):
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in near_dedup.classes(frame(spark)).collect()), key=repr)
    want = near_classes([(i, t) for i, t, _ in ROWS if i is not None])
    assert got == sorted([(i, want[i] if i is not None else 1 if t else None, i == (want[i] if i is not None else 1 if t else None)) for i, t, _ in ROWS], key=repr)
    assert near_dedup.classes(frame(spark, [])).collect() == []
    kept = sorted((r.doc_id for r in near_dedup.remove(frame(spark)).collect()), key=repr)
    assert kept == sorted([i for i, t, _ in ROWS if (want[i] == i if i is not None else not t)], key=repr)


def test_ids_that_repeat_or_lack_neither_lose_nor_keep_texts(spark):
    """A third of the rows under one id, a third under none; every class leaves exactly one row."""
    texts = group(1, 40) + group(2, 30) + [f"alone {k} " + " ".join(f"q{k * 31 + j}" for j in range(30)) for k in range(20)]
    texts += texts[:20]
    random.Random(3).shuffle(texts)
    rows = [((5, None, 100 + k)[k % 3], t, "en") for k, t in enumerate(texts)]
    label = near_classes(list(enumerate(texts)))
    for remove, of in ((near_dedup.remove, lambda k: label[k]), (exact_dedup.remove, lambda k: normal(texts[k]))):
        got = remove(frame(spark, rows))
        assert got.columns == frame(spark).columns
        members = {}
        for k, (i, t, _) in enumerate(rows):
            members.setdefault(of(k), []).append((i, t))
        kept = [(r.doc_id, r.text) for r in got.collect()]
        assert len(kept) == len(members)
        for group_rows in members.values():
            stays = [x for x in kept if x in group_rows]
            least = min((i for i, _ in group_rows if i is not None), default=None)
            assert len(stays) == 1 and stays[0][0] == least


def test_one_id_on_unlike_texts(spark):
    a, b, c = group(1, 1)[0], *group(2, 2, edits=(0, 1))
    rows = [(1, a, "en"), (5, a, "en"), (5, b, "en"), (7, c, "en")]
    assert sorted((r.doc_id, r.text) for r in near_dedup.remove(frame(spark, rows)).collect()) == [(1, a), (5, b)]
    got = sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in near_dedup.classes(frame(spark, rows)).collect())
    assert got == [(1, 1, 2, True), (5, 1, 2, False), (5, 5, 2, True), (7, 5, 2, False)]
