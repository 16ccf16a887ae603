import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadlink.llm import hard_negatives as hn


def expected(rows, positives=5, negatives=5):
    kept = []
    for k, (i, v, label) in enumerate(rows):
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((k, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    order = lambda t: (-t[0], t[1] is None, t[1] if t[1] is not None else 0)
    out = []
    for k, i, label, q in kept:
        if i is None or i % 100:
            continue
        score = [(sum(a * b for a, b in zip(q, r)), j, m, n) for n, j, m, r in kept]
        same = sorted([s for s in score if s[2] == label and s[3] != k], key=order)[:positives]
        for ps, pid, *_ in same:
            window = sorted([s for s in score if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps], key=order)[:negatives]
            out += [(i, pid, r, s[1], ps, s[0]) for r, s in enumerate(window, 1)]
    return sorted(out, key=repr)


def embeddings(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    # Names that the operator uses inside itself.
    for c in ("id", "vec", "row", "place", "rank", "block", "chunk", "number", "low", "high", "score", "hit", "anchor", "need", "sheet"):
        frame = frame.withColumn(c, F.lit("x"))
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def as_float32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def random_rows(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(k, (rng.normal(size=dims) * spread).tolist(), int(rng.integers(10))) for k in range(n)]


def ties():
    """A hot vector on a third of the rows, repeated ids and rows, whole numbers with many equal scores."""
    rng = np.random.default_rng(5)
    rows = [(k, [1.0, 0.5, -0.25], k % 3) for k in range(300)] + [(100, [1.0, 0.5, -0.25], 1)] * 20
    return rows + [(int(k), rng.integers(-2, 3, 3).astype(float).tolist(), int(rng.integers(4))) for k in rng.integers(0, 900, 600)]


def broken():
    inf, nan = float("inf"), float("nan")
    rows = random_rows(400, 4, 7)
    rows += [(500, None, 1), (600, [None, 1.0, 1.0, 1.0], 2), (700, [nan, 1.0, 1.0, 1.0], 3), (800, [1.0, inf, 1.0, 1.0], 4), (900, [1.0, -inf, 0.0, 0.0], 4), (1000, [1.0] * 4, None)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0], k % 3) for k in range(30)] + [(1100, [], 1), (1200, [2.0], 1), (1300, [1.0, 1.0, 0.0, 0.0, 5.0, 1.0], 2), (-100, [0.5] * 4, 2)]
    return rows


CASES = {
    "empty": [], "one row": [(100, [1.0, 2.0], 3)], "no anchor": random_rows(50, 3, 1)[1:], "no vector": [(100, None, 1), (200, [None], 2)],
    "random": random_rows(1500, 8, 2, 0.3), "ties": ties(), "broken": broken(), "negative scores only": [(k * 100, [float(1 - 2 * (k % 2))], 1 + k % 2 * 0) for k in range(2)],
}


@pytest.mark.parametrize("case", CASES)
def test_mining_equals_brute_force(spark, tmp_path, case):
    rows = as_float32(CASES[case])
    got = hn.op13_hard_negatives(spark, embeddings(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_small_blocks_and_chunks(spark, tmp_path, monkeypatch):
    for name, size in (("BLOCK", 16), ("SHEET", 3), ("SLICE", 2), ("CHUNK", 4)):
        monkeypatch.setattr(hn, name, size)
    rows = as_float32(random_rows(1200, 6, 11, 0.5) + ties())
    rows = [(i, (v + [0.0] * 6)[:6], label) for i, v, label in rows]
    got = hn.op13_hard_negatives(spark, embeddings(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_all_cells_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hn.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("size", [200, 60_000, 2**27])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size, (20, 40)), rng.integers(-size, size, (30, 40))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert hn.product(a, b).tolist() == want


def test_bounds_hold_everything_in_the_block():
    rng = np.random.default_rng(0)
    a, x = rng.integers(-256, 256, (50, 12)), rng.integers(-256, 256, (200, 12))
    low, high = hn.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (low[:, 0] <= score.min(axis=1)).all() and (score.max(axis=1) <= high[:, 0]).all()


def test_clustered_vectors_leave_few_blocks(spark, monkeypatch):
    """Twenty tight clusters: a block far from an anchor's windows is not read."""
    monkeypatch.setattr(hn, "BLOCK", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    rows = [(k, (centres[k % 20] + rng.normal(size=16) * 0.01).tolist(), int(k % 20 // 2)) for k in range(6400)]
    read = []
    keep = hn.stored
    monkeypatch.setattr(hn, "stored", lambda df, label: (out := keep(df, label), read.append(out) if label == "chosen-blocks" else None)[0])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    hn.mine(frame, "vec_id", "embedding", F.col("label"), F.expr("vec_id % 100 = 0")).count()
    needs = read[0].select(F.sum(F.size("need"))).first()[0]
    assert needs < 0.2 * 64 * 100


def test_lists_of_unequal_length():
    lists = pa.array([[1, 2], [], [3, 4, 5]], pa.list_(pa.int64()))
    assert hn.matrix(lists).tolist() == [[1, 2, 0], [0, 0, 0], [3, 4, 5]]
    assert hn.matrix(lists.slice(1), 2).tolist() == [[0, 0], [3, 4]]
