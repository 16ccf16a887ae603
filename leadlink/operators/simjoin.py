"""Exact blocked similarity join on names, by a pigeonhole index over their letter counts.

Two names are similar when 200 * LCS >= threshold * (len a + len b), that is when at most `allowed` single insertions and
deletions lead from one to the other. Each of these changes one letter count by one, so the counts of similar names
differ by `allowed` in total at most. Letters (folded into 40 classes) are dealt into allowed / 3 + 1 groups: in at least
one of them the counts differ by two at most. Per group a name is indexed under its counts, under its counts with one
letter less, and under its counts with one letter more, and two such names meet once:

    equal counts              counts          = counts
    one letter replaced       counts - x      = counts - y      (x <> y)
    one letter more           counts          = counts - y
    two letters more          counts + x      = counts - y      (x <= y)

What meets is kept if the counts of all classes fit, so the join returns little more than the pairs of similar names that
are not in the same order. Every similar pair meets; nothing is dropped or capped; a hot block is split by counts. Where
names are so long that single classes may differ by more than two, a class is indexed by ranges of its count instead.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.functions import similarity as SIM
from leadlink.session import cut, sorted_side, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLASSES = 40
#: Counts up to LEVELS, written as rows of ones, ten classes to a 60-bit word.
LEVELS, WORDS = 6, 4
KEY_SCHEMA = "block string, name string, len int, scheme int, kind int, key long, letter int, " + ", ".join(f"w{k} long" for k in range(WORDS))
SAME, REPLACED, MORE, TWO_MORE, LESS, TWO_LESS, RANGE = range(7)
#: What the left and the right name of a meeting are indexed under.
LEFT = {SAME: "own", REPLACED: "minus", MORE: "own", TWO_MORE: "plus", LESS: "minus", TWO_LESS: "minus", RANGE: "range"}
RIGHT = {SAME: "own", REPLACED: "minus", MORE: "minus", TWO_MORE: "minus", LESS: "own", TWO_LESS: "plus", RANGE: "ranges"}
WIDE = 1000
_GOLDEN = 0x9E3779B97F4A7C15


def _random(n: int, salt: int) -> np.ndarray:
    """Fixed 64-bit numbers that look random (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * np.uint64(_GOLDEN)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: The key of a group of counts is a sum, so one letter more or less is one addition.
WEIGHT = _random(CLASSES, 0)


def _class_table() -> np.ndarray:
    """Class of each ASCII code: letters without case, digits, blank, three for everything else."""
    code = np.arange(128)
    out = 37 + code % 3
    for first, n, at in (("a", 26, 0), ("A", 26, 0), ("0", 10, 26), (" ", 1, 36)):
        out[ord(first) : ord(first) + n] = at + np.arange(n)
    return out


_TABLE = _class_table()


def letter_counts(names: list[str]) -> np.ndarray:
    """How often each class occurs in each name (names x classes)."""
    code = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(code < 128, _TABLE[np.minimum(code, 127)], 37 + code % 3)
    row = np.repeat(np.arange(len(names)), [len(s) for s in names])
    return np.bincount(row * CLASSES + kind, minlength=len(names) * CLASSES).reshape(-1, CLASSES)


def allowed(n: int, m: int, threshold: int) -> int:
    """Most insertions and deletions between similar names of lengths n and m; always as even or odd as n + m."""
    most = (n + m) * (100 - threshold) // 100
    return most - (most - n - m) % 2


def scheme_of(n: int, m: int, threshold: int) -> int:
    """Number of groups for such a pair, or WIDE + the difference that a single class may have."""
    most = allowed(n, m, threshold)
    return most // 3 + 1 if most // 3 < CLASSES else WIDE + most // CLASSES


def schemes(n: int, threshold: int) -> list[int]:
    """All schemes under which a name of this length may meet a similar one."""
    partners = range(-(-n * threshold // (200 - threshold)), n * (200 - threshold) // threshold + 1)
    return sorted({s for m in partners if (s := scheme_of(n, m, threshold)) > 0})


def deal(weights: list[float], groups: int) -> np.ndarray:
    """Group of each class: heavy classes first, each to the lightest group."""
    total, out = np.zeros(groups), np.zeros(CLASSES, np.int64)
    for c in np.argsort(-np.array(weights), kind="stable"):
        out[c] = k = int(np.argmin(total))
        total[k] += weights[c] + 1e-9
    return out


def _emit(batches: Iterator[pa.RecordBatch], threshold: int, kinds: dict[int, str], weights: list[float]) -> Iterator[pa.RecordBatch]:
    plans: dict[int, list[int]] = {}
    dealt: dict[int, np.ndarray] = {}
    level = np.arange(LEVELS)
    bit = (np.arange(CLASSES) % 10)[:, None] * LEVELS + level
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            few = batch.slice(at, 1000)
            names = few.column(1).to_pylist()
            size = np.array([len(s) for s in names])
            count = letter_counts(names)
            ones = ((count[:, :, None] > level).astype(np.int64) << bit).sum(axis=2).reshape(-1, WORDS, 10).sum(axis=2)
            of_scheme: dict[int, list[int]] = {}
            for k, n in enumerate(size.tolist()):
                if n not in plans:
                    plans[n] = schemes(n, threshold)
                for s in plans[n]:
                    of_scheme.setdefault(s, []).append(k)
            for s, rows in of_scheme.items():
                for kind, row, key, letter in _keys_of(count[rows], s, kinds, weights, dealt):
                    one = np.array(rows)[row]
                    data = [few.column(0).take(pa.array(one)), few.column(1).take(pa.array(one)), pa.array(size[one], pa.int32())]
                    data += [pa.array(np.full(len(one), v), pa.int32()) for v in (s, kind)] + [pa.array(key.view(np.int64)), pa.array(letter, pa.int32())]
                    yield pa.RecordBatch.from_arrays([*data, *(pa.array(ones[one, w]) for w in range(WORDS))], names=[f.split()[0] for f in KEY_SCHEMA.split(", ")])


def _keys_of(count: np.ndarray, scheme: int, kinds: dict[int, str], weights: list[float], dealt: dict[int, np.ndarray]):
    """(kind, row, key, letter) arrays of names with these counts under one scheme."""
    n = len(count)
    row, letter = np.repeat(np.arange(n), CLASSES), np.tile(np.arange(CLASSES), n)
    if scheme >= WIDE:
        place = count // (scheme - WIDE + 1)
        key = lambda shift: ((place + shift).astype(np.uint64) * np.uint64(_GOLDEN) + WEIGHT).ravel()
        for shift in (0,) if kinds.get(RANGE) == "range" else (-1, 0, 1):
            yield RANGE, row, key(shift), letter
        return
    if scheme not in dealt:
        dealt[scheme] = deal(weights, scheme)
    group = dealt[scheme]
    weighted = count.astype(np.uint64) * WEIGHT
    base = np.stack([weighted[:, group == g].sum(axis=1, dtype=np.uint64) for g in range(scheme)], axis=1) + _random(scheme, scheme)
    has = count.ravel() > 0
    less, more = base[:, group].ravel() - np.tile(WEIGHT, n), base[:, group].ravel() + np.tile(WEIGHT, n)
    what = {
        "own": (np.repeat(np.arange(n), scheme), base.ravel(), np.full(n * scheme, -1)),
        "minus": (row[has], less[has], letter[has]), "plus": (row, more, letter),
    }
    for kind, name in kinds.items():
        if name in what:
            yield kind, *what[name]


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 10_000):
            c = letter_counts(batch.column(0).slice(at, 10_000).to_pylist()).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(CLASSES)), pa.array(np.full(CLASSES, len(c))), pa.array(c.sum(axis=0)), pa.array((c * c).sum(axis=0))], names=["class", "n", "total", "squares"]
            )


def letter_weights(names: DataFrame) -> list[float]:
    """Variance of each class's count: 40 rows. It steers only how classes are dealt; any way gives the same pairs."""
    sums = names.select("name").mapInArrow(_totals, "class long, n long, total double, squares double")
    out = [0.0] * CLASSES
    for r in sums.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect():
        out[r["class"]] = max(r["squares"] / r["n"] - (r["total"] / r["n"]) ** 2, 0.0)
    return out


def _keys(names: DataFrame, threshold: int, kinds: dict[int, str], weights: list[float]) -> DataFrame:
    return names.mapInArrow(lambda it: _emit(it, threshold, kinds, weights), KEY_SCHEMA)


def _fits(threshold: int) -> Column:
    """The meeting belongs to the scheme of the pair, and the counts of all classes fit."""
    most = f"((a.len + b.len) * {100 - threshold} DIV 100)"
    most = f"({most} - pmod({most} - a.len - b.len, 2))"
    scheme = f"CASE WHEN {most} DIV 3 < {CLASSES} THEN {most} DIV 3 + 1 ELSE {WIDE} + {most} DIV {CLASSES} END"
    apart = " + ".join(f"bit_count(a.w{k} ^ b.w{k})" for k in range(WORDS))
    letters = (
        f"CASE a.kind WHEN {REPLACED} THEN a.letter <> b.letter WHEN {TWO_MORE} THEN a.letter <= b.letter "
        f"WHEN {TWO_LESS} THEN b.letter <= a.letter WHEN {RANGE} THEN a.letter = b.letter ELSE true END"
    )
    sizes = f"200 * least(a.len, b.len) >= {threshold} * (a.len + b.len)"
    return F.expr(f"{sizes} AND a.scheme = {scheme} AND {letters} AND {apart} <= {most}")


def _meet(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    a, b = left.alias("a"), sorted_side(right).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("block", "scheme", "kind", "key")]
    return a.join(b, same[0] & same[1] & same[2] & same[3] & _fits(threshold))


def _verify(pairs: DataFrame, threshold: int) -> DataFrame:
    total = F.length("name_a") + F.length("name_b")
    return (
        pairs.withColumn("_lcs", SIM.lcs("name_a", "name_b"))
        .where(200 * F.col("_lcs") >= threshold * total)
        .withColumn("sim", SIM.ratio_from(F.col("_lcs"), F.col("name_a"), F.col("name_b")))
        .drop("_lcs")
    )


def _usable(df: DataFrame) -> DataFrame:
    return df.select("block", "name").where((F.col("block") != "") & (F.col("name") != ""))


def candidates_within(names: DataFrame, threshold: int, weights: list[float]) -> DataFrame:
    """Meetings of different names of a block (block, name_a, name_b), the shorter or lesser first; a pair may repeat."""
    once = (SAME, REPLACED, RANGE)
    left = {k: LEFT[k] for k in (SAME, REPLACED, MORE, TWO_MORE, RANGE)}
    met = _meet(_keys(names, threshold, left, weights), _keys(names, threshold, {k: RIGHT[k] for k in left}, weights), threshold)
    a, b = F.struct("a.len", "a.name"), F.struct("b.len", "b.name")
    # A pair meets in both directions where the two sides are indexed alike.
    met = met.where((F.col("a.kind").isin(*once) & (a < b)) | ~F.col("a.kind").isin(*once))
    return met.select(F.col("a.block").alias("block"), F.least(a, b)["name"].alias("name_a"), F.greatest(a, b)["name"].alias("name_b"))


def similar_within(df: DataFrame, threshold: int, distinct: bool = False, weights: list[float] | None = None) -> DataFrame:
    """Similar pairs of different names in the same block: block, name_a, name_b, sim.

    `df` has string columns block and name. Copies are collapsed into a checkpointed table of
    distinct names first, unless the caller passes such a table (`distinct`).
    """
    names = _usable(df) if distinct else cut(spread(_usable(df).distinct()))
    return _verify(candidates_within(names, threshold, weights or letter_weights(names)).distinct(), threshold)


def similar_between(left: DataFrame, right: DataFrame, threshold: int, distinct: bool = False, weights: list[float] | None = None) -> DataFrame:
    """Similar pairs of a left and a right name in the same block (equal names too)."""
    a, b = _usable(left), _usable(right)
    if not distinct:
        a, b = cut(spread(a.distinct())), cut(spread(b.distinct()))
    weights = weights or letter_weights(a.unionByName(b))
    met = _meet(_keys(a, threshold, LEFT, weights), _keys(b, threshold, RIGHT, weights), threshold)
    pairs = met.select(F.col("a.block").alias("block"), F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))
    return _verify(pairs.distinct(), threshold)
