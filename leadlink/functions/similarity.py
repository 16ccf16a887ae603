"""Indel similarity (longest common subsequence) as a vectorised pandas UDF.

Spark's levenshtein counts a substitution as one edit; the similarity wanted here
is 200 * LCS / (len a + len b), so the LCS length is the one piece in Python.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from leadlink.functions import text as T

# Tasks get these helpers with the task itself, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = 64
CHUNK = 4096


def _codes(strings: list[str], width: int, pad: int) -> np.ndarray:
    """Code points of many strings, one row each, short rows padded."""
    lengths = np.array([len(s) for s in strings])
    body = "".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le", "surrogatepass")
    out = np.frombuffer(body, dtype=np.uint32).reshape(len(strings), width).copy()
    out[np.arange(width) >= lengths[:, None]] = pad
    return out


def _lcs_words(a: np.ndarray, b: np.ndarray, ls: np.ndarray) -> np.ndarray:
    """LCS of many padded pairs at once; every left string fits one machine word."""
    weight = np.left_shift(np.uint64(1), np.arange(a.shape[1], dtype=np.uint64))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    v = np.full(len(a), full, dtype=np.uint64)
    for j in range(b.shape[1]):
        match = (a == b[:, j : j + 1]) @ weight
        u = v & match
        v = (v + u) | (v - u)
    ls = ls.astype(np.uint64)
    mask = np.where(ls >= WORD, full, np.left_shift(np.uint64(1), np.minimum(ls, np.uint64(WORD - 1))) - np.uint64(1))
    return ls.astype(np.int64) - np.bitwise_count(v & mask).astype(np.int64)


def _lcs_long(a: str, b: str) -> int:
    """LCS of one pair of any length with whole-number bit vectors."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & where.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS length of each pair; every distinct string is encoded once, every distinct pair scored once."""
    if not a:
        return np.zeros(0, dtype=np.int64)
    codes, names = pd.factorize(np.array([*a, *b], dtype=object))
    size = np.array([len(s) for s in names])
    x, y = codes[: len(a)], codes[len(a) :]
    swap = size[x] > size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    pairs, back = np.unique(x * len(names) + y, return_inverse=True)
    x, y = pairs // len(names), pairs % len(names)
    got = np.where(x == y, size[x], 0)
    open_pairs = (x != y) & (size[x] > 0)
    words = open_pairs & (size[x] <= WORD) & (size[y] <= 2 * WORD)
    for i in np.flatnonzero(open_pairs & ~words):
        got[i] = _lcs_long(names[x[i]], names[y[i]])
    todo = np.flatnonzero(words)
    if len(todo):
        used, at = np.unique(np.concatenate([x[todo], y[todo]]), return_inverse=True)
        width = max(int(size[used].max()), 1)
        left = _codes([names[u] for u in used], width, 0xFFFFFFFF)
        right = np.where(left == 0xFFFFFFFF, np.uint32(0xFFFFFFFE), left)
        ax, ay = at[: len(todo)], at[len(todo) :]
        order = np.argsort(size[y[todo]], kind="stable")
        for lo in range(0, len(order), CHUNK):
            part = order[lo : lo + CHUNK]
            sx, sy = size[x[todo[part]]], size[y[todo[part]]]
            got[todo[part]] = _lcs_words(left[ax[part], : sx.max()], right[ay[part], : sy.max()], sx)
    return got[back]


@F.pandas_udf(LongType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(a.fillna("").tolist(), b.fillna("").tolist()), index=a.index)


def ratio_from(length: Column, a: Column, b: Column) -> Column:
    """0..100; two empty strings are fully alike."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * length / total)


def ratio(a: Column, b: Column) -> Column:
    return ratio_from(lcs(a, b), a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(T.token_sort(a), T.token_sort(b))


def ratio_sql(a: Column, b: Column) -> Column:
    """The same similarity from built-ins alone (row by row table), as a cross-check."""
    chars_b = F.filter(F.split(b, ""), lambda x: x != "")
    zero = F.transform(chars_b, lambda _: F.lit(0))

    def step(row, ch):
        def cell(acc, i):
            left = F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))
            diag = F.when(i > 0, F.get(row, i - 1)).otherwise(0)
            here = F.when(F.get(chars_b, i) == ch, diag + 1).otherwise(F.greatest(left, F.get(row, i)))
            return F.concat(acc, F.array(here))

        idx = F.filter(F.sequence(F.lit(0), F.size(chars_b)), lambda i: i < F.size(chars_b))
        return F.aggregate(idx, F.array().cast("array<int>"), cell)

    last = F.aggregate(F.filter(F.split(a, ""), lambda x: x != ""), zero, step)
    length = F.when((a == "") | (b == ""), F.lit(0)).otherwise(F.get(last, F.size(chars_b) - 1))
    return ratio_from(length, a, b)
