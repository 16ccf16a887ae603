"""Near-duplicates by SimHash: 64-bit fingerprints, all pairs within a radius by tiled exact comparison, components.

A fingerprint bit is 1 if it is set in more than half of the XXH64 hashes (seed 42) of the text's four-word shingles.

1. Equal fingerprints collapse first, with partial aggregation, so copies cost nothing later.
2. Distinct fingerprints are sorted by the population counts of their halves, quarters and bytes, in that order, and cut
   into tiles. A tile knows the least and greatest count of the whole fingerprint and of every part.
3. Two fingerprints that differ in d bits differ by at most d in the counts of the whole, and of the halves, the quarters
   or the bytes added up. So a pair of tiles whose counts differ beyond the radius holds no link and is never formed.
   Inside a pair of tiles the same test skips pairs of sub-tiles of 64; what is left is compared by exclusive-or and bit
   counts in numpy.
4. A pair of tiles returns a spanning forest of its links, fewer links than it has fingerprints, so a dense group of near
   copies never becomes a list of all its pairs. Components of the forests are the components of all links.

Comparisons grow with the square of the distinct fingerprints, as the method has it; the more fingerprints, the more parts
of the sort order are narrow within a tile, so the share that is compared falls with the input.

Defined cases: a null or blank text has no words and the fingerprint zero; one to three words are one shingle; rows with
equal ids each have their own fingerprint, and the id stands for all of them as a component's name; a null id is never a
name (null only where no member has an id). Only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.llm.common import ship, stored, table
from leadlink.llm.registry import query
from leadlink.operators.dedup import components

ship(__name__)

SEED = 42
#: Bytes that separate words: tab to carriage return, and blank.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.float32)
#: The whole fingerprint, its halves, quarters and bytes.
PARTS = [((1 << width) - 1) << low for width in (64, 32, 16, 8) for low in range(64 - width, -1, -width)]
GRAIN = np.repeat(np.arange(4), (1, 2, 4, 8))
#: Which counts order the fingerprints; the others follow from these.
ORDER = [1, 2, 3, 5, 7, 9, 11, 13]
SUB = 64


def words_of(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single blanks, and where each starts and ends in that."""
    text = np.frombuffer(raw.lower(), np.uint8)  # bytes.lower() changes A-Z only
    gap = SPACE[text]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = end - start
    keep = ~gap
    keep[start[1:] - 1] = True
    joined = text[keep]
    joined[SPACE[joined]] = 32
    first = np.cumsum(size + 1) - size - 1
    return joined.tobytes(), first, first + size


def fingerprint(raw: bytes, width: int = 4, chunk: int = 65536) -> int:
    text, start, end = words_of(raw)
    if not len(start):
        return 0
    width = min(width, len(start))
    n = len(start) - width + 1
    end = end[width - 1 :]
    ones = np.zeros((8, 8))
    for k in range(0, n, chunk):
        spans = zip(start[k : min(k + chunk, n)].tolist(), end[k : k + chunk].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in spans], "<u8")
        places = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        ones += np.bincount(places.ravel(), minlength=2048).reshape(8, 256).astype(np.float32) @ BITS
    return int(np.packbits(ones.ravel() * 2 > n, bitorder="little").view("<u8")[0])


def _signer(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            prints = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), width) if t.is_valid else 0 for t in text), np.uint64, len(text))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], names=["id", "print"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print) of every row; the 64 bits as a signed number."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_signer(width), f"id {rows.schema['id'].dataType.simpleString()}, print long")


def counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of all parts (fingerprints x parts)."""
    return np.bitwise_count(prints[:, None] & np.array(PARTS, np.uint64)).astype(np.int16)


def _cutter(side: int):
    def tile(number: int, prints: np.ndarray) -> pa.RecordBatch:
        c = counts(prints)
        data = [[number], [prints.tobytes()], [c.min(axis=0).tolist()], [c.max(axis=0).tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(data, (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())), strict=True)], names=["tile", "prints", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, np.empty(0, np.int64)
        for batch in batches:
            held = np.concatenate([held, batch.column("print").to_numpy()])
            while len(held) >= side:
                yield tile(number, held[:side].view(np.uint64))
                number, held = number + 1, held[side:]
        if len(held):
            yield tile(number, held.view(np.uint64))

    return run


def tiles(prints: DataFrame, n: int, side: int = 65536) -> DataFrame:
    """(tile, prints, low, high) of distinct fingerprints (print), at most `side` in a tile.

    Small inputs are cut into up to 64 smaller tiles, so that there is work for many tasks.
    """
    part = lambda k: F.bit_count(F.col("print").bitwiseAND(F.lit(int(np.uint64(PARTS[k]).view(np.int64)))))
    ranges = max(-(-n // side), min(64, -(-n // 1024)), 1)
    order = [*(part(k) for k in ORDER), F.col("print")]
    ordered = prints.select("print").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(_cutter(side), "tile long, prints binary, low array<int>, high array<int>"), "tiles")


def apart() -> Column:
    """The least number of bits in which members of two tiles (low_a, high_a; low_b, high_b) differ."""
    gaps = F.expr("transform(sequence(0, size(low_a) - 1), k -> greatest(0, low_a[k] - high_b[k], low_b[k] - high_a[k]))")
    total = lambda g: F.aggregate(F.slice(gaps, int(np.argmax(GRAIN == g)) + 1, int((GRAIN == g).sum())), F.lit(0), lambda a, x: a + x)
    return F.greatest(*[total(g) for g in range(4)])


def tile_pairs(cut: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of tiles, a <= b, that may hold a link; tiles meet on the count of the upper half."""
    zone = lambda s: [F.col("tile").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}")]
    a = cut.select(*zone("a"), F.explode(F.sequence(F.col("low")[1], F.col("high")[1])).alias("count"))
    b = cut.select(*zone("b"), F.explode(F.sequence(F.col("low")[1] - radius, F.col("high")[1] + radius)).alias("count"))
    # A pair meets on each common count; the least of these is where it is kept.
    once = F.col("count") == F.greatest(F.col("low_a")[1], F.col("low_b")[1] - radius)
    return a.join(b, "count").where((F.col("a") <= F.col("b")) & once & (apart() <= radius)).select("a", "b")


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links between (or, if same, within) two sorted arrays of distinct fingerprints, without those that close a circle."""
    grain = (GRAIN[:, None] == np.arange(4)).astype(np.int16)

    def zones(x):
        c, at = counts(x), np.arange(0, len(x), SUB)
        return np.minimum.reduceat(c, at), np.maximum.reduceat(c, at)

    (low_a, high_a), (low_b, high_b) = zones(a), zones(b)
    shift = 0 if same else len(a)
    parent = np.arange(shift + len(b))
    links = []
    for k in range(len(low_a)):
        gap = np.maximum(np.maximum(low_a[k] - high_b, low_b - high_a[k]), 0)
        near = np.flatnonzero((gap @ grain).max(axis=1) <= radius)
        if same:
            near = near[near >= k]
        at = (near[:, None] * SUB + np.arange(SUB)).ravel()
        at = at[at < len(b)]
        row, col = np.nonzero(np.bitwise_count(a[k * SUB : k * SUB + SUB, None] ^ b[at]) <= radius)
        row, col = row + k * SUB, at[col]
        u, v = parent[row], parent[col + shift]
        _, one = np.unique((u * len(parent) + v)[u != v], return_index=True)
        one = np.flatnonzero(u != v)[one]
        for i, j, x, y in zip(row[one].tolist(), col[one].tolist(), u[one].tolist(), v[one].tolist(), strict=True):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((i, j))
        while len(one) and (parent[parent] != parent).any():
            parent = parent[parent]
    return links


def _comparer(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "prints_a", "prints_b")), strict=True):
                x, y = (np.frombuffer(p.as_buffer(), np.int64) for p in (x, y))
                links = np.array(forest(x.view(np.uint64), y.view(np.uint64), radius, a == b), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x[links[:, 0]]), pa.array(y[links[:, 1]])], names=["a", "b"])

    return run


def links(prints: DataFrame, n: int, radius: int = 4, side: int = 65536) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius that connect the same components as all such pairs."""
    cut = tiles(prints, n, side)
    pairs = tile_pairs(cut, radius)
    for s in "ab":
        pairs = pairs.join(cut.select(F.col("tile").alias(s), F.col("prints").alias(f"prints_{s}")), s)
    return pairs.repartition("a", "b").mapInArrow(_comparer(radius), "a long, b long")


def linked(docs: DataFrame, radius: int = 4, width: int = 4, side: int = 65536, heavy: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row."""
    rows = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    groups = stored(rows.groupBy("print").agg(F.count("*").alias("n"), F.min("id").alias("least")), "fingerprint-groups")
    found = stored(links(groups, groups.count(), radius, side), "fingerprint-links")
    nodes = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = stored(components(found, nodes).withColumnRenamed("id", "print"), "fingerprint-labels")
    named = labels.join(groups, "print").groupBy("component").agg(F.min("least").alias("name"))
    named = labels.join(named, "component").select("print", "name", F.lit(True).alias("met"))
    final = stored(groups.join(named, "print", "left").select("print", "n", F.when(F.col("met"), F.col("name")).otherwise(F.col("least")).alias("component_id")), "components")
    # At most `heavy` fingerprints hold more than one row in `heavy`; the others make an even shuffle.
    hot = F.broadcast(final.where(F.col("n") * heavy > rows.count()).drop("n"))
    out = rows.join(hot, "print").unionByName(rows.join(hot.select("print"), "print", "left_anti").join(final.drop("n"), "print"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_simhash_dedup")
def op11_simhash_dedup(spark, sf_dir):
    return linked(table(spark, sf_dir, "documents"))
