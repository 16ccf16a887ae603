"""Hard negatives by exact search over Hilbert-ordered blocks with zone maps.

Vectors of whole numbers are ordered along a Hilbert curve through the dimensions of greatest variance and cut into
Parquet blocks; each block keeps the least and greatest value of every dimension, and of its labels. A search asks for
the best scores inside a window of scores. Interval arithmetic on the zone map bounds the inner product of a vector with
everything in a block from both sides, so a block whose bounds miss all windows of a vector is not read for it.

1. Positives: the best rows with the anchor's label. The anchor's own block gives the least score that can still count.
2. Negatives: the best rows with another label in the window under each positive's score.

Searches run in chunks of neighbouring anchors against slices of blocks; a task holds one chunk and one slice and keeps
only the best hits of each search, which are merged by a window afterwards. The work is anchors times blocks not ruled
out; nothing else grows faster than the rows. How much is ruled out depends on the vectors: clustered ones leave few
blocks, independent dimensions leave nearly all.

Defined cases: rows with a null label, a null vector or any null or non-finite component take no part; vectors of
unequal length are extended by zeros; every row counts by itself, also with a repeated or null id (a null id loses ties
last, and is no anchor); scores beyond 64 bits wrap; an empty table gives an empty result. Only the named columns are
read, whatever the others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlink.llm.common import ship, stored, table
from leadlink.llm.registry import query

ship(__name__)

LOW, HIGH = -(1 << 62), 1 << 62
#: Dimensions and bits of the curve: 63 bits in all.
DIMS, BITS = 9, 7
#: Rows of a block (fewer for long vectors), blocks of a zone sheet, of a slice, anchors of a chunk.
BLOCK, SHEET, SLICE, CHUNK = 1024, 1024, 64, 512
NO_ID = (1 << 63) - 1


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (whole numbers under 2^bits) along the Hilbert curve, by Gray code and rotations per bit."""
    x = x.astype(np.int64).copy()
    for b in range(bits - 1, 0, -1):
        below = (1 << b) - 1
        for d in range(x.shape[1]):
            flip = (x[:, d] >> b & 1) == 1
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, d]) & below)
            x[:, 0] ^= np.where(flip, below, swap)
            x[:, d] ^= swap
    for d in range(1, x.shape[1]):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> b & 1 == 1, (1 << b) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(x.shape[1]):
            key = key << 1 | x[:, d] >> b & 1
    return key


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of whole numbers as rows, extended by zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(sizes), width), np.int64)
    flat = lists.values.to_numpy()[ends[0] : ends[-1]]
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)
    out[row[at < width], at[at < width]] = flat[at < width]
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, in the fastest type in which they are exact."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a.astype(float)).max(axis=0, initial=0) @ np.abs(b.astype(float)).max(axis=0, initial=0))
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**52 else np.int64
    return (a.astype(kind) @ b.T.astype(kind)).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of `a` with anything between low and high (a row per block)."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, n, total, squares) of each batch."""
    for batch in batches:
        x = matrix(batch.column("vec")).astype(float)
        if x.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(x.shape[1])), pa.array(np.full(x.shape[1], len(x))), pa.array(x.sum(axis=0)), pa.array((x * x).sum(axis=0))],
                names=["dim", "n", "total", "squares"],
            )


def _placer(dims: list[int], low: list[float], step: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), max(dims, default=0) + 1)[:, dims].astype(float)
            cells = np.clip((x - np.array(low)) / np.array(step), 0, (1 << BITS) - 1) if dims else np.zeros((len(x), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, BITS))], names=[*batch.schema.names, "place"])

    return run


def placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """Adds `place`, along the curve, to rows with `vec`; also the number of dimensions."""
    stats = rows.select("vec").mapInArrow(_profile, "dim long, n long, total double, squares double")
    # One row per dimension reaches the driver.
    stats = stats.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect()
    wide = []
    for s in stats:
        mean = s.total / s.n
        wide.append((max(s.squares / s.n - mean * mean, 0.0) ** 0.5, s.dim, mean))
    wide = sorted(wide, key=lambda w: (-w[0], w[1]))[:DIMS]
    dims = [d for _, d, _ in wide]
    low = [m - 3 * s for s, _, m in wide]
    step = [max(6 * s / (1 << BITS), 1e-9) for s, _, _ in wide]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_placer(dims, low, step), f"{kinds}, place long"), max((s.dim for s in stats), default=0) + 1


def ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Adds `rank`, the row's place (from 0) among all rows, numbered slice by slice."""
    cut = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    cut = cut.withColumn("_slice", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, that is per shuffle partition.
    sizes = cut.groupBy("_slice").agg(F.count("*").alias("_n")).select("_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    return cut.join(F.broadcast(sizes), "_slice").select(*rows.columns, (F.col("_before") + F.col("_at")).alias("rank"))


def _raw(x: np.ndarray) -> bytes:
    small = x.dtype == np.int64 and np.abs(x).max(initial=0) < 1 << 31
    return (b"4" if small else b"8") + x.astype("<i4" if small else "<i8").tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], "<i4" if data[:1] == b"4" else "<i8").astype(np.int64)


def _pack(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
    """One row for a block: members side by side, zone map of every dimension and of the label."""
    x = matrix(block.column("vec"))
    label, one = block.column("label").to_numpy(), np.array([key[0].as_py()])
    data = {"block": one}
    for c in ("id", "row", "label", "anchor"):
        data[f"{c}s"] = [_raw(block.column(c).to_numpy().astype(np.int64))]
    data |= {"vecs": [_raw(x.ravel())], "low": [x.min(axis=0).tolist()], "high": [x.max(axis=0).tolist()]}
    data |= {"label_low": label.min(keepdims=True), "label_high": label.max(keepdims=True)}
    return pa.table(data, schema=_BLOCK)


_BLOCK = pa.schema([
    ("block", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("labels", pa.binary()), ("anchors", pa.binary()), ("vecs", pa.binary()),
    ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())), ("label_low", pa.int64()), ("label_high", pa.int64()),
])
_BLOCK_SQL = (
    "block long, ids binary, rows binary, labels binary, anchors binary, vecs binary, low array<long>, high array<long>, label_low long, label_high long"
)


def _members(block: dict) -> tuple[np.ndarray, ...]:
    """ids, row numbers, labels and vectors of a packed block."""
    ids, rows, labels = (_numbers(block[c]) for c in ("ids", "rows", "labels"))
    return ids, rows, labels, _numbers(block["vecs"]).reshape(len(ids), -1)


def _starter(top: int):
    """Anchors of each block, with the top-th best score of their label in that block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids, rows, labels, x = _members(block)
                at = np.flatnonzero(_numbers(block["anchors"]))
                if not len(at):
                    continue
                score = product(x[at], x)
                score[(labels[at][:, None] != labels) | (at[:, None] == np.arange(len(ids)))] = LOW
                floor = np.sort(score, axis=1)[:, -top] if len(ids) >= top else np.full(len(at), LOW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (rows[at], ids[at], labels[at])] + [pa.array(x[at].tolist(), pa.list_(pa.int64())), pa.array(floor)],
                    names=["row", "id", "label", "vec", "floor"],
                )

    return run


def _sheet(key: tuple[pa.Scalar, ...], zones: pa.Table) -> pa.Table:
    low, high = matrix(zones.column("low")), matrix(zones.column("high"))
    columns = [[_raw(v)] for v in (*(zones.column(c).to_numpy() for c in ("block", "label_low", "label_high")), low.ravel(), high.ravel())]
    return pa.table([[key[0].as_py()], *columns], names=["sheet", "blocks", "label_low", "label_high", "low", "high"])


def _chooser(same: bool):
    """Blocks that can hold a hit, with the searches that must read them."""

    def run(key: tuple[pa.Scalar, ...], searches: pa.Table, sheets: pa.Table) -> pa.Table:
        blocks, need = [], []
        if searches.num_rows:
            a = matrix(searches.column("vec"))
            label, low, high, number = (searches.column(c).to_numpy() for c in ("label", "low", "high", "number"))
            for sheet in sheets.to_pylist():
                zone, first, last = (_numbers(sheet[c]) for c in ("blocks", "label_low", "label_high"))
                least, most = bounds(a, *(_numbers(sheet[c]).reshape(len(zone), -1) for c in ("low", "high")))
                may = (most >= low[:, None]) & (least <= high[:, None])
                other = label[:, None]
                may &= (first <= other) & (other <= last) if same else (first != other) | (last != other)
                for k in np.flatnonzero(may.any(axis=0)):
                    blocks.append(zone[k])
                    need.append(number[may[:, k]].tolist())
        chunk = np.full(len(blocks), key[0].as_py(), np.int64)
        return pa.table([pa.array(chunk), pa.array(blocks, pa.int64()), pa.array(need, pa.list_(pa.int64()))], names=["chunk", "block", "need"])

    return run


def _reader(same: bool, top: int):
    """The best hits of each search in one slice of blocks."""

    def run(key: tuple[pa.Scalar, ...], searches: pa.Table, blocks: pa.Table) -> pa.Table:
        number, row, label, low, high = (searches.column(c).to_numpy() for c in ("number", "row", "label", "low", "high"))
        low = low.copy()
        a = matrix(searches.column("vec"))
        best = np.empty((0, 4), np.int64)  # search, -score, id, row
        place = {n: k for k, n in enumerate(number.tolist())}
        for batch in blocks.to_batches(max_chunksize=1):
            block = batch.to_pylist()[0]
            ids, rows, labels, x = _members(block)
            at = np.array([place[n] for n in block["need"]], np.int64)
            _, first, back = np.unique(row[at], return_index=True, return_inverse=True)  # searches of one anchor share its scores
            score = product(a[at[first]], x)[back]
            hit = (score >= low[at, None]) & (score <= high[at, None])
            hit &= ((labels == label[at, None]) & (rows != row[at, None])) if same else labels != label[at, None]
            q, c = np.nonzero(hit)
            found = np.column_stack([at[q], -score[q, c], ids[c], rows[c]])
            best = np.concatenate([best, found])
            best = best[np.lexsort(best.T[::-1])]
            start = np.searchsorted(best[:, 0], best[:, 0])
            best = best[np.arange(len(best)) - start < top]
            who, count = np.unique(best[:, 0], return_counts=True)
            full = np.cumsum(count)[count == top] - 1
            low[who[count == top]] = np.maximum(low[who[count == top]], -best[full, 1])
        return pa.table([pa.array(number[best[:, 0]]), pa.array(-best[:, 1]), pa.array(best[:, 2]), pa.array(best[:, 3])], names=["number", "score", "hit", "hit_row"])

    return run


def search(searches: DataFrame, blocks: DataFrame, sheets: DataFrame, n_blocks: int, n_chunks: int, same: bool, top: int) -> DataFrame:
    """(number, score, hit, place) of the best `top` hits of each search.

    A search (chunk, number, row, label, vec, low, high) takes rows of the same label, itself not, or else of other
    labels, with low <= score <= high; best scores first, ties by smaller id.
    """
    count = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 1) - 1).cast("long")))
    # A stated set of searches against all zone sheets, chunk by sheet.
    asked = searches.withColumn("sheet", count(-(-n_blocks // SHEET))).groupBy("chunk", "sheet")
    shown = sheets.withColumn("chunk", count(n_chunks)).groupBy("chunk", "sheet")
    chosen = stored(asked.cogroup(shown).applyInArrow(_chooser(same), "chunk long, block long, need array<long>"), "chosen-blocks")
    part = F.expr(f"block div {SLICE}")
    read = chosen.join(blocks.drop("low", "high"), "block").withColumn("part", part).groupBy("chunk", "part")
    asked = searches.join(chosen.select("chunk", part.alias("part")).distinct(), "chunk").groupBy("chunk", "part")
    hits = asked.cogroup(read).applyInArrow(_reader(same, top), "number long, score long, hit long, hit_row long")
    best = Window.partitionBy("number").orderBy(F.desc("score"), "hit", "hit_row")
    return hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top).select("number", "score", "hit", "place")


def mine(rows: DataFrame, id_col: str, vec_col: str, label: Column, anchor: Column, scale: float = 256, share: int = 80, positives: int = 5,
         negatives: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x). A negative scores between `share` percent of the positive's score and that score.
    """
    vec = F.col(vec_col).cast("array<double>")
    sound = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = rows.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.when(sound, F.transform(vec, lambda x: F.floor(x * scale).cast("long"))).alias("vec"),
    ).where("vec IS NOT NULL AND label IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    curve, dims = placed(stored(clean, "vectors"))
    side = max(16, min(BLOCK, (1 << 16) // dims))
    numbered = ranked(curve, ["place", "id", "row"], "hilbert-order").withColumn("block", F.expr(f"rank div {side}"))
    blocks = stored(numbered.drop("rank", "place").groupBy("block").applyInArrow(_pack, _BLOCK_SQL), "blocks")
    n_blocks = blocks.count()
    sheets = blocks.select("block", "low", "high", "label_low", "label_high").withColumn("sheet", F.expr(f"block div {SHEET}"))
    sheets = stored(sheets.groupBy("sheet").applyInArrow(_sheet, "sheet long, blocks binary, label_low binary, label_high binary, low binary, high binary"), "zones")
    anchors = blocks.mapInArrow(_starter(positives), "row long, id long, label long, vec array<long>, floor long")
    anchors = stored(ranked(anchors.join(numbered.select("row", "rank").withColumnRenamed("rank", "at"), "row"), ["at"], "anchor-order"), "anchors")
    n_chunks = -(-anchors.count() // CHUNK)
    anchors = anchors.withColumn("chunk", F.expr(f"rank div {CHUNK}"))
    like = anchors.select("chunk", F.col("rank").alias("number"), "row", "label", "vec", F.col("floor").alias("low"), F.lit(HIGH).alias("high"))
    found = stored(search(like, blocks, sheets, n_blocks, n_chunks, True, positives), "positives")
    pairs = found.select(F.col("number").alias("rank"), F.col("score").alias("positive_score"), F.col("hit").alias("positive_id"), F.col("place").alias("which"))
    pairs = anchors.join(pairs, "rank").withColumn("number", F.col("rank") * positives + F.col("which"))
    least = F.expr(f"({share} * positive_score + pmod(-{share} * positive_score, 100)) div 100")
    pairs = stored(pairs.withColumn("low", least).withColumn("high", F.col("positive_score")), "windows")
    unlike = pairs.where("low <= high").select("chunk", "number", "row", "label", "vec", "low", "high")
    found = search(unlike, blocks, sheets, n_blocks, n_chunks, False, negatives)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return pairs.select("number", "id", "positive_id", "positive_score").join(found, "number").select(
        F.col("id").alias("anchor_id"), real("positive_id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        real("hit").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT * FROM (
  SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
) WHERE rank <= 5
"""


@query("op13_hard_negatives", SQL)
def op13_hard_negatives(spark, sf_dir):
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return mine(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.expr("vec_id % 100 = 0"))
