"""Near-duplicates by BagMinHash: signatures of shingle multisets, bands, exact multiset overlap, classes.

A document is the multiset of its five-word shingles (lower case, words are runs of letters, digits and underscore).
The signature treats each shingle as Poisson processes over its discretised weight, its count: the weight axis is halved
again and again into (0,1], (1,2], (2,4], (4,8] ..., every interval has a process seeded by (shingle, interval) whose
rate is the interval's length, and a point's level inside the interval is drawn with it, so the points below a count are
the same for every document. Each point falls into one of `bands * rows` components, which keep their first point. Two
documents agree in a component with a probability equal to their weighted Jaccard similarity. Points are drawn in
ascending order and a process ends as soon as it cannot lower any component.

1. Documents with the same word sequence collapse first (partial aggregation), so copies cost nothing later.
2. Bands of components are bucket keys. In each bucket every member is compared with one hub only, the member with the
   fullest buckets, which in a group of near copies is the most central text: no pairs inside a bucket are listed.
3. Pairs are verified by the exact multiset overlap of whole texts; links are joined to classes.
4. The exact way for the rest: where a bucket still holds several classes, each member outside its largest class is
   compared with all members of other classes: as pairs where these are few, in tiles of `tile` x `tile` documents of all
   crowded buckets with the same largest class, dealt over the cluster, where they are many. So no bucket is capped and no candidate pair between different classes is left.

At the defaults a pair of similarity 0.8 shares no band with probability 3e-6.

Defined cases: a null text counts as empty; a text without words is no near-duplicate of anything (a class of its own);
texts of one to four words have one shingle, all their words. Every row is a document of its own, whether its id is
repeated or null: classes are found over row numbers. The smallest id of a class names it, null if none has an id; one
row of a class is kept, that with the smallest id, one of them where several rows of the class have it or none has an id.
Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlink.llm.common import numbered, per_worker, ship, stored, table, without
from leadlink.llm.registry import query
from leadlink.operators.dedup import components

ship(__name__)

WORDS = 5
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _nth(k: int) -> np.uint64:
    return np.uint64(k * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF)


_WORD = re.compile(r"\w+")


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str) -> np.ndarray:
    known = per_worker("word hashes", _Words)
    found = _WORD.findall(text.lower())
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """A hash per shingle of `width` words; fewer words make one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = mixed(h * np.uint64(0x100000001B3) + words[k : k + n] + GOLDEN)
    return h


def expanded(text: str) -> np.ndarray:
    """The shingle multiset as a sorted set: the n-th occurrence of a shingle gets its own number."""
    one, count = np.unique(shingles(word_hashes(text)), return_counts=True)
    if len(one) and count.max() > 1:
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        one = np.sort(np.where(nth == 0, np.repeat(one, count), mixed(np.repeat(one, count) + nth.astype(np.uint64) * GOLDEN)))
    return one


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two expanded multisets."""
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def bag_minhash(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Signatures (documents x size) of weighted sets given as (distinct shingles, counts)."""
    best = np.full(len(sets) * size, np.inf)
    if not sets or not any(len(s) for s, _ in sets):
        return best.reshape(len(sets), size)
    shingle, weight = (np.concatenate(x) for x in zip(*sets, strict=True))
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    seed, level, rate, low, owner = [], [], [], [], []
    half, k = 0, 0
    while (inside := weight > half).any():  # interval (half, 2 * half], the first is (0, 1]
        seed.append(mixed(shingle[inside] + _nth(k + 1)))
        level.append(weight[inside])
        owner.append(doc[inside])
        n = int(inside.sum())
        rate.append(np.full(n, max(half, 1), np.float64))
        low.append(np.full(n, half))
        half, k = max(2 * half, 1), k + 1
    seed, level, rate, low, owner = (np.concatenate(x) for x in (seed, level, rate, low, owner))
    time = np.zeros(len(seed))
    slowest = np.full(len(sets), np.inf)
    step = 0
    while len(seed):
        step += 1
        first = mixed(seed + _nth(2 * step))
        second = mixed(first ^ GOLDEN)
        time += -np.log(((first >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        going = time < slowest[owner]
        if not going.all():
            seed, level, rate, low, owner, time, second = (x[going] for x in (seed, level, rate, low, owner, time, second))
        component = ((second & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        within = low + 1 + ((second >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rate).astype(np.int64)
        hit = within <= level
        np.minimum.at(best, owner[hit] * size + component[hit], time[hit])
        slowest = best.reshape(len(sets), size).max(axis=1)
    return best.reshape(len(sets), size)


def _signer(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                words = [word_hashes(t or "") for t in few.column("text").to_pylist()]
                sign = bag_minhash([np.unique(shingles(w), return_counts=True) for w in words], bands * rows).view(np.uint64)
                keys = np.full((len(words), bands), GOLDEN) * np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    keys = mixed(keys * np.uint64(0x100000001B3) + sign[:, r::rows])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel()))
                same = [xxhash.xxh3_128_digest(w.tobytes()) if len(w) else None for w in words]
                yield pa.RecordBatch.from_arrays([few.column("uid"), few.column("id"), pa.array(same, pa.binary()), lists], names=["uid", "id", "same", "keys"])

    return run


def _verifier(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = np.zeros(len(a), bool)
            for k, (ta, tb) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)):
                if hub != tb:
                    hub, hub_set = tb, expanded(tb)
                keep[k] = similarity(expanded(ta), hub_set) >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)[keep]), pa.array(np.array(b, np.int64)[keep])], names=["a", "b"])

    return run


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(_verifier(threshold), "a long, b long").distinct()


def _tiler(threshold: float):
    def run(tile: pa.Table) -> pa.Table:
        side, ids, comp = (tile.column(c).to_numpy() for c in ("side", "id", "comp"))
        sets = [expanded(t) for t in tile.column("text").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        right = np.flatnonzero(side == 1)
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        codes = np.split(codes, np.cumsum(sizes)[:-1])
        order = np.argsort(flat := np.concatenate([codes[k] for k in right]), kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(right)), sizes[right])[order]
        links = []
        for k in np.flatnonzero(side == 0):
            start, end = np.searchsorted(flat, codes[k]), np.searchsorted(flat, codes[k], side="right")
            n = end - start
            at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(right))
            good = (common / (sizes[k] + sizes[right] - common) >= threshold) & (comp[right] != comp[k])
            _, one = np.unique(comp[right][good], return_index=True)  # a link for each other class is enough
            links += [(ids[k], ids[r]) for r in right[good][one]]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _rest(members: DataFrame, texts: DataFrame, labels: DataFrame, threshold: float, few_pairs: int, tile: int) -> DataFrame:
    """Links between different classes that meet in a bucket."""
    m = members.select("key", "id").join(labels.withColumnRenamed("component", "comp"), "id")
    parts = m.groupBy("key", "comp").agg(F.count("*").alias("n"))
    largest = parts.groupBy("key").agg(
        F.sum("n").alias("all"), F.max("n").alias("most"), F.max(F.struct("n", (-F.col("comp")).alias("c"))).alias("top")
    ).where("all > most").select("key", "all", "most", (-F.col("top.c")).alias("main"))
    m = stored(m.join(largest, "key"), "mixed-buckets")
    few = F.col("all") * (F.col("all") - F.col("most")) <= few_pairs
    out = m.where(F.col("comp") != F.col("main"))
    pairs = (
        out.where(few).select("key", F.col("id").alias("a"), F.col("comp").alias("ca"), "main")
        .join(m.where(few).select("key", F.col("id").alias("b"), F.col("comp").alias("cb")), "key")
        .where("ca <> cb AND (cb = main OR a < b)").select("a", "b").distinct()
    )
    # Crowded buckets around one class have much the same members: each document enters its tiles once, not once a bucket.
    big = m.where(~few).select("main", "id", "comp").distinct()
    outside = F.col("comp") != F.col("main")
    cells = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(tile)).cast("int"))
    grid = big.groupBy("main").agg(cells(F.count_if(outside)).alias("rows"), cells(F.count("*")).alias("columns"))
    big = big.join(grid, "main")
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = big.where(outside).select("main", "id", "comp", F.lit(0).alias("side"), dealt("rows").alias("i"), spread("columns").alias("j"))
    right = big.select("main", "id", "comp", F.lit(1).alias("side"), spread("rows").alias("i"), dealt("columns").alias("j"))
    tiles = left.unionByName(right).join(texts, "id").groupBy("main", "i", "j").applyInArrow(_tiler(threshold), "a long, b long")
    return _linked(pairs, texts, threshold).unionByName(tiles.distinct())


def _classes(rows: DataFrame, threshold: float, bands: int, rows_of_band: int, few_pairs: int, tile: int) -> DataFrame:
    """(uid, id, cls, least, size, kept) for every row (uid, id, text) of a written table."""
    kind = rows.schema["id"].dataType.simpleString()
    texts = rows.select(F.col("uid").alias("id"), "text")
    sign = rows.mapInArrow(_signer(bands, rows_of_band), f"uid long, id {kind}, same binary, keys array<long>")
    signed = stored(sign, "signatures")
    reps = signed.where("same IS NOT NULL").groupBy("same").agg(F.min("uid").alias("rep"), F.first("keys").alias("keys"))
    keys = reps.select(F.col("rep").alias("id"), F.explode("keys").alias("key"))
    crowded = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(keys.join(crowded, "key"), "buckets")
    # How full the buckets of a document are says how central it is; the low bits only settle ties.
    central = members.groupBy("id").agg(F.sum("n").alias("n")).select(
        "id", (F.col("n") * 1048576 + F.pmod(F.xxhash64("id"), F.lit(1048576))).alias("rank")
    )
    hubs = members.join(central, "id").groupBy("key").agg(F.max_by("id", "rank").alias("hub"))
    pairs = members.join(hubs, "key").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    met = members.select("id").distinct()
    whole = stored(texts.join(met.hint("shuffle_hash"), "id", "left_semi"), "bucket-texts")
    links = stored(_linked(pairs, whole, threshold), "links")
    labels = stored(components(links, met), "labels")
    more = stored(_rest(members, whole, labels, threshold, few_pairs, tile), "more-links")
    links = links.unionByName(more)
    labels = components(links, met)
    class_of = reps.select("same", F.col("rep").alias("id")).join(labels, "id", "left").select("same", F.coalesce("component", "id").alias("cls"))
    named = stored(signed.select("uid", "id", "same").join(class_of, "same", "left").select("uid", "id", F.coalesce("cls", "uid").alias("cls")), "classes")
    first = F.coalesce(F.min_by("uid", "id"), F.min("uid"))
    sizes = stored(named.groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("size"), first.alias("stays")), "class-sizes")
    return named.join(sizes, "cls").select("uid", "id", "least", "size", (F.col("uid") == F.col("stays")).alias("kept"))


def classes(docs: DataFrame, threshold: float = 0.8, bands: int = 24, rows: int = 4, few_pairs: int = 64, tile: int = 256,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, class_size, kept) for every row."""
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _classes(stored(texts, "texts"), threshold, bands, rows, few_pairs, tile)
    return found.select(F.col("id").alias(id_col), F.col("least").alias("class_id"), F.col("size").alias("class_size"), "kept")


def remove(docs: DataFrame, threshold: float = 0.8, bands: int = 24, rows: int = 4, few_pairs: int = 64, tile: int = 256,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all its columns."""
    whole = numbered(docs, "documents")
    texts = whole.select("uid", F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"))
    found = _classes(texts, threshold, bands, rows, few_pairs, tile)
    return without(whole, stored(found.where(~F.col("kept")).select("uid"), "gone"))


@query("op2_near_dedup")
def op2_near_dedup(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"))
