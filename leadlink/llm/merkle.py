"""Merkle manifest of a dataset: one root over all rows, and for each row the proof that it belongs to that root.

A row's leaf is a hash of its fields. In each group, leaves in order become a tree of width 16; the groups' subroots, in
order, become a tree likewise. A level with one node is the top; else every 16 neighbours, the last run with what is
left, become the hash of their digests.

1. Rows are range-partitioned by (group, order) and numbered slice by slice, so a group of any size is numbered by many
   tasks. Only digests are shuffled, no texts.
2. The rank in a group is split into two digits of base 16 and the block of 256 ranks above them. Within a block the
   low digit is grouped away, then the high digit: a block becomes one row that nests its runs, which nest their nodes.
   The blocks' digests are the nodes of the next pass, until each group has one block. A row never nests more than 256.
3. On the way down each block meets the path above it in one grouping of both (union, no join); a transform adds each
   node's siblings to the path and an explode hands it to the block below, or emits the row with its proof.

Built-in functions only. Defined cases: a null field is hashed as `-`; rows without a group form a group, ordered first;
rows without an order value come first in theirs; equal order values are ordered by leaf, so repeated rows have a place
each; an empty table gives an empty result. Only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlink.llm.common import stored, table
from leadlink.llm.registry import query

#: Children of a node, and hex digits of a digest. The proof format is fixed by both.
WIDTH, HEX = 16, 64


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 (lower-case hex) of the fields, each as byte count, colon, value, or a hyphen if null."""
    coded = [F.concat(F.octet_length(s).cast("string"), F.lit(":"), s) for s in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*[F.coalesce(c, F.lit("-")) for c in coded]), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds `rank`, the row's place (from 0) among the rows with its key."""
    ordered = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_row")
    placed = stored(ordered.withColumn("_slice", F.spark_partition_id()), "ranked")
    sizes = placed.groupBy(key, "_slice").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A slice can go on with at most one key of the slices before it, so this has no more rows than there are slices.
    shifted = sizes.withColumn("_before", F.sum("_n").over(ahead)).where("_before > 0")
    shifted = shifted.select(F.col(key).alias("_key"), F.col("_slice").alias("_at"), "_before")
    inside = F.row_number().over(Window.partitionBy("_slice", key).orderBy(*order, "_row")) - 1
    same = (F.col("_slice") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key"))
    out = placed.withColumn("_i", inside).join(F.broadcast(shifted), same, "left")
    return out.select(*rows.columns, (F.col("_i") + F.coalesce("_before", F.lit(0))).cast("long").alias("rank"))


def _whole_level(place: Column | int, members: Column) -> Column:
    """Is this run the only node of its level, so that nothing is hashed?"""
    return (F.col("block") == 0) & (F.lit(place) == 0) & (F.size(members) == 1)


def _blocks(nodes: DataFrame) -> DataFrame:
    """(key, block, node, runs) of nodes (key, rank, node, item): two digits grouped away, children nested."""
    digits = nodes.select(
        "key", "item", "node", F.expr(f"rank div {WIDTH * WIDTH}").alias("block"),
        F.expr(f"rank div {WIDTH} % {WIDTH}").cast("int").alias("high"), F.expr(f"rank % {WIDTH}").cast("int").alias("low"),
    ).repartition("key", "block")
    runs = digits.groupBy("key", "block", "high").agg(F.sort_array(F.collect_list(F.struct("low", "node", "item"))).alias("kids"))
    joined = F.array_join("kids.node", "")
    runs = runs.withColumn("node", F.when(_whole_level(F.col("high"), F.col("kids")), joined).otherwise(F.sha2(joined, 256)))
    blocks = runs.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("high", "node", "kids"))).alias("runs"))
    joined = F.array_join("runs.node", "")
    return blocks.withColumn("node", F.when(_whole_level(0, F.col("runs")), joined).otherwise(F.sha2(joined, 256)))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of each pass, the lowest first; the last has one block for each key."""
    passes = []
    while True:
        passes.append(stored(_blocks(nodes), "blocks"))
        if not passes[-1].agg(F.max("block")).first()[0]:
            return passes
        nodes = passes[-1].select("key", F.col("block").alias("rank"), "node", F.lit(None).cast("int").alias("item"))


def _siblings(digits: Column, place: Column) -> Column:
    """The other digests of a run, those to the left and those to the right."""
    return F.struct(
        F.substr(digits, F.lit(1), place * HEX).alias("left"), F.substr(digits, place * HEX + HEX + 1, F.lit(WIDTH * HEX)).alias("right")
    )


def _descend(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """(key, item, node, path, top) of the lowest nodes; `above` has (key, path, top) of each key."""
    steps = "array<struct<left:string,right:string>>"
    above = above.withColumn("rank", F.lit(0).cast("long"))
    for blocks in reversed(passes):
        down = above.select("key", F.col("rank").alias("block"), "path", "top").withColumn("runs", F.lit(None).cast(blocks.schema["runs"].dataType))
        up = blocks.select("key", "block", F.lit(None).cast(steps).alias("path"), F.lit(None).cast(above.schema["top"].dataType).alias("top"), "runs")
        met = down.unionByName(up).groupBy("key", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("path", "top", "runs")])
        met = met.withColumn("digests", F.array_join("runs.node", "")).withColumn("whole", _whole_level(0, F.col("runs")))
        runs = met.select("key", "block", "path", "top", "digests", "whole", F.explode("runs").alias("run"))
        own = lambda place: F.array(_siblings(F.col("digests"), place))
        runs = runs.select(
            "key", "block", "top", F.col("run.high").alias("high"), F.col("run.kids").alias("kids"),
            F.when(F.col("whole"), F.col("path")).otherwise(F.concat(own(F.col("run.high")), "path")).alias("path"),
        ).withColumn("digests", F.array_join("kids.node", "")).withColumn("whole", _whole_level(F.col("high"), F.col("kids")))
        proof = lambda k: F.when(F.col("whole"), F.col("path")).otherwise(F.concat(own(k["low"]), F.col("path")))  # noqa: E731, B023
        nodes = F.transform("kids", lambda k: F.struct(k["low"].alias("low"), k["node"].alias("node"), k["item"].alias("item"), proof(k).alias("path")))  # noqa: B023
        out = runs.select("key", "block", "high", "top", F.explode(nodes).alias("k"))
        rank = F.col("block") * (WIDTH * WIDTH) + F.col("high") * WIDTH + F.col("k.low")
        above = out.select("key", rank.alias("rank"), "k.item", "k.node", "k.path", "top")
    return above


def manifest(rows: DataFrame, group: str, order: str, leaf: str) -> DataFrame:
    """All columns of `rows` with `subroot`, `root` and `path`, the siblings (left, right) of each level up to the root."""
    item = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rows.columns)])
    leaves = rows.select(F.col(group).alias("key"), F.col(order).alias("_order"), F.col(leaf).alias("node"), item.alias("item"))
    leaves = stored(leaves, "leaves")  # so that sampling for the ranges hashes no row again
    passes = _climb(numbered(leaves, "key", ["_order", "node"]))
    subroots = passes[-1].select(F.lit(0).alias("key"), F.col("key").alias("item"), "node")
    tops = _climb(numbered(subroots, "key", ["item"]))
    steps = F.array().cast("array<struct<left:string,right:string>>")
    root = tops[-1].select("key", steps.alias("path"), F.col("node").alias("top"))
    paths = _descend(tops, root).select(F.col("item").alias("key"), "path", F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top"))
    out = _descend(passes, paths)
    return out.select(*[F.col(f"item.c{k}").alias(c) for k, c in enumerate(rows.columns)], "top.subroot", "top.root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: F.array(step["left"], step["right"]))), ""), 256)


def _sql(levels: int = 6, group_levels: int = 5) -> str:
    """Level by level, for up to 16^levels rows a group and 16^group_levels groups."""
    crc = (  # bitwise CRC-32 over the digits; a step of -1 shifts one bit
        "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) "
        "ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"
    )
    code = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(code(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    out = [
        f"d AS (SELECT doc_id, coalesce('s' || source, '') AS g, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS claimed FROM documents)",
        "n0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, "
        "leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM d)",
        "f0 AS (SELECT doc_id, g, leaf, r, claimed AS fold, '' AS proof FROM n0)",
    ]

    def level(n, s, f, k, key):
        parts = f"substr(s, 1, 64 * (f.r % {WIDTH})::BIGINT)", f"substr(s, 64 * (f.r % {WIDTH})::BIGINT + 65)"
        out.append(f"{s}{k} AS (SELECT {key}, r // {WIDTH} AS q, string_agg(node, '' ORDER BY r) AS s, max(n) AS n FROM {n}{k} GROUP BY {key}, r // {WIDTH})")
        out.append(f"{n}{k + 1} AS (SELECT {key}, q AS r, CASE WHEN n = 1 THEN s ELSE sha256(s) END AS node, CASE WHEN n = 1 THEN 1 ELSE (n + {WIDTH - 1}) // {WIDTH} END AS n FROM {s}{k})")
        out.append(
            f"{f}{k + 1} AS (SELECT f.* EXCLUDE (r, fold, proof), f.r // {WIDTH} AS r, proof || {parts[0]} || {parts[1]} AS proof, "
            f"CASE WHEN n = 1 THEN fold ELSE sha256({parts[0]} || fold || {parts[1]}) END AS fold "
            f"FROM {f}{k} f JOIN {s}{k} s ON f.{key} = s.{key} AND f.r // {WIDTH} = s.q)"
        )

    for k in range(levels):
        level("n", "s", "f", k, "g")
    out.append(f"m0 AS (SELECT 0 AS z, g, node, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM n{levels})")
    out.append(f"e0 AS (SELECT doc_id, leaf, 0 AS z, m.node AS subroot, m.r, f.fold, f.proof FROM f{levels} f JOIN m0 m ON f.g = m.g)")
    for k in range(group_levels):
        level("m", "t", "e", k, "z")
    return (
        "WITH " + ",\n".join(out) + f"\nSELECT e.doc_id, e.leaf, e.subroot, m.node AS root, sha256(e.proof) AS proof_sha256, e.fold AS folded_root, "
        f"e.fold = m.node AS verified FROM e{group_levels} e JOIN m{group_levels} m ON e.z = m.z"
    )


@query("op12_merkle_manifest", _sql())
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text", leaf_hash(*fields, F.col("text")).alias("leaf"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    claimed = F.when(tampered, leaf_hash(*fields, ascii_lower(F.col("text")))).otherwise(F.col("leaf"))
    proofs = manifest(rows.select("doc_id", "source", "leaf", claimed.alias("claimed")), "source", "doc_id", "leaf")
    checked = proofs.withColumn("folded_root", folded(F.col("claimed"), F.col("path")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
