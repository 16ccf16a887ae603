import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from leadlink.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    row = list(row)
    if lower and row[4] is not None:
        row[4] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level):
    """Root, and for each node its siblings (left, right) level by level."""
    proofs, place = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, at in enumerate(place):
            run = level[at // 16 * 16 : at // 16 * 16 + 16]
            proofs[k].append((run[: at % 16], run[at % 16 + 1 :]))
        level = [H(*level[k : k + 16]) for k in range(0, len(level), 16)]
        place = [p // 16 for p in place]
    return level[0], proofs


def expected(rows):
    nulls_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0)
    groups = {}
    for r in sorted(rows, key=lambda r: (nulls_first(r[0]), leaf(r))):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=nulls_first)
    trees = [climb([leaf(r) for r in groups[g]]) for g in names]
    root, tops = climb([t[0] for t in trees]) if trees else ("", [])
    out = []
    for g, (subroot, proofs), top in zip(names, trees, tops):
        for r, proof in zip(groups[g], proofs):
            path = [*proof, *top]
            node = leaf(r, lower=r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for left, right in path:
                node = H(*left, node, *right)
            out.append((r[0], leaf(r), subroot, root, H(*[d for p in path for side in p for d in side]), node, node == root))
    return sorted(out, key=repr)


def documents(spark, tmp_path, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame([tuple(r) for r in rows], schema)
    # Names that the operator uses inside itself.
    for c in ("key", "node", "item", "rank", "path", "top", "block", "_row", "_slice", "leaf", "root"):
        frame = frame.withColumn(c, F.lit("x"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def rows_of(sizes):
    k, out = 0, []
    for source, n in sizes:
        for _ in range(n):
            out.append((k, source, None if k % 7 == 0 else "en", None if k % 5 == 0 else k, None if k % 11 == 0 else f"Text No {k} Élan"))
            k += 1
    return out


CASES = {
    "empty": [],
    "one row": rows_of([("a", 1)]),
    "a run of one at the end": rows_of([("a", 17), ("b", 16), ("c", 1)]),
    "whole blocks": rows_of([("a", 256), ("b", 257), ("é", 2)]),
    "several passes": rows_of([(None, 300), ("big", 4100), ("", 1)]),
    "many groups": rows_of([(f"s{k}", 1 + k % 3) for k in range(300)]),
    "nulls, ties, repeats": [(None, None, None, None, None)] * 20 + [(1, "a", "en", 3, "ABC")] * 40 + [(1, "a", "en", 3, "ABD"), (2, "a", "", 0, ""), (None, "a", "en", 1, "x" * 300_000)],
    "negative ids": [(-k, "a", "en", k, f"T{k}") for k in range(40)],
}


@pytest.mark.parametrize("case", CASES)
def test_manifest_equals_tree_by_hand(spark, tmp_path, case):
    got = merkle.op12_merkle_manifest(spark, documents(spark, tmp_path, CASES[case])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(CASES[case])


def test_hot_group_is_numbered_by_many_tasks(spark):
    rows = spark.range(0, 50_000, 1, 8).select((F.col("id") * 7919 % 50_021).alias("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = merkle.numbered(rows, "g", ["id"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen = {}
    for r in sorted(numbered, key=lambda r: r["id"]):
        assert r["rank"] == seen.get(r["g"], 0)
        seen[r["g"]] = r["rank"] + 1


def test_proofs_verify_and_tampering_shows(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), merkle.leaf_hash(F.col("id")).alias("leaf"))
    proofs = merkle.manifest(rows, "g", "id", "leaf")
    good, bad = merkle.folded(F.col("leaf"), F.col("path")), merkle.folded(merkle.leaf_hash(F.col("id") + 1), F.col("path"))
    assert proofs.where((good == F.col("root")) & (bad != F.col("root"))).count() == 1000


def test_no_join_on_the_way_to_the_proofs(spark):
    rows = spark.range(300).select("id", F.lit("a").alias("g"), merkle.leaf_hash(F.col("id")).alias("leaf"))
    assert "Join" not in merkle.manifest(rows, "g", "id", "leaf")._jdf.queryExecution().optimizedPlan().toString()
