"""LCS, similarity join, deduplication modes against brute force."""

import random
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadlink.functions import similarity as S
from leadlink.operators import dedup, simjoin


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ABé ", max_size=80), st.text("ABé ", max_size=150)), min_size=1, max_size=5))
def test_lcs_matches_table(pairs):
    got = S.lcs_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert list(got) == [table_lcs(a, b) for a, b in pairs]


def test_udf_and_builtin_agree(spark):
    rng = random.Random(1)
    pairs = [("", ""), ("AB", "BA"), ("A", "")] + [
        ("".join(rng.choices("ABC é", k=rng.randint(0, 9))), "".join(rng.choices("ABC é", k=rng.randint(0, 9)))) for _ in range(80)
    ]
    a, b = F.col("a"), F.col("b")
    rows = spark.createDataFrame(pairs, "a string, b string").select(S.ratio(a, b).alias("u"), S.ratio_sql(a, b).alias("s")).collect()
    assert all(r.u == r.s for r in rows)
    assert [r.u for r in rows[:3]] == [100.0, 50.0, 0.0]


def near(rng, word):
    out = list(word)
    for _ in range(rng.randint(0, 4)):
        if out and rng.random() < 0.5:
            out.pop(rng.randrange(len(out)))
        else:
            out.insert(rng.randint(0, len(out)), rng.choice("ABCDE é"))
    return "".join(out)


def fixture_names(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choices("ABCDEFGHIJ é", k=rng.choice([1, 2, 3, 5, 8, 12, 20, 30, 45, 70]))) for _ in range(n // 8)]
    return rng, sorted({near(rng, rng.choice(base)) for _ in range(n)} - {""})


def similar(x, y, t):
    return 200 * table_lcs(x, y) >= t * (len(x) + len(y))


@pytest.mark.parametrize("threshold", [70, 85, 90])
def test_join_finds_every_pair_once(spark, threshold):
    rng, names = fixture_names(threshold, 220)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", ""]), n) for n in names]
    want = {
        (b, *sorted((x, y))) for (b, x), (c, y) in combinations(rows, 2) if b and b == c and similar(x, y, threshold)
    }
    got = [(r.block, *sorted((r.name_a, r.name_b))) for r in simjoin.similar_within(spark.createDataFrame(rows * 2, "block string, name string"), threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    left, right = rows[: len(rows) // 2], rows[len(rows) // 3 :]
    want = {(b, x, y) for b, x in left for c, y in right if b and b == c and similar(x, y, threshold)}
    got = [
        (r.block, r.name_a, r.name_b)
        for r in simjoin.similar_between(
            spark.createDataFrame(left, "block string, name string"), spark.createDataFrame(right, "block string, name string"), threshold
        ).collect()
    ]
    assert len(got) == len(set(got)) and set(got) == want


def test_letter_bound_holds():
    """The counts of similar names are never further apart than the join allows, in all classes and in some group."""
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choices("AB éÉ7", k=rng.randint(1, 30)))
        b = near(rng, a)
        for t in (70, 85, 90):
            if not b or not similar(a, b, t):
                continue
            apart = abs(simjoin.letter_counts([a])[0] - simjoin.letter_counts([b])[0])
            scheme = simjoin.scheme_of(len(a), len(b), t)
            assert apart.sum() <= simjoin.allowed(len(a), len(b), t)
            group = simjoin.deal([float(k) for k in range(simjoin.CLASSES)], scheme)
            assert min(apart[group == g].sum() for g in range(scheme)) <= 2
            assert scheme in simjoin.schemes(len(a), t) and scheme in simjoin.schemes(len(b), t)


@pytest.mark.parametrize("threshold", [70, 90])
def test_very_long_names(spark, threshold):
    """Names so long that no group of classes is as near as two, and one that repeats a letter 70,000 times."""
    rng = random.Random(9)
    base = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ ", k=n)) for n in (300, 700, 1200)]
    names = {near(rng, near(rng, x)) for x in base for _ in range(4)} | set(base)
    names |= {"".join(c for c in x if rng.random() > p) for x in base for p in (0.1, 0.3, 0.5)}
    rows = [("b", n) for n in sorted(names)]
    want = {tuple(sorted((x, y))) for (_, x), (_, y) in combinations(rows, 2) if 200 * S._lcs_long(x, y) >= threshold * (len(x) + len(y))}
    assert any(simjoin.scheme_of(len(x), len(y), threshold) >= simjoin.WIDE for x, y in want) or threshold > 70
    got = [tuple(sorted((r.name_a, r.name_b))) for r in simjoin.similar_within(spark.createDataFrame([*rows, ("b", "A" * 70_000)], "block string, name string"), threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_join_grows_with_its_output(spark):
    """10,000 distinct names of few words in one block: what meets stays near the pairs, far from the pairs of the block."""
    rng = random.Random(6)
    words = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=rng.randint(3, 8))) for _ in range(60)]
    names = set()
    while len(names) < 10_000:
        name = " ".join(sorted([str(rng.randint(1, 25)), *rng.sample(words, 4)]))
        names |= {name, near(rng, name)}
    frame = spark.createDataFrame([("b", n) for n in sorted(names)], "block string, name string").repartition(8).cache()
    met = simjoin.candidates_within(frame, 90, simjoin.letter_weights(frame))
    n, pairs = met.count(), simjoin.similar_within(frame, 90, distinct=True).count()
    assert pairs > 1000 and n <= 5 * pairs + len(names)


def pair_loop(rows, threshold):
    """The arrival-order loop: rows are (ord, block, name, score)."""
    gone = {}
    blocks = {}
    for r in sorted(rows):
        if r[1]:
            blocks.setdefault(r[1], []).append(r)
    for block in blocks.values():
        for i, a in enumerate(block):
            if a[0] in gone:
                continue
            for b in block[i + 1 :]:
                if b[0] in gone or not similar(a[2], b[2], threshold):
                    continue
                if a[3] <= b[3]:
                    gone[b[0]] = a[0]
                else:
                    gone.setdefault(a[0], b[0])
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_sequential_mode_is_the_pair_loop(spark, seed):
    rng, names = fixture_names(seed, 90)
    names = [n for n in names if len(n) > 2]
    rows = [(i, rng.choice(["hot", "hot", "cold", ""]), rng.choice(names), rng.randint(0, 3)) for i in range(160)]
    df = spark.createDataFrame(rows, "ord bigint, block string, name_key string, s int")
    got = {r.ord: r.kept_ord for r in dedup.sequential(df, F.col("s"), 85).collect()}
    want = pair_loop(rows, 85)
    assert got == {r[0]: want.get(r[0]) for r in rows}


def test_removed_row_still_absorbs(spark):
    """j falls to k, then a later row similar to j only is absorbed by j."""
    rows = [(0, "b", "AAAAAAAAAB", 2), (1, "b", "AAAAAAAAABCC", 1), (2, "b", "ZAAAAAAAAAB", 2)]
    df = spark.createDataFrame(rows, "ord bigint, block string, name_key string, s int")
    assert {r.ord: r.kept_ord for r in dedup.sequential(df, F.col("s"), 90).collect()} == {0: 1, 1: None, 2: 0}


def test_dominance_against_brute_force(spark):
    rng, names = fixture_names(9, 90)
    rows = [(i, rng.choice(["hot", "hot", "cold", ""]), rng.choice([*names, ""]), rng.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "ord bigint, block string, name_key string, s int")
    got = {r.ord: r.kept_ord for r in dedup.dominance(df, [F.col("s").alias("s")], 85).collect()}
    for o, b, n, s in rows:
        better = [(s2, o2) for o2, b2, n2, s2 in rows if b and b2 == b and (s2, o2) < (s, o) and (n2 == n or (n and n2 and similar(n, n2, 85)))]
        assert got[o] == (min(better)[1] if better else None)


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randint(50, 120), rng.randint(50, 120)) for _ in range(50)]
    parent = {i: i for i in range(130)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    e = spark.createDataFrame(edges, "a bigint, b bigint")
    n = spark.createDataFrame([(i,) for i in range(130)], "id bigint")
    assert {r.id: r.component for r in dedup.components(e, n).collect()} == {i: find(i) for i in range(130)}


def test_leader_rounds_give_the_same_answer(spark, monkeypatch):
    """Several rounds of leaders, as large blocks need, against brute force."""
    monkeypatch.setattr(dedup, "FIRST_LEADERS", 3)
    monkeypatch.setattr(dedup, "LEADER_GROWTH", 4)
    rng, names = fixture_names(21, 120)
    rows = [(i, rng.choice(["hot", "hot", "hot", "cold"]), rng.choice(names), rng.randint(0, 2)) for i in range(150)]
    df = spark.createDataFrame(rows, "ord bigint, block string, name_key string, s int")
    got = {r.ord: r.kept_ord for r in dedup.dominance(df, [F.col("s").alias("s")], 85).collect()}
    for o, b, n, s in rows:
        better = [(s2, o2) for o2, b2, n2, s2 in rows if b2 == b and (s2, o2) < (s, o) and similar(n, n2, 85)]
        assert got[o] == (min(better)[1] if better else None)


@pytest.mark.parametrize("seed", [3, 4])
def test_survivors_are_one_pass_in_rank_order(spark, seed):
    rng, names = fixture_names(seed, 160)
    rows = [(k, rng.choice(["b1", "b1", "b2", ""]), rng.choice(names), rng.randint(0, 3)) for k in range(220)]
    df = spark.createDataFrame(rows, "ord long, block string, name_key string, s int")
    got = {r.ord: r.kept_ord for r in dedup.survivors(df, [F.col("s")], 85).collect()}
    staying, want = [], {r[0]: None for r in rows}
    for o, block, name, _ in sorted((r for r in rows if r[1]), key=lambda r: (r[3], r[0])):
        hit = next((x for x, b, n in staying if b == block and (n == name or similar(n, name, 85))), None)
        want[o] = hit
        if hit is None:
            staying.append((o, block, name))
    assert got == want
    assert all(want[k] is None for k in want.values() if k is not None)  # whoever absorbs stays


def test_survivors_in_slices_compare_only_what_is_undecided(spark, monkeypatch):
    """A dense block in several slices: right against one pass, and never are all its names compared with each other."""
    monkeypatch.setattr(dedup, "FIRST_SLICE", 4)
    monkeypatch.setattr(dedup, "SLICE_GROWTH", 3)
    within, sizes = dedup.similar_within, []
    monkeypatch.setattr(dedup, "similar_within", lambda names, *a, **k: sizes.append(names.count()) or within(names, *a, **k))
    rng = random.Random(5)
    rows = [(k, "hot", f"customer 0000{rng.randint(0, 399):05d}", rng.randint(0, 9)) for k in range(120)] + [(120, "hot", "", 0), (121, "cold", "customer 000000001", 0)]
    df = spark.createDataFrame(rows, "ord long, block string, name_key string, s int")
    got = {r.ord: r.kept_ord for r in dedup.survivors(df, [F.col("s")], 90).collect()}
    staying, want = [], {}
    for o, block, name, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        want[o] = next((x for x, b, n in staying if b == block and (n == name or (n and name and similar(n, name, 90)))), None)
        if want[o] is None:
            staying.append((o, block, name))
    assert got == want
    assert len(sizes) > 2 and max(sizes) < len({n for _, _, n, _ in rows}) / 2


def by_rank(nodes, edges):
    """One pass in rank order; a smaller id is better."""
    better, stay = {}, set()
    for w, b in edges:
        better.setdefault(w, set()).add(b)
    for n in sorted(nodes):
        if not better.get(n, set()) & stay:
            stay.add(n)
    return stay


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_staying_nodes_of_any_graph(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(400))
    edges = {(max(a, b), min(a, b)) for a, b in ((rng.randrange(400), rng.randrange(400)) for _ in range(rng.choice([100, 400, 1500]))) if a != b}
    edges |= {(k + 1, k) for k in range(200, 300)} | {(k + 2, k) for k in range(250, 280)}
    got = dedup.staying(spark.createDataFrame([(n,) for n in nodes], "id long"), spark.createDataFrame(sorted(edges), "worse long, better long")).collect()
    assert len(got) == len({r.id for r in got}) and {r.id for r in got} == by_rank(nodes, edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """5,000 nodes, each better than the next: every other one stays, in fewer than 20 rounds of two written tables."""
    n, cuts, keep = 5000, [], dedup.written
    monkeypatch.setattr(dedup, "written", lambda df: (cuts.append(1), keep(df))[1])
    edges = spark.range(n - 1).select((F.col("id") + 1).alias("worse"), F.col("id").alias("better"))
    got = {r.id for r in dedup.staying(spark.range(n), edges).collect()}
    assert got == set(range(0, n, 2)) and len(cuts) < 2 * 20


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_of_names_are_never_broadcast(spark, tmp_path):
    # Written, so that the names' size is known and small, as that of a compressed table is.
    spark.createDataFrame([("b", f"NAME {k}") for k in range(50)], "block string, name string").write.parquet(f"{tmp_path}/names")
    names = spark.read.parquet(f"{tmp_path}/names")
    weights = simjoin.letter_weights(names)
    assert "BroadcastHashJoin" not in plan_of(simjoin.candidates_within(names, 90, weights))
    assert "BroadcastHashJoin" not in plan_of(simjoin.similar_between(names, names, 90, distinct=True, weights=weights))


def test_deduplication_broadcasts_no_names_or_ids(spark, tmp_path):
    spark.createDataFrame([(k, "b", f"NAME {k}", k % 3) for k in range(50)], "ord long, block string, name_key string, weight int").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    for judged in (
        dedup.similarity_components(rows, 90), dedup.sequential(rows, F.col("weight"), 90),
        dedup.survivors(rows, [F.col("weight")], 90), dedup.dominance(rows, [F.col("weight")], 90),
    ):
        assert "BroadcastHashJoin" not in plan_of(judged)
