"""Fuzzy deduplication inside blocks: phone + name, and department + name.

Four declared modes, all built on the exact similarity join:

* survivors: a row goes when a better-ranked row of its block that stays has a similar name, the default of the lead job;
* dominance: a row goes when any better-ranked row of its block has a similar name, whether that one stays or not;
* sequential: the arrival-order pair loop (a row that was removed during its own turn
  still removes later ones), with ranks fixed at the start of the stage;
* components: similar rows form connected components, each merged into its best row.

Copies of a name inside a block are collapsed before names are compared, so a block or
a group of copies holding a third of the rows costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlink.functions import text as T
from leadlink.operators.keyed import number_within
from leadlink.operators.simjoin import letter_weights, similar_between, similar_within
from leadlink.session import cut, sorted_side, spread, written

PHONE_THRESHOLD = 70
NAME_THRESHOLD = 90


def with_phone_block(leads: DataFrame) -> DataFrame:
    return leads.withColumn("block", T.phone_nine(F.col("phone"))).withColumn(
        "name_key", T.token_sort(T.clean_name_link(F.col("name")))
    )


def with_department_block(leads: DataFrame) -> DataFrame:
    return leads.withColumn("block", T.department(T.normalize_cp(F.col("cp")))).withColumn(
        "name_key", T.token_sort(T.clean_name_link(F.col("name")))
    )


def _names(rows: DataFrame) -> DataFrame:
    return rows.select("block", F.col("name_key").alias("name"))


FIRST_LEADERS, LEADER_GROWTH = 256, 16


def dominance(rows: DataFrame, rank: list[Column], threshold: int) -> DataFrame:
    """Rows with `kept_ord`, `sim`: null where the row stays, else its best dominator.

    `rows` has block, name_key, ord. Per (block, name) only the best row can dominate.
    Names meet the leaders of their block in rank order, a first few, then ever larger
    slices; a name leaves as soon as it meets a similar leader, because every later one
    ranks worse. A dense group of near copies so costs a few comparisons per name, not all
    pairs, and the answer is still exact.
    """
    rows = rows.withColumn("_rank", F.struct(*rank, F.col("ord").alias("ord")))
    reps = rows.where(F.col("block") != "").groupBy("block", "name_key").agg(F.min("_rank").alias("_best"))
    reps = cut(spread(number_within(reps, ["block"], ["_best"]).withColumnRenamed("name_key", "name")))
    weights = letter_weights(reps.select("block", "name"))
    largest = reps.agg(F.max("i")).first()[0] or 0
    own = reps.select("block", "name", F.struct(F.col("_best").alias("_rank"), F.lit(100.0).alias("sim")).alias("d"))
    undecided, low, high = reps.where("i > 1"), 0, FIRST_LEADERS
    leaders = own
    while low < largest:
        head = reps.where((F.col("i") > low) & (F.col("i") <= high))
        pairs = similar_between(undecided, head, threshold, distinct=True, weights=weights).where("name_a <> name_b")
        met = (
            pairs.join(sorted_side(head.select("block", F.col("name").alias("name_b"), F.col("_best").alias("_rank"), F.col("i").alias("_j"))), ["block", "name_b"])
            .join(sorted_side(undecided.select("block", F.col("name").alias("name_a"), "i")), ["block", "name_a"])
            .where("_j < i")
            .groupBy("block", F.col("name_a").alias("name"))
            .agg(F.min(F.struct("_rank", "sim")).alias("d"))
        )
        if high < largest:
            met = cut(met)
            undecided = cut(spread(undecided.where(F.col("i") > high).join(met, ["block", "name"], "left_anti")))
        leaders = leaders.unionByName(met)
        low, high = high, high * LEADER_GROWTH
    leader = leaders.groupBy("block", F.col("name").alias("name_key")).agg(F.min("d").alias("d"))
    beaten = F.col("d._rank") < F.col("_rank")
    return rows.join(sorted_side(leader), ["block", "name_key"], "left").select(
        *[c for c in rows.columns if c != "_rank"],
        F.when(beaten, F.col("d._rank.ord")).alias("kept_ord"),
        F.when(beaten, F.col("d.sim")).alias("sim"),
    )


def staying(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids of nodes (id) that stay when a node goes as soon as one better neighbour (worse, better) stays; no circles.

    A node goes if one of its literals is true; a literal is "the better node stays", or flipped, "the better node goes".
    In each round

    * a node without literals stays, one with a literal and its opposite goes, and both settle literals about them;
    * a node with a single literal is its opposite, so literals about that node become literals about the node behind it.

    The last step halves chains, so the rounds follow the logarithm of the longest chain, not its length.
    """
    left = edges.groupBy("worse", "better").agg(F.lit(True).alias("plain"), F.lit(False).alias("flip"))
    known = nodes.select("id").join(edges.select(F.col("worse").alias("id")).distinct(), "id", "left_anti").withColumn("stays", F.lit(True))
    known = written(known)
    stay = known.select("id")
    while True:
        met = written(left.join(sorted_side(known.withColumnRenamed("id", "better")), "better", "left"))
        true = F.when(F.col("plain") & F.col("flip"), True).otherwise(F.col("stays") == F.col("plain"))
        fate = written(met.groupBy("worse").agg(F.coalesce(F.max(true), F.lit(False)).alias("goes"), F.count_if(F.col("stays").isNull()).alias("open")))
        settled = F.col("goes") | (F.col("open") == 0)
        known = fate.where(settled).select(F.col("worse").alias("id"), (~F.col("goes")).alias("stays"))
        stay = stay.unionByName(known.where("stays").select("id"))
        if fate.where(~settled).isEmpty():
            return stay
        rest = met.where("stays IS NULL").join(sorted_side(fate.where(~settled).select("worse", "open")), "worse")
        alone = rest.where("open = 1").select(F.col("worse").alias("better"), F.col("better").alias("_next"), F.col("plain").alias("_plain"))
        # "v stays" with v = not L is "not L": plain and flipped change places unless L itself is flipped.
        swap = F.coalesce(F.col("_plain"), F.lit(False))
        rest = rest.join(sorted_side(alone), "better", "left").select(
            "worse", F.coalesce("_next", "better").alias("better"),
            F.when(swap, F.col("flip")).otherwise(F.col("plain")).alias("plain"), F.when(swap, F.col("plain")).otherwise(F.col("flip")).alias("flip"),
        )
        left = rest.groupBy("worse", "better").agg(F.max("plain").alias("plain"), F.max("flip").alias("flip"))


FIRST_SLICE, SLICE_GROWTH = 1024, 16


def survivors(rows: DataFrame, rank: list[Column], threshold: int) -> DataFrame:
    """Rows with `kept_ord`, `sim`: null where the row stays, else the best staying row with a similar name.

    `rows` has block, name_key, ord. The result is that of one pass in rank order. The names of a block are settled in
    slices of that order, a first few, then ever larger ones: the similar pairs inside a slice by `staying`, then all later
    names meet those of the slice that stay and leave at a hit, which is their best as earlier slices had none. So of a
    dense group only what no earlier name has removed is ever compared with itself.
    """
    rows = rows.withColumn("_rank", F.struct(*rank, F.col("ord").alias("ord")))
    reps = rows.where(F.col("block") != "").groupBy("block", "name_key").agg(F.min("_rank").alias("_best"))
    reps = cut(spread(number_within(reps, ["block"], ["_best"]).withColumnRenamed("name_key", "name")))
    weights = letter_weights(reps.select("block", "name"))
    largest = reps.agg(F.max("i")).first()[0] or 0
    undecided, low, high, gone = reps, 0, FIRST_SLICE, None
    while low < largest:
        head = undecided.where(F.col("i") <= high)
        pairs = similar_within(head, threshold, distinct=True, weights=weights)
        a = head.select("block", F.col("name").alias("name_a"), F.col("_best").alias("ra"))
        b = head.select("block", F.col("name").alias("name_b"), F.col("_best").alias("rb"))
        a_first = F.col("ra") < F.col("rb")
        edges = cut(pairs.join(sorted_side(a), ["block", "name_a"]).join(sorted_side(b), ["block", "name_b"]).select(
            F.when(a_first, F.col("ra.ord")).otherwise(F.col("rb.ord")).alias("better"), F.when(a_first, F.col("rb.ord")).otherwise(F.col("ra.ord")).alias("worse"),
            F.least("ra", "rb").alias("_rank"), "sim",
        ))
        met = edges.select(F.col("better").alias("id")).union(edges.select(F.col("worse").alias("id"))).distinct()
        stay = staying(met, edges.select("worse", "better"))
        absorbed = edges.join(sorted_side(stay.withColumnRenamed("id", "better")), "better", "left_semi")
        best = absorbed.groupBy(F.col("worse").alias("_first")).agg(F.min(F.struct("_rank", F.col("better").alias("by"), "sim")).alias("d"))
        settled = cut(head.withColumn("_first", F.col("_best.ord")).join(sorted_side(best), "_first", "left").select("block", "name", "_best", "d"))
        lost = settled.where("d IS NOT NULL").select("block", "name", "d")
        gone = lost if gone is None else gone.unionByName(lost)
        if high < largest:
            later, standing = undecided.where(F.col("i") > high), settled.where("d IS NULL")
            pairs = similar_between(later, standing, threshold, distinct=True, weights=weights)
            hit = pairs.join(sorted_side(standing.select("block", F.col("name").alias("name_b"), F.col("_best").alias("_rank"))), ["block", "name_b"])
            hit = cut(hit.groupBy("block", F.col("name_a").alias("name")).agg(F.min(F.struct("_rank", F.col("_rank.ord").alias("by"), "sim")).alias("d")))
            gone = gone.unionByName(hit)
            undecided = cut(spread(later.join(sorted_side(hit), ["block", "name"], "left_anti")))
        low, high = high, high * SLICE_GROWTH
    fate = reps.select("block", F.col("name").alias("name_key"), F.col("_best.ord").alias("_first"))
    if gone is None:
        fate = fate.withColumns({"by": F.col("_first"), "_sim": F.lit(None).cast("double")}).where("false")
    else:
        fate = fate.join(sorted_side(gone.select("block", F.col("name").alias("name_key"), F.col("d.by").alias("by"), F.col("d.sim").alias("_sim"))), ["block", "name_key"], "left")
    own = F.col("ord") == F.col("_first")
    return rows.join(sorted_side(fate), ["block", "name_key"], "left").select(
        *[c for c in rows.columns if c != "_rank"],
        F.coalesce("by", F.when(~own, F.col("_first"))).alias("kept_ord"),
        F.coalesce("_sim", F.when(~own, F.lit(100.0))).alias("sim"),
    )


def sequential(rows: DataFrame, score: Column, threshold: int) -> DataFrame:
    """The arrival-order pair loop as rounds over the similarity graph.

    `rows` has block, name_key, ord; lower `score` is better. Result as for dominance.
    Only the first row of each (block, name, score) can matter to others.
    """
    rows = rows.withColumn("_score", score)
    reps = cut(
        rows.where(F.col("block") != "").groupBy("block", "name_key", "_score").agg(F.min("ord").alias("pos"))
    )
    pairs = similar_within(_names(reps), threshold)
    a, b = F.col("name_a"), F.col("name_b")
    sym = pairs.select("block", a.alias("x"), b.alias("y")).unionByName(pairs.select("block", b.alias("x"), a.alias("y")))
    sym = sym.unionByName(reps.select("block", F.col("name_key").alias("x"), F.col("name_key").alias("y")).distinct())
    left = reps.select("block", F.col("name_key").alias("x"), F.col("_score").alias("sx"), F.col("pos").alias("px"))
    right = reps.select("block", F.col("name_key").alias("y"), F.col("_score").alias("sy"), F.col("pos").alias("py"))
    near = cut(sym.join(sorted_side(left), ["block", "x"]).join(sorted_side(right), ["block", "y"]).where(F.col("px") < F.col("py")).select("px", "py", "sx", "sy"))
    removes = near.where(F.col("sx") <= F.col("sy")).select("px", "py")

    active = staying(reps.select(F.col("pos").alias("id")), removes.select(F.col("py").alias("worse"), F.col("px").alias("better"))).withColumnRenamed("id", "pos")
    first_remover = removes.join(sorted_side(active.withColumnRenamed("pos", "px")), "px").groupBy(F.col("py").alias("pos")).agg(
        F.min("px").alias("by_earlier")
    )
    nodes = reps.select("pos").join(sorted_side(active.withColumn("active", F.lit(True))), "pos", "left").join(sorted_side(first_remover), "pos", "left")
    later = (
        near.where(F.col("sy") < F.col("sx"))
        .join(sorted_side(active.withColumnRenamed("pos", "px")), "px")
        .join(sorted_side(nodes.select(F.col("pos").alias("py"), F.col("by_earlier").alias("_r"))), "py")
        .where(F.col("_r").isNull() | (F.col("_r") >= F.col("px")))
        .groupBy(F.col("px").alias("pos"))
        .agg(F.min("py").alias("by_later"))
    )
    nodes = nodes.join(sorted_side(later), "pos", "left")
    fate = reps.join(sorted_side(nodes), "pos").select(
        "block", "name_key", "_score", "pos", F.coalesce("by_earlier", "by_later").alias("_gone"),
        F.coalesce("by_earlier", "pos").alias("_copies"),
    )
    gone = F.when(F.col("ord") == F.col("pos"), F.col("_gone")).otherwise(F.col("_copies"))
    return rows.join(sorted_side(fate), ["block", "name_key", "_score"], "left").select(
        *[c for c in rows.columns if c != "_score"], F.when(F.col("pos").isNotNull(), gone).alias("kept_ord")
    )


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable over the undirected edges (a, b).

    Alternates large-star and small-star steps, which need few rounds even for long
    chains; every round is cut with a reliable checkpoint.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("s"))
            .select("s.u", "s.v")
            .where("u <> v")
            .distinct()
        )
        nxt = cut(small)
        # Both are without copies: of equal size, they are equal if one holds the other.
        if nxt.count() == e.count() and nxt.exceptAll(e).isEmpty():
            break
        e = nxt
    label = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("_c"))
    return nodes.select("id").join(label, "id", "left").select("id", F.coalesce("_c", "id").alias("component"))


def similarity_components(rows: DataFrame, threshold: int) -> DataFrame:
    """Rows with `component`: rows of a block joined by chains of similar names."""
    reps = cut(spread(rows.where(F.col("block") != "").groupBy("block", "name_key").agg(F.min("ord").alias("id"))))
    pairs = similar_within(_names(reps), threshold, distinct=True)
    a = reps.select("block", F.col("name_key").alias("name_a"), F.col("id").alias("a"))
    b = reps.select("block", F.col("name_key").alias("name_b"), F.col("id").alias("b"))
    labels = components(pairs.join(sorted_side(a), ["block", "name_a"]).join(sorted_side(b), ["block", "name_b"]).select("a", "b"), reps)
    lab = sorted_side(reps).join(labels, "id").select("block", "name_key", "component")
    return rows.join(sorted_side(lab), ["block", "name_key"], "left").withColumn("component", F.coalesce("component", "ord"))


def merge_audit(judged: DataFrame) -> DataFrame:
    """One line per dropped row: who absorbed it and how alike the names are."""
    kept = judged.select(F.col("ord").alias("kept_ord"), F.col("name").alias("kept_name"), F.col("cp").alias("kept_cp"))
    line = F.format_string(
        '"%s" (%s) ≈ "%s" (%s) → fusionné (%s%%)', "kept_name", "kept_cp", "name", "cp",
        F.round("sim", 1).cast("decimal(4,1)").cast("string"),
    )
    return (
        judged.where(F.col("kept_ord").isNotNull())
        .join(kept, "kept_ord")
        .select("kept_ord", F.col("ord").alias("dropped_ord"), line.alias("detail"))
    )
