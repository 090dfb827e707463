"""Bridges between unique nodes: discovery, filtering, completion, and connection along paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from .graph import tangles
from .iterate import hinted, saved


def bridges(paths: DataFrame, unique: DataFrame, path: str = "path") -> DataFrame:
    """(bridge): canonical stretches of paths from one unique node to the next, one row for each passage."""
    rows = saved(paths.select(F.monotonically_increasing_id().alias("_p"), F.col(path).alias("_path")))
    steps = rows.select("_p", F.posexplode("_path").alias("_i", "_step"))
    marks = steps.join(hinted(unique.select(F.col("node").alias("_u")).distinct()), P.bare(F.col("_step")) == F.col("_u"), "left_semi").groupBy("_p").agg(F.array_sort(F.collect_list("_i")).alias("_at"))
    found = rows.join(marks.where(F.size("_at") >= 2), "_p")
    between = F.transform(F.sequence(F.lit(1), F.size("_at") - 1), lambda k: F.slice("_path", F.element_at("_at", k) + 1, F.element_at("_at", k + 1) - F.element_at("_at", k) + 1))
    return found.select(F.explode(between).alias("b")).select(P.canonical_path(F.col("b")).alias("bridge"))


def bridge_ends(path: F.Column) -> F.Column:
    """First node and last node turned back: the two unique ends that a path connects."""
    return P.canonical_ends(path[0], P.flipped(F.element_at(path, -1)))


def bridge_counts(found: DataFrame) -> DataFrame:
    """(a, b, n): passages between canonical pairs of first and last nodes."""
    pair = P.canonical_path(F.array(F.col("bridge")[0], F.element_at("bridge", -1)))
    return found.select(pair.alias("e")).groupBy(F.col("e")[0].alias("a"), F.col("e")[1].alias("b")).agg(F.count(F.lit(1)).alias("n"))


def right_connections(found: DataFrame) -> DataFrame:
    """found with `kept`: false where the connection was seen once or another from one of its ends twice as often."""
    ends = found.select("bridge", F.col("bridge")[0].alias("x"), P.flipped(F.element_at("bridge", -1)).alias("y"))
    sides = ends.select("x", "y").union(ends.select("y", "x"))
    n = sides.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("_most", F.max("n").over(Window.partitionBy("x")))
    wrong = n.where((F.col("n") == 1) | (F.col("_most") >= 2 * F.col("n"))).select("x", "y")
    wrong = wrong.union(wrong.select("y", "x")).distinct().withColumn("_w", F.lit(True))
    return ends.join(wrong, ["x", "y"], "left").select("bridge", F.col("_w").isNull().alias("kept"))


def majority_bridges(found: DataFrame) -> DataFrame:
    """(bridge, n, kept): of the paths between two ends, kept if seen at least half as often as the commonest."""
    p = found.select(P.canonical_path(F.col("bridge")).alias("bridge"))
    n = p.groupBy("bridge").agg(F.count(F.lit(1)).alias("n"))
    pair = P.canonical_path(F.array(F.col("bridge")[0], F.element_at("bridge", -1)))
    return n.withColumn("_most", F.max("n").over(Window.partitionBy(pair))).select("bridge", "n", (F.col("n") * 2 >= F.col("_most")).alias("kept"))


def unambiguous_tangles(picked: DataFrame, counted: DataFrame, nodes: DataFrame, graph: DataFrame, unique: DataFrame) -> DataFrame:
    """picked (bridge) without cross connections: in a tangle all of whose unique ends have a strictly
    commonest partner, and where these partners are each other's, only connections between partners stay.
    """
    ends = saved(tangles(nodes, graph, unique).join(unique.select("node").distinct(), P.bare(F.col("end")) == F.col("node"), "left_semi"))
    pair = bridge_ends(F.col("bridge"))
    n = counted.select(pair.alias("e")).groupBy(F.col("e")[0].alias("a"), F.col("e")[1].alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sides = n.select(F.col("a").alias("x"), F.col("b").alias("y"), "n").union(n.select("b", "a", "n")).distinct()
    top = sides.withColumn("_most", F.max("n").over(Window.partitionBy("x"))).where("n = _most").groupBy("x").agg(F.count(F.lit(1)).alias("_k"), F.min("y").alias("y")).where("_k = 1").select("x", "y")
    back = top.select(F.col("x").alias("y"), F.col("y").alias("_x"))
    mutual = top.join(back, "y", "left").withColumn("mutual", F.col("_x").eqNullSafe(F.col("x"))).select("x", "y", "mutual")
    judged = ends.join(mutual, F.col("end") == F.col("x"), "left")
    clear = judged.groupBy("tangle").agg(F.min(F.coalesce("mutual", F.lit(False)).cast("int")).alias("ok")).where("ok = 1").select("tangle")
    partner = judged.join(clear, "tangle", "left_semi").select(F.col("end").alias("_a"), F.col("y").alias("_b"))
    rows = picked.select("bridge", pair.alias("e"))
    return rows.join(partner, F.col("e")[0] == F.col("_a"), "left").where(F.col("_b").isNull() | (F.col("_b") == F.col("e")[1])).select("bridge")


def diploid_cores(graph: DataFrame, unique: DataFrame) -> DataFrame:
    """(core, left, right): nodes that are not unique, with two unique nodes before and two behind, all different."""
    behind = graph.groupBy("u").agg(F.array_sort(F.collect_set("v")).alias("vs"))
    fw = behind.where(F.col("u").startswith(">")).select(P.bare(F.col("u")).alias("core"), F.col("vs").alias("right"))
    bw = behind.where(F.col("u").startswith("<")).select(P.bare(F.col("u")).alias("core"), F.transform("vs", P.flipped).alias("left"))
    both = fw.join(bw, "core").where((F.size("left") == 2) & (F.size("right") == 2))
    names = F.array_distinct(F.transform(F.concat("left", "right"), P.bare))
    both = both.where(F.size(names) == 4).join(unique.select(F.col("node").alias("core")), "core", "left_anti")
    around = both.select("core", F.explode(names).alias("node")).join(unique.select("node").distinct(), "node").groupBy("core").count().where("count = 4").select("core")
    return both.join(around, "core", "left_semi")


def completed_diploid(picked: DataFrame, counted: DataFrame, graph: DataFrame, unique: DataFrame, least: int) -> DataFrame:
    """picked (bridge) with paths through diploid cores made whole.

    A core with one well supported path and no discarded one gets the path of its other two nodes; one
    with three or more keeps a pair of the best supported that uses all four nodes, if there is one pair only.
    """
    cores = saved(diploid_cores(graph, unique))
    through = lambda rows: rows.where(F.size("bridge") == 3).join(cores, P.bare(F.col("bridge")[1]) == F.col("core"))
    n = counted.groupBy(P.canonical_path(F.col("bridge")).alias("_c")).agg(F.count(F.lit(1)).alias("n"))
    own = through(picked.distinct()).join(n, P.canonical_path(F.col("bridge")) == F.col("_c"), "left").select("core", "left", "right", "bridge", F.coalesce("n", F.lit(0)).alias("n"))
    own = own.withColumn("bridge", F.when(F.col("bridge")[1].startswith(">"), F.col("bridge")).otherwise(P.reversed_path(F.col("bridge"))))
    own = saved(own.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("core"))))
    discarded = through(counted.join(picked.select(P.canonical_path(F.col("bridge")).alias("_c")), P.canonical_path(F.col("bridge")) == F.col("_c"), "left_anti")).select("core").distinct()
    lonely = own.where((F.col("k") == 1) & (F.col("n") >= least)).join(discarded, "core", "left_anti")
    other = lambda side, used: F.element_at(F.filter(F.col(side), lambda x: x != used), 1)
    added = lonely.select(F.array(other("left", F.col("bridge")[0]), F.concat(F.lit(">"), "core"), other("right", F.col("bridge")[2])).alias("bridge"))
    few = own.where("k <= 2").select("bridge")
    many = own.where("k >= 3").withColumn("_r", F.row_number().over(Window.partitionBy("core").orderBy(F.col("n").desc(), P.spelled(F.col("bridge")))))
    cut = many.groupBy("core").agg(F.max(F.when(F.col("_r") == 1, F.col("n"))).alias("_1"), F.max(F.when(F.col("_r") == 2, F.col("n"))).alias("_2"))
    many = many.join(cut, "core")
    x = many.where("n = _1").select("core", F.col("bridge").alias("p"), F.col("_r").alias("i"))
    y = many.where("n >= _2").select("core", F.col("bridge").alias("q"), F.col("_r").alias("j"))
    pairs = x.join(y, "core").where((F.col("i") < F.col("j")) & (F.col("p")[0] != F.col("q")[0]) & (F.col("p")[2] != F.col("q")[2]))
    one = pairs.groupBy("core").agg(F.count(F.lit(1)).alias("_k"), F.first("p").alias("p"), F.first("q").alias("q")).where("_k = 1")
    chosen = one.select(F.explode(F.array("p", "q")).alias("bridge"))
    kept = many.join(one, "core", "left_anti").select("bridge")
    rest = picked.distinct().join(own.select(P.canonical_path(F.col("bridge")).alias("_c")), P.canonical_path(F.col("bridge")) == F.col("_c"), "left_anti")
    return rest.unionByName(few).unionByName(added).unionByName(chosen).unionByName(kept).select(P.canonical_path(F.col("bridge")).alias("bridge")).distinct()


def forbidden_ends(paths: DataFrame, picked: DataFrame, solid: DataFrame, solid_ends: DataFrame, nodes: DataFrame, graph: DataFrame, unique: DataFrame, least: int) -> DataFrame:
    """Ends of unique nodes in tangles that the picked bridges don't explain.

    A tangle is unexplained if one of its solid nodes, or an edge between solid_ends that is walked at least
    `least` times, lies on no bridge, or if one of its unique ends has no bridge.
    """
    ends = saved(tangles(nodes, graph, unique))
    covered = picked.select(F.explode(F.transform("bridge", P.bare)).alias("node")).distinct()
    bare_nodes = solid.join(unique, "node", "left_anti").join(covered, "node", "left_anti")
    canon = lambda rows, path: rows.select(F.explode(P.steps(F.col(path), 2)).alias("s")).select(P.canonical_edge(F.col("s")[0], F.col("s")[1]).alias("e"))
    walked = canon(paths, "path").groupBy("e").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("e")
    for i in (0, 1):
        walked = walked.join(solid_ends.join(unique, "node", "left_anti").select(F.col("node").alias(f"_s{i}")).distinct(), P.bare(F.col("e")[i]) == F.col(f"_s{i}"), "left_semi")
    open_edges = walked.join(canon(picked, "bridge").distinct(), "e", "left_anti")
    seen = picked.select(F.col("bridge")[0].alias("end")).union(picked.select(P.flipped(F.element_at("bridge", -1)))).distinct()
    own = ends.join(unique.select("node").distinct(), P.bare(F.col("end")) == F.col("node"), "left_semi")
    bad = ends.join(bare_nodes.select(F.concat(F.lit(">"), "node").alias("end")), "end", "left_semi").select("tangle")
    bad = bad.union(ends.join(open_edges.select(F.col("e")[0].alias("end")), "end", "left_semi").select("tangle"))
    bad = bad.union(own.join(seen, "end", "left_anti").select("tangle")).distinct()
    return own.join(bad, "tangle", "left_semi").select("end")


def connected(nodes: DataFrame, graph: DataFrame, picked: DataFrame, forbidden: DataFrame, unique: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, source; arcs): tangles resolved along bridges.

    Both ends of a used bridge have to be free of `forbidden` (end). Inner nodes become copies, numbered by bridge
    in text order (unnumbered if used once); what was in a resolved tangle and is not unique goes.
    """
    ends = saved(tangles(nodes, graph, unique))
    free = picked.select(F.col("bridge")[0].alias("end")).union(picked.select(P.flipped(F.element_at("bridge", -1)))).distinct().join(forbidden, "end", "left_anti")
    free = saved(free)
    solved = ends.join(free, "end", "left_semi").select("tangle").distinct()
    usable = picked.select("bridge").distinct().join(free.select(F.col("end").alias("_a")), F.col("bridge")[0] == F.col("_a"), "left_semi")
    usable = usable.join(free.select(F.col("end").alias("_b")), P.flipped(F.element_at("bridge", -1)) == F.col("_b"), "left_semi")
    steps = usable.select(P.spelled(F.col("bridge")).alias("key"), F.size("bridge").alias("len"), F.posexplode("bridge").alias("i", "step"))
    inner = (F.col("i") > 0) & (F.col("i") < F.col("len") - 1)
    by = Window.partitionBy(P.bare(F.col("step")), inner)
    copy = F.row_number().over(by.orderBy("key", "i"))
    name = F.when(~inner | (F.count(F.lit(1)).over(by) == 1), F.col("step")).otherwise(F.concat("step", F.lit("_"), copy))
    steps = saved(steps.withColumn("name", name).withColumn("inner", inner))
    new_nodes = steps.where("inner").select(P.bare(F.col("name")).alias("node"), P.bare(F.col("step")).alias("source")).distinct()
    follow = Window.partitionBy("key").orderBy("i")
    joined = steps.select("key", "step", F.col("name").alias("u"), F.lead("step").over(follow).alias("next"), F.lead("name").over(follow).alias("v")).where("v IS NOT NULL")
    overlap = graph.select(F.col("u").alias("step"), F.col("v").alias("next"), "overlap").distinct()
    new_arcs = joined.join(overlap, ["step", "next"], "left").select("u", "v", F.coalesce("overlap", F.lit(0)).alias("overlap"))
    covered = new_nodes.select(F.col("source").alias("node")).distinct()
    inside = ends.join(solved, "tangle", "left_semi").select(P.bare(F.col("end")).alias("node")).distinct().join(unique, "node", "left_anti")
    gone = saved(covered.union(inside).distinct())
    old_nodes = nodes.select("node").join(gone, "node", "left_anti").select("node", F.col("node").alias("source"))
    old = graph.join(free.select(F.col("end").alias("u")), "u", "left_anti").join(free.select(P.flipped(F.col("end")).alias("v")), "v", "left_anti")
    old = old.join(gone.select(F.col("node").alias("_g")), P.bare(F.col("u")) == F.col("_g"), "left_anti").join(gone.select(F.col("node").alias("_g")), P.bare(F.col("v")) == F.col("_g"), "left_anti")
    arcs = old.select("u", "v", "overlap").unionByName(new_arcs).unionByName(new_arcs.select(P.flipped(F.col("v")).alias("u"), P.flipped(F.col("u")).alias("v"), "overlap")).distinct()
    return old_nodes.unionByName(new_nodes).distinct(), arcs


def merged_copies(nodes: DataFrame, graph: DataFrame, base: F.Column) -> DataFrame:
    """(node, merged): copies of one base node with equal neighbours become one, again and again."""
    names = saved(nodes.select("node", F.col("node").alias("merged"), base.alias("base")))
    while True:
        to = names.select(F.col("node").alias("_n"), "merged")
        g = graph.join(to.withColumnRenamed("_n", "_u").withColumnRenamed("merged", "mu"), P.bare(F.col("u")) == F.col("_u")).join(to.withColumnRenamed("_n", "_v").withColumnRenamed("merged", "mv"), P.bare(F.col("v")) == F.col("_v"))
        near = g.groupBy("mu").agg(F.array_sort(F.collect_set(F.concat(F.substring("u", 1, 1), F.substring("v", 1, 1), "mv"))).alias("near"))
        groups = names.select("merged", "base").distinct().join(near, F.col("merged") == F.col("mu"), "left").groupBy("base", "near").agg(F.min("merged").alias("to"), F.collect_list("merged").alias("all")).where(F.size("all") > 1)
        # One merge for each base in a round: the group with the smallest name.
        groups = groups.groupBy("base").agg(F.min_by("all", "to").alias("all"), F.min("to").alias("to"))
        moves = saved(groups.select(F.explode("all").alias("merged"), "to"))
        if moves.isEmpty():
            break
        names = saved(names.join(moves, "merged", "left").select("node", F.coalesce("to", "merged").alias("merged"), "base"))
    return names.select("node", "merged")


def added_support(nodes: DataFrame, graph: DataFrame, paths: DataFrame, times: int) -> DataFrame:
    """(path): single nodes and edges that no path walks, each `times` times."""
    walked = paths.select(F.explode(F.transform("path", P.bare)).alias("node")).distinct()
    alone = nodes.select("node").join(walked, "node", "left_anti").select(F.array(F.concat(F.lit(">"), "node")).alias("path"))
    canon = lambda a, b: P.canonical_edge(a, b)
    seen = paths.select(F.explode(P.steps(F.col("path"), 2)).alias("s")).select(canon(F.col("s")[0], F.col("s")[1]).alias("path")).distinct()
    edges = graph.select(canon(F.col("u"), F.col("v")).alias("path")).distinct().join(seen, "path", "left_anti")
    return alone.unionByName(edges).select("path", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy")).select("path")


def replaced_steps(paths: DataFrame, mapping: DataFrame, key: str = "read") -> DataFrame:
    """paths (read, path) with nodes that mapping (name, path) has replaced by their own paths."""
    steps = paths.select(key, F.posexplode("path").alias("i", "step"))
    joined = steps.join(mapping.select(F.col("name").alias("_n"), F.col("path").alias("_p")), P.bare(F.col("step")) == F.col("_n"), "left")
    parts = F.when(F.col("_p").isNull(), F.array("step")).when(F.col("step").startswith(">"), F.col("_p")).otherwise(P.reversed_path(F.col("_p")))
    grouped = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", parts.alias("p")))).alias("x"))
    return grouped.select(key, F.flatten(F.transform("x", lambda e: e["p"])).alias("path"))
