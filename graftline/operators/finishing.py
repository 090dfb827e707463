"""Alignment trims and choices, lineage coverage, spurious uniques, trio splits, display nodes, path clean-up, minimizers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import sequences as S
from . import building as BD
from . import intervals as I
from .gaps import cut_nodes
from .graph import bounded_distances, lineage_leaves, tangles
from .iterate import components, saved
from .relations import near_own_identity, paths_with

# alignments


def trimmed_alignments(alignments: DataFrame, nodes: DataFrame, graph: DataFrame, trim: int) -> DataFrame:
    """alignments shortened by `trim` bases at both ends, without the nodes that only the trimmed parts touch.

    A node counts as touched up to its overlap with the next one. What is left empty goes; repeated rows stay repeated.
    """
    a = alignments.withColumn("_id", F.struct("read", "rstart", "rend", "path", "pstart", "pend"))
    # Each alignment is placed once, however often its row occurs.
    steps = a.select("_id").distinct().select("_id", F.col("_id.pstart").alias("pstart"), F.col("_id.pend").alias("pend"), F.posexplode("_id.path").alias("pos", "step"))
    steps = steps.join(nodes.select(F.col("node").alias("_n"), F.col("length").alias("len")), P.bare(F.col("step")) == F.col("_n")).drop("_n")
    by = Window.partitionBy("_id").orderBy("pos")
    steps = steps.withColumn("_u", F.lag("step").over(by)).join(graph.select(F.col("u").alias("_u"), F.col("v").alias("step"), "overlap").distinct(), ["_u", "step"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    placed = I.path_offsets(steps.withColumnRenamed("_id", "path"), "path").withColumnRenamed("path", "_id")
    lo, hi = F.col("pstart") + trim, F.col("pend") - trim
    kept = placed.where((F.col("offset") + F.col("len") > lo) & (F.col("offset") < hi) & (lo < hi))
    grouped = kept.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("pos", "step"))).alias("s"), F.min("offset").alias("_off"), F.max(F.col("offset") + F.col("len")).alias("_top"))
    out = a.drop("path").join(grouped, "_id")
    return out.withColumn("path", F.transform("s", lambda x: x["step"])).withColumn("rstart", F.col("rstart") + trim).withColumn("rend", F.col("rend") - trim).withColumn("plen", F.col("_top") - F.col("_off")).withColumn("pstart", lo - F.col("_off")).withColumn("pend", hi - F.col("_off")).select(*alignments.columns)


def maybe_trimmed(alignments: DataFrame, nodes: DataFrame, graph: DataFrame, trim: int, ignored: DataFrame) -> DataFrame:
    """Trimmed alignments where something is left and the read is not ignored (read); the others as they were."""
    free = alignments.join(ignored.select("read").distinct(), "read", "left_anti")
    done = trimmed_alignments(free, nodes, graph, trim)
    untouched = free.join(done.select("read").distinct(), "read", "left_anti").unionByName(alignments.join(ignored.select("read").distinct(), "read", "left_semi"))
    return done.select(*alignments.columns).unionByName(untouched.select(*alignments.columns))


def chosen_alignments(graph_based: DataFrame, linear: DataFrame, patched: DataFrame, mapq: int = 20, least: int = 5000) -> DataFrame:
    """Graph alignments, but linear ones for reads that they place better.

    Linear alignments (with idy) count if long, of that quality and near their read's usual identity; reads in
    patched (read) stay with the graph. A read changes if its linear alignments cover more of it.
    """
    able = near_own_identity(linear.where((F.col("mapq") >= mapq) & (F.col("rend") - F.col("rstart") >= least)).join(patched.select("read").distinct(), "read", "left_anti"))
    covered = lambda rows, name: I.union_length(rows.select(F.col("read").alias("key"), F.col("rstart").alias("s"), F.col("rend").alias("e"))).select(F.col("key").alias("read"), F.col("covered").alias(name))
    better = covered(able, "l").join(covered(graph_based, "g"), "read", "left").where(F.col("l") > F.coalesce("g", F.lit(0))).select("read")
    return graph_based.join(better, "read", "left_anti").unionByName(able.join(better, "read", "left_semi").select(*graph_based.columns))


def whole_alignments(rows: DataFrame, max_clip: int) -> DataFrame:
    """Alignments that are not chimeric in the middle: at least one end of the read and of the path is near."""
    read_end = (F.col("rstart") <= max_clip) | (F.col("rlen") - F.col("rend") <= max_clip)
    path_end = (F.col("pstart") <= max_clip) | (F.col("plen") - F.col("pend") <= max_clip)
    return rows.where(read_end | path_end)


def steps_near_path_ends(steps: DataFrame, distance: int) -> DataFrame:
    """The steps (path, pos, node, len) within `distance` of either end of their path, with `before` and `after`."""
    return I.end_distances(steps).where((F.col("before") < distance) | (F.col("after") < distance))


def near_path_ends(steps: DataFrame, distance: int) -> DataFrame:
    """(node): nodes of steps (path, pos, node, len) within `distance` of either end of their path."""
    return steps_near_path_ends(steps, distance).select("node").distinct()


# lineage


def lineage_coverage(mapping: DataFrame, roots: DataFrame, raw: DataFrame) -> DataFrame:
    """(node, coverage, length): derived nodes' coverage from their raw nodes', weighted by length.

    Raw nodes that several derived nodes share tell nothing about either and don't count, unless a node has no others.
    """
    leaves = lineage_leaves(mapping, roots).select(F.col("name").alias("node"), P.bare(F.col("leaf")).alias("raw")).join(raw.select(F.col("node").alias("raw"), "coverage", "length"), "raw")
    owners = leaves.groupBy("raw").agg(F.countDistinct("node").alias("owners"))
    both = leaves.join(owners, "raw")
    one = F.col("owners") == 1
    mean = lambda w: F.sum(F.when(w, F.col("coverage") * F.col("length"))) / F.sum(F.when(w, F.col("length")))
    return both.groupBy("node").agg(F.round(F.coalesce(mean(one), mean(F.lit(True))), 2).alias("coverage"), F.sum("length").alias("length"))


def old_nodes(mapping: DataFrame, roots: DataFrame, stage: str) -> DataFrame:
    """(name, old): the nodes of an earlier stage, told by their prefix, that derived nodes consist of."""
    return lineage_leaves(mapping, roots).select("name", P.bare(F.col("leaf")).alias("old")).where(F.col("old").startswith(stage)).distinct()


def new_names(new: DataFrame, old: DataFrame, pattern: str) -> DataFrame:
    """(name, source): nodes that only the new graph has, and the node that their name tells they come from."""
    return new.select(F.col("node").alias("name")).join(old.select(F.col("node").alias("name")), "name", "left_anti").select("name", F.regexp_extract("name", pattern, 1).alias("source")).where("source <> ''")


def translated_uniques(unique: DataFrame, names: DataFrame) -> DataFrame:
    """Nodes of names (node) one of whose parts, without its nf or nb ending, is a unique node."""
    parts = names.select("node", F.explode(F.split("node", "_")).alias("p")).select("node", F.regexp_replace("p", "n[fb]$", "").alias("_p"))
    return parts.join(unique.select(F.col("node").alias("_p")), "_p", "left_semi").select("node").distinct()


def trio_pieces(marks: DataFrame, nodes: DataFrame, least: int = 1_000_000) -> DataFrame:
    """(node, piece, start, end): nodes cut where long stretches of one haplotype's markers meet the other's."""
    islands = I.haplotype_islands(marks, nodes, least)
    mixed = islands.groupBy("node").agg(F.countDistinct("hap").alias("n")).where("n > 1").select("node")
    places = islands.join(mixed, "node", "left_semi").select("node", F.explode(F.array("s", "e")).alias("at"))
    return cut_nodes(nodes, I.thinned_cuts(places, nodes, least=least))


# uniques


def without_contained(unique: DataFrame, paths: DataFrame, nodes: DataFrame, graph: DataFrame, least: int = 2) -> DataFrame:
    """unique without nodes inside tangles that make no sense with them but do without.

    In a sensible tangle every unique end has a mutual best partner, seen `least` times. A node with both ends in
    one senseless tangle is contained in it; it goes if the others then pair up.
    """
    own = unique.select("node").distinct()

    def sensible(names: DataFrame, ends: DataFrame) -> DataFrame:
        steps = paths.select(F.monotonically_increasing_id().alias("_p"), "path").select("_p", F.posexplode("path").alias("i", "step"))
        inside = steps.join(names, P.bare(F.col("step")) == F.col("node"), "left_semi")
        by = Window.partitionBy("_p").orderBy("i")
        hop = inside.withColumn("next", F.lead("step").over(by)).where("next IS NOT NULL")
        both = hop.select(F.col("step").alias("x"), P.flipped(F.col("next")).alias("y")).union(hop.select(P.flipped(F.col("next")), F.col("step")))
        n = both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
        best = n.groupBy("x").agg(F.max_by("y", F.struct("n", "y")).alias("y"))
        mutual = best.join(best.select(F.col("x").alias("y"), F.col("y").alias("_x")), "y").where("x = _x").select(F.col("x").alias("end"), F.lit(1).alias("ok"))
        return ends.join(mutual, "end", "left").groupBy("tangle").agg(F.min(F.coalesce("ok", F.lit(0))).alias("ok"))

    ends = saved(tangles(nodes, graph, own).join(own, P.bare(F.col("end")) == F.col("node"), "left_semi"))
    bad = sensible(own, ends).where("ok = 0").select("tangle")
    inner = saved(ends.join(bad, "tangle", "left_semi").groupBy(P.bare(F.col("end")).alias("node"), "tangle").count().where("count = 2").select("node", "tangle"))
    fewer = own.join(inner.select("node"), "node", "left_anti")
    outer = ends.join(inner.select("node"), P.bare(F.col("end")) == F.col("node"), "left_anti") if not inner.isEmpty() else ends
    better = sensible(fewer, outer).where("ok = 1").select("tangle")
    return own.join(inner.join(better, "tangle", "left_semi").select("node"), "node", "left_anti")


def long_node_chains(bubbles: DataFrame, start: DataFrame, max_hops: int = 50) -> DataFrame:
    """Nodes on chains of superbubbles (s, t) that begin at long nodes (node)."""
    found = saved(start.select("node").distinct())
    front = saved(start.select(F.explode(F.array(F.concat(F.lit(">"), "node"), F.concat(F.lit("<"), "node"))).alias("s")))
    for _ in range(max_hops):
        front = saved(bubbles.join(front, "s").select(F.col("t").alias("s")).distinct().join(found, P.bare(F.col("s")) == F.col("node"), "left_anti"))
        if front.isEmpty():
            break
        found = saved(found.union(front.select(P.bare(F.col("s")))).distinct())
    return found


# display and paths


def display_graph(nodes: DataFrame, graph: DataFrame, hidden: DataFrame, telomeres: DataFrame, rdna: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, arcs) without hidden nodes (node), with a telomere node at every telomeric end (end) and rDNA nodes (node) as one."""
    one = rdna.select(F.col("node").alias("_r")).distinct()
    gone = hidden.select(F.col("node").alias("_h")).distinct()
    name = lambda c: F.when(F.col("_r").isNotNull(), F.concat(F.substring(c, 1, 1), F.lit("rDNA"))).otherwise(F.col(c))
    arcs = graph.select("u", "v")
    for c in ("u", "v"):
        arcs = arcs.join(gone, P.bare(F.col(c)) == F.col("_h"), "left_anti").join(one, P.bare(F.col(c)) == F.col("_r"), "left").withColumn(c, name(c)).drop("_r")
    tel = telomeres.select(F.col("end").alias("u"), F.concat(F.lit(">telomere_"), F.translate("end", "><", "+-")).alias("v"))
    arcs = arcs.where(P.bare(F.col("u")) != P.bare(F.col("v"))).unionByName(tel).unionByName(tel.select(P.flipped(F.col("v")).alias("u"), P.flipped(F.col("u")).alias("v"))).distinct()
    kept = nodes.select("node").join(gone, F.col("node") == F.col("_h"), "left_anti").join(one, F.col("node") == F.col("_r"), "left").select(F.when(F.col("_r").isNotNull(), F.lit("rDNA")).otherwise(F.col("node")).alias("node"))
    return kept.union(tel.select(P.bare(F.col("v")))).distinct(), arcs


def path_distances(steps: DataFrame, graph: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """(p, q, distance): graph distances from the end of one oriented path to the start of another, up to a limit.

    steps: path (oriented, p+ or p-), pos, step. Only ends start a search.
    """
    by = Window.partitionBy("path")
    edge = steps.withColumn("_first", F.min("pos").over(by)).withColumn("_last", F.max("pos").over(by))
    starts = edge.where("pos = _last").select(F.col("path").alias("p"), F.col("step").alias("start"))
    goals = edge.where("pos = _first").select(F.col("path").alias("q"), F.col("step").alias("end"))
    far = bounded_distances(graph, nodes, starts.select(F.col("start").alias("end")).distinct(), limit)
    return far.join(starts, "start").join(goals, "end").where("p <> q").groupBy("p", "q").agg(F.min("distance").alias("distance"))


def rephased(paths: DataFrame, homologous: DataFrame, joined: DataFrame) -> DataFrame:
    """paths (path, label) with labels swapped in homologous pairs (p, q) of which one is joined (path, label) to the other phase."""
    want = joined.select(F.col("path").alias("p"), F.col("label").alias("_want"))
    clash = homologous.join(want, "p").join(paths.select(F.col("path").alias("p"), "label"), "p").where("label <> _want")
    swap = clash.select(F.col("p").alias("path"), F.col("_want").alias("_new")).unionByName(clash.select(F.col("q").alias("path"), F.col("label").alias("_new"))).dropDuplicates(["path"])
    return paths.join(swap, "path", "left").select("path", F.coalesce("_new", "label").alias("label"))


def telomeric_path_ends(steps: DataFrame, telomeric: DataFrame) -> DataFrame:
    """(path, at_left, at_right): whether a path's outer nodes run into telomeres (end)."""
    t = telomeric.select(F.col("end").alias("_e")).distinct()
    by = Window.partitionBy("path")
    edge = steps.withColumn("_first", F.min("pos").over(by)).withColumn("_last", F.max("pos").over(by))
    left = edge.where("pos = _first").select("path", P.flipped(F.col("step")).alias("_l")).join(t, F.col("_l") == F.col("_e"), "left").select("path", F.col("_e").isNotNull().alias("at_left"))
    right = edge.where("pos = _last").select("path", F.col("step").alias("_r")).join(t, F.col("_r") == F.col("_e"), "left").select("path", F.col("_e").isNotNull().alias("at_right"))
    return left.join(right, "path")


def completed_components(scaffolds: DataFrame, telomeres: DataFrame, membership: DataFrame, lengths: DataFrame) -> DataFrame:
    """(a, b): the two scaffolds of a component that lack one telomere each, to be joined at the bare ends.

    scaffolds: scaffold, path; telomeres: scaffold, at_left, at_right; membership: path, component. Only components
    with exactly two such scaffolds, which hold most of its length, are completed.
    """
    of = scaffolds.join(membership, "path").groupBy("scaffold").agg(F.min("component").alias("component"), F.countDistinct("component").alias("n")).where("n = 1")
    size = scaffolds.join(lengths, "path").groupBy("scaffold").agg(F.sum("length").alias("length"))
    open_ = of.join(telomeres.where(F.col("at_left") != F.col("at_right")), "scaffold").join(size, "scaffold")
    whole = of.join(size, "scaffold").groupBy("component").agg(F.sum("length").alias("all"))
    two = open_.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("sum"), F.min("scaffold").alias("a"), F.max("scaffold").alias("b")).where("n = 2")
    turned = open_.select("scaffold", "at_left")
    out = two.join(whole, "component").where("2 * sum > all").join(turned.select(F.col("scaffold").alias("a"), F.col("at_left").alias("la")), "a").join(turned.select(F.col("scaffold").alias("b"), F.col("at_left").alias("lb")), "b")
    return out.select(F.concat("a", F.when(F.col("la"), "+").otherwise("-")).alias("a"), F.concat("b", F.when(F.col("lb"), "-").otherwise("+")).alias("b"))


def scaffold_labels(scaffolds: DataFrame, paths: DataFrame) -> DataFrame:
    """(scaffold, label): the label of a scaffold's longest path. scaffolds: scaffold, path; paths: path, label, length."""
    return scaffolds.join(paths, "path").groupBy("scaffold").agg(F.max_by("label", F.struct("length", "path")).alias("label"))


def path_colors(steps: DataFrame, colors: DataFrame) -> DataFrame:
    """(path, color): the component colour that all of a path's nodes share, else 0. colors: node, color."""
    rows = steps.select("path", P.bare(F.col("step")).alias("node")).join(colors, "node")
    return rows.groupBy("path").agg(F.when(F.countDistinct("color") == 1, F.min("color")).otherwise(0).alias("color"))


def homozygous_links(mapping: DataFrame, roots: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(a, b): pairs of final nodes that share an earlier node of at least that length, and no third node does."""
    owners = lineage_leaves(mapping, roots).select("name", P.bare(F.col("leaf")).alias("old")).distinct().join(nodes.where(F.col("length") >= least).select(F.col("node").alias("old")), "old", "left_semi")
    two = owners.groupBy("old").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("a"), F.max("name").alias("b")).where("n = 2")
    return two.select("a", "b").distinct()


def homozygous_groups(links: DataFrame) -> DataFrame:
    return components(links).withColumnRenamed("label", "group")


# read overlaps


def minimizers(reads: DataFrame, k: int = 15, w: int = 10) -> DataFrame:
    """(read, pos, kmer): of every w neighbouring canonical k-mers the one with the smallest hash, leftmost. Hashes are Spark's xxhash64, in arrays of many reads."""
    rows = reads.where(F.length("seq") >= k + w - 1).select("read", "seq")
    return rows.mapInArrow(lambda it: _minimal(it, k, w), f"read {reads.schema['read'].dataType.simpleString()}, pos int, kmer string")


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash64(text: np.ndarray, seed: int = 42) -> np.ndarray:
    """Spark's xxhash64 of each row of bytes."""
    n, k = text.shape
    words = np.ascontiguousarray(text[:, : k // 8 * 8]).view("<u8").astype(np.uint64)
    mixed = lambda x: _turn(x * _P2, 31) * _P1
    at, zero = 0, np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        if k >= 32:
            lanes = [zero + x for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            while at + 4 <= k // 8:
                lanes = [_turn(v + words[:, at + j] * _P2, 31) * _P1 for j, v in enumerate(lanes)]
                at += 4
            h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for v in lanes:
                h = (h ^ mixed(v)) * _P1 + _P4
        else:
            h = zero + s + _P5
        h = h + np.uint64(k)
        # whole words that the lanes have left, half a word, bytes
        for j in range(at, k // 8):
            h = _turn(h ^ mixed(words[:, j]), 27) * _P1 + _P4
        done = k // 8 * 8
        if k - done >= 4:
            half = np.ascontiguousarray(text[:, done : done + 4]).view("<u4")[:, 0].astype(np.uint64)
            h, done = _turn(h ^ (half * _P1), 23) * _P2 + _P3, done + 4
        for j in range(done, k):
            h = _turn(h ^ (text[:, j].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _minimal(batches: Iterator[pa.RecordBatch], k: int, w: int) -> Iterator[pa.RecordBatch]:
    for names, raw, begin in BD.pieces(batches, max(1, BD.SAMPLED_BASES * 11 // k)):
        if len(raw) < k + w - 1:
            continue
        text = BD.canonical_text(raw, np.arange(len(raw) - k + 1), k)[0]
        h, at = xxhash64(text), np.arange(len(text))
        size = 1  # doubling to the smallest hash of w, the leftmost of equal ones
        while size < w:
            step = min(size, w - size)
            a, b = at[:-step], at[step:]
            at, size = np.where(h[a] <= h[b], a, b), size + step
        length = np.diff(begin)
        left = np.repeat(begin[1:], length) - np.arange(len(raw))
        at = np.unique(at[left[: len(at)] >= k + w - 1])
        of = np.repeat(np.arange(len(length)), length)[at]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), pa.array((at - begin[of]).astype(np.int32)), BD.as_strings(text[at])], names=["read", "pos", "kmer"])


def _shared(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(a, b, shared) of rows (a, list of b), of which equal a stand together; only rows of the last a wait for the next batch."""

    def counted(rows: pa.Table) -> pa.RecordBatch:
        names, lists = rows.column(0).combine_chunks(), rows.column(1).combine_chunks()
        run = np.r_[0, np.cumsum(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False))].astype(np.int64)
        others = pc.list_flatten(lists).dictionary_encode()
        n = max(1, len(others.dictionary))
        pairs, shared = np.unique(np.repeat(run, pc.list_value_length(lists).to_numpy(zero_copy_only=False)) * n + others.indices.to_numpy(zero_copy_only=False), return_counts=True)
        pairs, shared = pairs[shared >= least], shared[shared >= least]
        first = np.r_[0, np.flatnonzero(np.diff(run)) + 1]
        return pa.RecordBatch.from_arrays([names.take(pa.array(first[pairs // n])), others.dictionary.take(pa.array(pairs % n)), pa.array(shared.astype(np.int64))], names=["a", "b", "shared"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        other = pc.not_equal(batch.column(0), batch.column(0)[-1]).to_numpy(zero_copy_only=False)
        begin = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0  # of the last a
        if begin or (waiting and waiting[-1].column(0)[-1] != batch.column(0)[0]):
            yield counted(pa.Table.from_batches([*waiting, batch.slice(0, begin)]))
            waiting = []
        waiting.append(batch.slice(begin))
    if waiting:
        yield counted(pa.Table.from_batches(waiting))


def overlap_candidates(found: DataFrame, most: int = 1000, least: int = 2) -> DataFrame:
    """(a, b, shared): reads that share at least `least` minimizers; those on more than `most` reads don't count.

    A minimizer's reads are one list; each read takes what stands behind it in the lists that it is in, and counts these at one place. So what moves is a
    number for each pair and minimizer, not a row, and pairs meet no second shuffle.
    """
    lists = found.select("read", "kmer").where("read IS NOT NULL").repartition("kmer").distinct().groupBy("kmer").agg(F.array_sort(F.collect_list("read")).alias("reads")).where(F.size("reads").between(2, most))
    rows = lists.select("reads", F.posexplode("reads").alias("i", "a")).where(F.col("i") < F.size("reads") - 1)
    rows = rows.select("a", F.slice("reads", F.col("i") + 2, F.size("reads")).alias("b")).repartition("a").sortWithinPartitions("a")
    kind = found.schema["read"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _shared(it, least), f"a {kind}, b {kind}, shared long")


def corrected_paths(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Alignments that touch none of the cut nodes (node)."""
    return paths_with(rows, nodes.select(F.col("node").alias("name")), invert=True)
