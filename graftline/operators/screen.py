"""Screening of contigs: disconnected ones, contaminants, circular ends, extraction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as I
from .graph import neighbours_within
from .mapping import BAND, align


def disconnected(nodes: DataFrame, links: DataFrame, length: str, most: int) -> DataFrame:
    """Nodes shorter than `most` that no link (a, b) touches."""
    touched = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    return nodes.where(F.col(length) < most).join(touched, "node", "left_anti")


def contaminant_hits(hits: DataFrame, identity: float = 97.5, contig_share: float = 0.1, union_share: float = 0.5) -> DataFrame:
    """(contig, contaminant, covered, contig_length, contaminant_length): contigs that a contaminant covers well.

    hits: contig, contig_length, cs, ce, contaminant, contaminant_length, idy. A hit counts from that
    identity and share of the contig on; the union of a pair's hits has to cover union_share of the contig.
    """
    good = hits.where((F.col("idy") >= identity) & (F.col("ce") - F.col("cs") >= F.col("contig_length") * contig_share))
    keyed = good.withColumn("key", F.struct("contig", "contaminant"))
    covered = I.union_length(keyed.select("key", F.col("cs").alias("s"), F.col("ce").alias("e")))
    sizes = good.groupBy("contig", "contaminant").agg(F.max("contig_length").alias("contig_length"), F.max_by("contaminant_length", "cs").alias("contaminant_length"))
    out = covered.select("key.contig", "key.contaminant", "covered").join(sizes, ["contig", "contaminant"])
    return out.where(F.col("covered") >= F.col("contig_length") * union_share)


def exemplars(found: DataFrame) -> DataFrame:
    """Per contaminant the contig whose length is nearest to it and best covered; ties by name."""
    off = F.abs(F.col("contig_length") - F.col("contaminant_length"))
    by = Window.partitionBy("contaminant").orderBy(off, (F.col("covered") / F.col("contig_length")).desc(), "contig")
    return found.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")


def screened(contigs: DataFrame, links: DataFrame, hits: DataFrame, min_length: int = 100_000) -> DataFrame:
    """contigs (node, length) with `reason`: contaminant (with what hangs on it), disconnected, or null."""
    found = contaminant_hits(hits)
    sizes = contigs.select("node", F.col("length").alias("size"))
    start = found.groupBy(F.col("contig").alias("node")).agg(F.max("contaminant_length").alias("size"))
    near = neighbours_within(start, links, sizes).select("node").distinct().withColumn("_c", F.lit(True))
    alone = disconnected(contigs, links, "length", min_length).select("node").withColumn("_d", F.lit(True))
    out = contigs.join(near, "node", "left").join(alone, "node", "left")
    return out.withColumn("reason", F.when(F.col("_c"), "contaminant").when(F.col("_d"), "disconnected")).drop("_c", "_d")


def end_overlap(seq: str, least: int, most: int) -> int:
    """The longest exact overlap between the end and the start of a sequence, by its failure function."""
    n = len(seq)
    window = min(most, n // 2)
    text = seq[:window] + "\n" + seq[n - window :]
    fail = np.zeros(len(text), np.int64)
    k = 0
    for i in range(1, len(text)):
        while k and text[i] != text[k]:
            k = int(fail[k - 1])
        k += text[i] == text[k]
        fail[i] = k
    return int(fail[-1]) if len(text) > 1 and fail[-1] >= least else 0


def aligned_overlap(seq: str, least: int, most: int, identity: float, k: int = 16) -> int:
    """The longest overlap between the end and the start of a sequence in which at least this share of columns is equal.

    k-mers from the start that occur in the end tell where overlaps can begin; the end from there is aligned to the start in a
    band, gaps at either side not counted. An overlap needs one such k-mer in its first `least` bases.
    """
    n = len(seq)
    window = min(most, n // 2)
    head, tail = seq[:window], seq[n - window :]
    begins: set[int] = set()
    for h in range(0, max(1, min(least, window) - k + 1)):
        at = tail.find(head[h : h + k]) if h + k <= window else -1
        while at >= 0:
            begins.add(at - h)
            at = tail.find(head[h : h + k], at + 1)
    tried: list[int] = []
    for begin in sorted(begins):
        if tried and begin - tried[-1] <= BAND // 2:  # the same place, moved by a gap
            continue
        tried.append(begin)
        begin = max(0, begin)
        end = tail[begin:]
        ops = align(np.frombuffer(end.encode(), np.uint8), np.frombuffer(head[: len(end)].encode(), np.uint8))[3]
        lead = len(ops) - len(ops.lstrip("I"))
        inner = ops.strip("ID")
        if len(end) - lead >= least and inner and inner.count("=") >= identity * len(inner):
            return len(end) - lead
    return 0


def circularised(contigs: DataFrame, least: int = 50, most: int = 20_000, identity: float = 1.0) -> DataFrame:
    """contigs (node, seq) with their repeated end cut off once, and `overlap`; below an identity of 1 overlaps are found by alignment."""

    def run(batches):
        for batch in batches:
            cut = [(end_overlap(s, least, most) or aligned_overlap(s, least, most, identity)) if identity < 1 else end_overlap(s, least, most) for s in batch["seq"]]
            yield pd.DataFrame({"node": batch["node"], "seq": [s[: len(s) - c] for s, c in zip(batch["seq"], cut, strict=True)], "overlap": cut})

    return contigs.select("node", "seq").mapInPandas(run, "node string, seq string, overlap long")


def extracted(sequences: DataFrame, names: DataFrame, invert: bool = False) -> DataFrame:
    """Sequences (name, seq) that are (or are not) among names (name)."""
    return sequences.join(names.select("name").distinct(), "name", "left_anti" if invert else "left_semi")


def combined(pieces: DataFrame) -> DataFrame:
    """(scaffold, seq): pieces (scaffold, ordinal, seq or null, gap) joined in order, gaps as runs of N."""
    part = F.when(F.col("gap").isNotNull(), F.repeat(F.lit("N"), F.col("gap").cast("int"))).otherwise(F.col("seq"))
    grouped = pieces.groupBy("scaffold").agg(F.array_sort(F.collect_list(F.struct("ordinal", part.alias("part")))).alias("parts"))
    return grouped.select("scaffold", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("seq"))


def telomere_runs(sequences: DataFrame, motif: str = "CCCTAA", least: int = 4) -> DataFrame:
    """(name, s, e): runs of at least `least` copies of the motif or its reverse complement.

    The text between runs tells where each begins: splitting keeps the order.
    """
    other = motif[::-1].translate(str.maketrans("ACGT", "TGCA"))
    pattern = f"(?:{motif}){{{least},}}|(?:{other}){{{least},}}"
    found = sequences.select("name", F.regexp_extract_all("seq", F.lit(f"({pattern})"), F.lit(1)).alias("runs"), F.split("seq", pattern, -1).alias("between"))
    parts = found.select("name", F.posexplode(F.arrays_zip("runs", "between")).alias("i", "z")).where("z.runs IS NOT NULL")
    lead = F.coalesce(F.sum(F.length("z.runs")).over(Window.partitionBy("name").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = lead + F.sum(F.length("z.between")).over(Window.partitionBy("name").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return parts.select("name", start.cast("long").alias("s"), (start + F.length("z.runs")).cast("long").alias("e"))
