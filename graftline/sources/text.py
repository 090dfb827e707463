"""Readers of assembly text formats as typed DataFrames. Formats are read in parallel wherever their records are lines."""

from __future__ import annotations

import bz2
import gzip
import lzma
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import sequences as S


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): lines of plain, gzip or bzip2 files; xz files are decompressed by a worker each."""
    if not str(path).endswith(".xz"):
        return spark.read.text(path)
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield pd.DataFrame({"value": lzma.decompress(content).decode().splitlines()})

    return files.mapInPandas(run, "value string")


def fields(rows: DataFrame) -> DataFrame:
    return rows.select(F.split("value", "\t").alias("f"))


def _at(i: int, kind: str = "string") -> Column:
    return F.try_element_at("f", F.lit(i + 1)).cast(kind)


def gfa_segments(spark: SparkSession, path: str) -> DataFrame:
    """(node, seq, length, coverage, tags) of the S lines."""
    f = fields(lines(spark, path).where(F.col("value").startswith("S\t")))
    tags = F.slice("f", F.lit(4), F.size("f"))
    return f.select(_at(1).alias("node"), _at(2).alias("seq"), S.segment_length(_at(2), tags).alias("length"), S.coverage_tag(tags).alias("coverage"), tags.alias("tags"))


def gfa_links(spark: SparkSession, path: str) -> DataFrame:
    """(src, src_fw, dst, dst_fw, overlap) of the L lines."""
    f = fields(lines(spark, path).where(F.col("value").startswith("L\t")))
    return f.select(_at(1).alias("src"), (_at(2) == "+").alias("src_fw"), _at(3).alias("dst"), (_at(4) == "+").alias("dst_fw"), F.regexp_extract(_at(5), "^([0-9]+)M", 1).cast("int").alias("overlap"))


def undirected(spark: SparkSession, path: str, real_overlaps: bool = False) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, length, coverage; edges: a, b, mid_length). Overlaps count as 0 unless asked for."""
    nodes = gfa_segments(spark, path).select("node", "length", "coverage")
    size = nodes.select(F.col("node").alias("_n"), F.col("length").alias("_l"))
    e = gfa_links(spark, path).join(size, F.col("src") == F.col("_n")).withColumn("la", F.col("_l")).drop("_n", "_l").join(size, F.col("dst") == F.col("_n"))
    mid = F.col("la") + F.col("_l") - (F.col("overlap") if real_overlaps else F.lit(0))
    return nodes, e.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), mid.alias("mid_length")).distinct()


def directed(spark: SparkSession, path: str, real_overlaps: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same over signed nodes, id+ and id-, with every edge's mirror."""
    nodes, _ = undirected(spark, path)
    signed = nodes.select(F.explode(F.array(F.concat("node", F.lit("+")), F.concat("node", F.lit("-")))).alias("node"), "length", "coverage")
    size = nodes.select(F.col("node").alias("_n"), F.col("length").alias("_l"))
    e = gfa_links(spark, path).join(size, F.col("src") == F.col("_n")).withColumn("la", F.col("_l")).drop("_n", "_l").join(size, F.col("dst") == F.col("_n"))
    sign = lambda c, fw: F.concat(F.col(c), F.when(fw, F.lit("+")).otherwise(F.lit("-")))
    mid = F.col("la") + F.col("_l") - (F.col("overlap") if real_overlaps else F.lit(0))
    one = e.select(sign("src", F.col("src_fw")).alias("u"), sign("dst", F.col("dst_fw")).alias("v"), mid.alias("mid_length"))
    mirror = e.select(sign("dst", ~F.col("dst_fw")).alias("u"), sign("src", ~F.col("src_fw")).alias("v"), mid.alias("mid_length"))
    return signed, one.union(mirror).distinct()


def gaf(spark: SparkSession, path: str) -> DataFrame:
    """Alignments: read, rlen, rstart, rend, strand, path, plen, pstart, pend, nmatch, alen, mapq, idy, tags."""
    f = fields(lines(spark, path)).where(F.size("f") >= 12)
    tags = F.slice("f", F.lit(13), F.size("f"))
    idy = S.identity(F.try_element_at(F.filter(tags, lambda t: t.startswith("id:f:")), F.lit(1)))
    numbers = [_at(i, "long").alias(n) for i, n in ((6, "plen"), (7, "pstart"), (8, "pend"), (9, "nmatch"), (10, "alen"), (11, "mapq"))]
    return f.select(S.read_name(_at(0)).alias("read"), _at(1, "long").alias("rlen"), _at(2, "long").alias("rstart"), _at(3, "long").alias("rend"), _at(4).alias("strand"), P.tokens(_at(5)).alias("path"), *numbers, idy.alias("idy"), tags.alias("tags"))


def paf_as_gaf(spark: SparkSession, path: str, mapq: int = 20, least: int = 5000, identity: float = 0.9) -> DataFrame:
    """Linear alignments (PAF with a de tag) as one-node paths; on the reverse strand the node is turned."""
    f = fields(lines(spark, path)).where(F.size("f") >= 12)
    div = F.regexp_extract(F.array_join("f", "\t"), r"(?:de|dv):f:([0-9.eE+-]+)", 1).cast("double")
    minus = _at(4) == "-"
    plen, ps, pe = _at(6, "long"), _at(7, "long"), _at(8, "long")
    out = f.select(_at(0).alias("read"), _at(1, "long").alias("rlen"), _at(2, "long").alias("rstart"), _at(3, "long").alias("rend"), F.array(F.concat(F.when(minus, F.lit("<")).otherwise(F.lit(">")), _at(5))).alias("path"), plen.alias("plen"), F.when(minus, plen - pe).otherwise(ps).alias("pstart"), F.when(minus, plen - ps).otherwise(pe).alias("pend"), _at(9, "long").alias("nmatch"), _at(10, "long").alias("alen"), _at(11, "long").alias("mapq"), (1 - div).alias("idy"))
    return out.where((F.col("mapq") >= mapq) & (F.col("rend") - F.col("rstart") > least) & (F.col("idy") >= identity))


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """(node, coverage, length); header lines, also repeated ones, are dropped."""
    f = fields(lines(spark, path)).where(_at(0) != "node")
    return f.select(_at(0).alias("node"), _at(1, "double").alias("coverage"), _at(2, "long").alias("length"))


def names(spark: SparkSession, path: str) -> DataFrame:
    """(name): first words of non-empty lines."""
    return lines(spark, path).select(F.split(F.trim("value"), r"\s+")[0].alias("name")).where("name <> ''")


def name_map(spark: SparkSession, path: str) -> DataFrame:
    """(old, new); a line of one word maps to itself."""
    w = lines(spark, path).where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+").alias("w"))
    return w.select(F.col("w")[0].alias("old"), F.coalesce(F.try_element_at("w", F.lit(2)), F.col("w")[0]).alias("new"))


def node_map(spark: SparkSession, path: str) -> DataFrame:
    """(name, path, left_clip, right_clip) of name<TAB>path:left:right lines."""
    f = fields(lines(spark, path))
    parts = F.split(_at(1), ":")
    return f.select(_at(0).alias("name"), P.tokens(parts[0]).alias("path"), F.coalesce(F.try_element_at(parts, F.lit(2)).cast("long"), F.lit(0)).alias("left_clip"), F.coalesce(F.try_element_at(parts, F.lit(3)).cast("long"), F.lit(0)).alias("right_clip"))


def checked_node_map(mapping: DataFrame, lengths: DataFrame) -> DataFrame:
    """mapping, or an error where a name's length is not that of its path less the clips. lengths: node, length."""
    size = lengths.select(F.col("node").alias("_n"), "length")
    inner = mapping.select("name", F.explode("path").alias("s")).join(size, P.bare(F.col("s")) == F.col("_n")).groupBy(F.col("name").alias("_m")).agg(F.sum("length").alias("_sum"))
    both = mapping.join(inner, F.col("name") == F.col("_m"), "left").join(size, F.col("name") == F.col("_n"), "left")
    wrong = F.col("length") != F.col("_sum") - F.col("left_clip") - F.col("right_clip")
    return both.withColumn("left_clip", F.when(wrong, F.raise_error(F.concat(F.lit("length of "), "name"))).otherwise(F.col("left_clip"))).select("name", "path", "left_clip", "right_clip")


def lengths(spark: SparkSession, path: str) -> DataFrame:
    """(node, length); repeats have to agree."""
    f = fields(lines(spark, path)).select(_at(0).alias("node"), _at(1, "long").alias("length"))
    g = f.groupBy("node").agg(F.min("length").alias("length"), F.max("length").alias("_max"))
    return g.select("node", F.when(F.col("length") == F.col("_max"), F.col("length")).otherwise(F.raise_error(F.concat(F.lit("two lengths of "), "node"))).alias("length"))


def paths(spark: SparkSession, path: str, stretch_gaps: float | None = None) -> DataFrame:
    """(name, path, assignment): haplotype paths in either notation; gap tokens' lengths stretched if asked."""
    f = fields(lines(spark, path)).where((_at(0) != "name") & (F.size("f") >= 2))
    raw = F.when(_at(1).rlike(r"^[<>]"), P.tokens(_at(1))).otherwise(P.from_tsv(_at(1)))
    if stretch_gaps is not None:
        raw = F.transform(raw, lambda s: F.when(P.is_gap(s), F.concat(F.lit("[N"), S.scaled_gap(P.gap_length(s), stretch_gaps).cast("string"), F.lit("N]"))).otherwise(s))
    return f.select(_at(0).alias("name"), raw.alias("path"), F.coalesce(_at(2), F.lit("NA")).alias("assignment"))


def homology(spark: SparkSession, path: str, least: int = 0) -> DataFrame:
    """Homology map rows of at least that alignment length between different nodes: q, qlen, qs, qe, strand, r, rlen, rs, re, nm, blen, mapq, idy."""
    f = fields(lines(spark, path).select(F.regexp_replace("value", " +", "\t").alias("value"))).where(F.size("f") >= 11)
    idy = F.regexp_extract(F.array_join("f", "\t"), r"id:f:([0-9.]+)", 1)
    rows = f.select(_at(0).alias("q"), _at(1, "long").alias("qlen"), _at(2, "long").alias("qs"), _at(3, "long").alias("qe"), _at(4).alias("strand"), _at(5).alias("r"), _at(6, "long").alias("rlen"), _at(7, "long").alias("rs"), _at(8, "long").alias("re"), _at(9, "long").alias("nm"), _at(10, "long").alias("blen"), _at(11, "int").alias("mapq"), F.nullif(idy, F.lit("")).cast("double").alias("idy"))
    return rows.where((F.col("blen") >= least) & (F.col("q") != F.col("r")) & (F.length("q") >= 3))


def contacts(spark: SparkSession, path: str, multimappers: bool = False) -> DataFrame:
    """(read, a, b, w, ca, cb) of contact rows with 3, 4 or 6 columns; a < b, own pairs dropped.

    Columns, parted by white space: read, first, second[, weight[, place in first, place in second]]. Lines with a # or
    fewer columns are no rows. Names with a comma are multimappers: each of the first with each of the second.
    """
    f = lines(spark, path).where(~F.contains("value", F.lit("#"))).select(F.split(F.trim("value"), r"\s+").alias("f")).where(F.size("f") >= 3)
    rows = f.select(_at(0).alias("read"), _at(1).alias("x"), _at(2).alias("y"), F.coalesce(_at(3, "long"), F.lit(1)).alias("w"), _at(4, "long").alias("cx"), _at(5, "long").alias("cy"))
    if not multimappers:
        rows = rows.where(~F.contains("x", F.lit(",")) & ~F.contains("y", F.lit(",")))
    else:
        rows = rows.withColumn("x", F.explode(F.split("x", ","))).withColumn("y", F.explode(F.split("y", ",")))
    rows = rows.where("x <> y")
    turned = F.col("x") > F.col("y")
    pick = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    return rows.select("read", pick("x", "y").alias("a"), pick("y", "x").alias("b"), "w", pick("cx", "cy").alias("ca"), pick("cy", "cx").alias("cb"))


def sam_pairs(spark: SparkSession, path: str, mapq: int = 1) -> DataFrame:
    """(read, node, at, mapq) of mapped SAM rows of that quality."""
    f = fields(lines(spark, path).where(~F.col("value").startswith("@"))).where(F.size("f") >= 5)
    return f.select(_at(0).alias("read"), _at(2).alias("node"), _at(3, "long").alias("at"), _at(4, "int").alias("mapq")).where((F.col("mapq") >= mapq) & (F.col("node") != "*"))


def paired_contacts(rows: DataFrame) -> DataFrame:
    """(a, b, ca, cb, w): reads with two rows (read, node, at, alternatives), every alternative of one with every of the other, weight shared."""
    places = F.array_distinct(F.concat(F.array(F.struct(F.col("node").alias("node"), F.col("at").alias("at"))), F.coalesce("alternatives", F.array().cast("array<struct<node:string,at:bigint>>"))))
    two = rows.groupBy("read").agg(F.array_sort(F.collect_list(F.struct("node", "at", places.alias("p")))).alias("r")).where(F.size("r") == 2)
    both = two.select("read", F.col("r")[0]["p"].alias("x"), F.col("r")[1]["p"].alias("y")).withColumn("w", 1.0 / (F.size("x") * F.size("y")))
    each = both.withColumn("x", F.explode("x")).withColumn("y", F.explode("y")).where(F.col("x.node") != F.col("y.node"))
    turned = F.col("x.node") > F.col("y.node")
    a, b = F.when(turned, F.col("y")).otherwise(F.col("x")), F.when(turned, F.col("x")).otherwise(F.col("y"))
    return each.select(a["node"].alias("a"), b["node"].alias("b"), a["at"].alias("ca"), b["at"].alias("cb"), "w")


def bed(spark: SparkSession, path: str) -> DataFrame:
    """(node, start, end, name): name is the fourth column, whatever it holds."""
    f = fields(lines(spark, path)).where(F.size("f") >= 3)
    return f.select(_at(0).alias("node"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(3).alias("name"))


def telomeric_ends(places: DataFrame, lengths_: DataFrame, distance: int = 20_000) -> DataFrame:
    """(end): oriented nodes that run into a telomere of places (node, start, end) near their end."""
    both = places.join(lengths_.select("node", "length"), "node")
    left = both.where(F.col("start") < distance).select(F.concat(F.lit("<"), "node").alias("end"))
    return left.union(both.where(F.col("length") - F.col("end") < distance).select(F.concat(F.lit(">"), "node"))).distinct()


def kmer_list(spark: SparkSession, path: str, label: int = 1) -> DataFrame:
    return lines(spark, path).select(F.lit(label).alias("label"), F.upper(F.split("value", r"\s+")[0]).alias("kmer")).where("kmer <> ''")


def _blocks(rows: DataFrame, opens: Column) -> DataFrame:
    """rows (file, line, value) numbered by block; a block begins where `opens` holds. Files are independent."""
    return rows.withColumn("block", F.sum(opens.cast("int")).over(Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of each file in order, for formats whose records span lines."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return whole.where("value <> ''")


def scaffold_map(spark: SparkSession, path: str) -> DataFrame:
    """(outname, pathname, ordinal, piece, gap) of blocks path <outname> <pathname> ... end."""
    rows = _blocks(numbered_lines(spark, path), F.col("value").startswith("path "))
    head = rows.where(F.col("value").startswith("path ")).select("file", "block", F.split("value", " ")[1].alias("outname"), F.split("value", " ")[2].alias("pathname"))
    inner = rows.where(~F.col("value").startswith("path ") & (F.col("value") != "end")).withColumn("ordinal", F.row_number().over(Window.partitionBy("file", "block").orderBy("line")))
    gap = F.when(F.col("value").startswith("["), P.gap_length(F.col("value")))
    return inner.join(head, ["file", "block"]).select("outname", "pathname", "ordinal", F.when(gap.isNull(), F.col("value")).alias("piece"), gap.alias("gap"))


def layouts(spark: SparkSession, path: str) -> DataFrame:
    """(tig, len, read, bgn, end, copies, flag) of layout blocks."""
    rows = _blocks(numbered_lines(spark, path), F.col("value").startswith("tig\t"))
    word = lambda k: F.max(F.when(F.col("value").startswith(f"{k}\t"), F.split("value", "\t")[1]))
    head = rows.groupBy("file", "block").agg(word("tig").alias("tig"), word("len").cast("long").alias("len"))
    f = F.split("value", "\t")
    reads = rows.where((F.size(f) >= 3)).select("file", "block", f[0].alias("read"), f[1].cast("long").alias("bgn"), f[2].cast("long").alias("end"), F.coalesce(F.try_element_at(f, F.lit(4)).cast("int"), F.lit(1)).alias("copies"), F.coalesce(F.try_element_at(f, F.lit(5)).cast("int"), F.lit(0)).alias("flag"))
    return reads.join(head, ["file", "block"]).select("tig", "len", "read", "bgn", "end", "copies", "flag")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, comment, seq): records are split by the text source, so a file is read in parallel."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where("value <> ''")
    head = F.split_part(F.regexp_replace("value", "\r", ""), F.lit("\n"), F.lit(1))
    seq = F.upper(F.regexp_replace(F.substring("value", F.length(F.split_part("value", F.lit("\n"), F.lit(1))) + 1, F.length("value")), r"\s", ""))
    return records.select(F.split(head, r"\s+")[0].alias("name"), head.alias("comment"), seq.alias("seq"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq, qual) of four-line records; compressed files by their ending. A file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = {"gz": gzip.decompress, "xz": lzma.decompress, "bz2": bz2.decompress}
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                text = unpack.get(name.rpartition(".")[2], bytes)(content).decode().splitlines()
                if len(text) % 4 or any(not x.startswith("@") for x in text[0::4]):
                    raise ValueError(f"{name} is no four-line FASTQ")
                yield pd.DataFrame({"name": [x[1:].split()[0] for x in text[0::4]], "seq": [x.upper() for x in text[1::4]], "qual": text[3::4]})

    return files.mapInPandas(run, "name string, seq string, qual string")


def fasta_lengths(sequences: DataFrame) -> DataFrame:
    return sequences.select(F.col("name").alias("node"), F.length("seq").cast("long").alias("length"))
