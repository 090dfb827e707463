"""Expressions on nucleotide sequences and on the text fields of assembly records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """A, C, G and T complemented; any other character as it is; in reverse order."""
    return F.reverse(F.translate(seq, "ACTG", "TGAC"))


def homopolymer_compressed(seq: Column) -> Column:
    """Each run of one character as one; empty stays empty."""
    return F.regexp_replace(seq, r"(?s)(.)\1+", "$1")


def windows(texts: Column, k: int) -> Column:
    """For each ASCII text of an array, all its substrings of k characters, in order.

    Bytes are sliced in constant time, where characters of a string would be counted from its start.
    """
    of = lambda b: F.when(F.length(b) >= k, F.transform(F.sequence(F.lit(1), F.length(b) - (k - 1)), lambda i: F.substring(b, i, F.lit(k)).cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.transform(texts, lambda s: s.cast("binary")), of)


def kmers(seq: Column, k: int) -> Column:
    """All k-mers without an N, in order."""
    return F.flatten(windows(F.split(seq, "N"), k))


def canonical_kmer(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def both_strands(seq: Column, k: int) -> Column:
    """The k-mers of a sequence and then those of its reverse complement."""
    return F.concat(kmers(seq, k), kmers(reverse_complement(seq), k))


def packed_kmer(kmer: Column) -> Column:
    """A k-mer of up to 31 bases as a number, two bits a base in the order A C G T."""
    return F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10).cast("long")


def cut(seq: Column, start: Column | int, end: Column | int) -> Column:
    """Characters start to end, zero-based, end excluded."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return F.substring(seq, start + 1, F.greatest(F.lit(0), end - start).cast("int"))


def trimmed(seq: Column, head: int) -> Column:
    """Without the first `head` characters; the tail is left alone."""
    return F.expr("''") if head is None else F.substring(seq, F.lit(head + 1), F.length(seq))


def n_gap(length: Column) -> Column:
    return F.repeat(F.lit("N"), length.cast("int"))


def segment_length(seq: Column, tags: Column) -> Column:
    """The LN tag if there is one, else the length of the sequence (1 for an absent one, written *)."""
    ln = F.try_element_at(F.filter(tags, lambda t: t.startswith("LN:i:")), F.lit(1))
    return F.coalesce(F.substring(ln, 6, 20).cast("long"), F.length(seq).cast("long"))


def coverage_tag(tags: Column) -> Column:
    """The value of an ll:f: or kl:f: tag, kl first."""
    value = lambda name: F.substring(F.try_element_at(F.filter(tags, lambda t: t.startswith(name)), F.lit(1)), 6, 40).cast("double")
    return F.coalesce(value("kl:f:"), value("ll:f:"))


def identity(tag: Column) -> Column:
    """The third field of a tag such as id:f:0.99."""
    return F.split_part(tag, F.lit(":"), F.lit(3)).cast("double")


def read_name(name: Column) -> Column:
    """The name up to the first space."""
    return F.split_part(name, F.lit(" "), F.lit(1))


def truth(value: Column) -> Column:
    return F.lower(value).isin("yes", "true", "t", "1")


def scaled_gap(n: Column, factor: float = 1.5, most: int = 100_000) -> Column:
    """A compressed gap length stretched, rounded half to even, and capped."""
    return F.least(F.bround(n * F.lit(factor)).cast("long"), F.lit(most).cast("long"))


def scaffold_gap(distance: Column, least: int = 5_000, most: int = 100_000) -> Column:
    return F.greatest(F.lit(least).cast("long"), F.least(F.lit(most).cast("long"), F.bround(distance).cast("long")))


def marker_color(first: Column, second: Column, fraction: float = 0.9, least: int = 100) -> Column:
    """Colour of a node by its two haplotypes' markers: first, second, mixed, or too few to tell."""
    total = first + second
    # The display colours of the colour table.
    return F.when(total <= least, F.lit("#AAAAAA")).when(first > total * fraction, F.lit("#8888FF")).when(second > total * fraction, F.lit("#FF8888")).otherwise(F.lit("#FFFF00"))


def base_name(name: Column) -> Column:
    """Without the last _part, unless that part begins with cut."""
    return F.when(name.rlike("_cut[^_]*$"), name).otherwise(F.regexp_replace(name, "_[^_]*$", ""))


def replaced_name(name: Column, new: Column, mode: str = "mapped") -> Column:
    """The mapped name, or for names without one: the old name without its tig0 prefix and zeros ('mapped'), or null ('only')."""
    plain = F.regexp_replace(name, "^tig0*", "")
    return F.coalesce(new, plain if mode == "mapped" else F.lit(None))
