"""Expressions on oriented nodes (`>a`, `<a`) and paths of them (arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = r"\[N[0-9]+N(?::[^\]]*)?\]"


def flipped(node: Column) -> Column:
    """The same node in the other orientation."""
    return F.concat(F.translate(F.substring(node, 1, 1), "<>", "><"), F.substring(node, F.lit(2), F.length(node)))


def bare(node: Column) -> Column:
    """The node's name without its orientation."""
    return F.substring(node, F.lit(2), F.length(node))


def reversed_path(path: Column) -> Column:
    return F.reverse(F.transform(path, flipped))


def spelled(path: Column) -> Column:
    return F.array_join(path, "")


def canonical_edge(a: Column, b: Column) -> Column:
    """Of an edge and its mirror, the one that is smaller as text, as an array of two."""
    mirror = F.concat(flipped(b), flipped(a))
    return F.when(mirror < F.concat(a, b), F.array(flipped(b), flipped(a))).otherwise(F.array(a, b))


def canonical_ends(a: Column, b: Column) -> Column:
    """Two node ends in the order that is smaller as text."""
    return F.when(F.concat(b, a) < F.concat(a, b), F.array(b, a)).otherwise(F.array(a, b))


def canonical_path(path: Column) -> Column:
    """Of a path and its reverse, the one that is smaller as text; a tie goes to the reverse."""
    return F.when(spelled(path) < spelled(reversed_path(path)), path).otherwise(reversed_path(path))


def tokens(text: Column) -> Column:
    """Oriented nodes of a path's text, and gap tokens such as [N100N:why]."""
    return F.regexp_extract_all(text, F.lit(rf"({GAP}|[<>][^<>\[]+)"), F.lit(1))


def from_tsv(text: Column) -> Column:
    """A path written as a+,b- as an array; gap tokens stay."""
    step = lambda s: F.when(s.startswith("["), s).when(s.endswith("-"), F.concat(F.lit("<"), F.regexp_replace(s, "-$", ""))).otherwise(F.concat(F.lit(">"), F.regexp_replace(s, r"\+$", "")))
    return F.transform(F.split(text, ","), step)


def to_tsv(path: Column) -> Column:
    """A path as a+,b- text."""
    step = lambda s: F.when(s.startswith("["), s).otherwise(F.concat(bare(s), F.when(s.startswith(">"), F.lit("+")).otherwise(F.lit("-"))))
    return F.array_join(F.transform(path, step), ",")


def without_sign(node: Column) -> Column:
    """The name of a node written with + or - behind it."""
    return F.regexp_replace(node, "[+-]$", "")


def flipped_sign(node: Column) -> Column:
    return F.concat(without_sign(node), F.translate(F.right(node, F.lit(1)), "+-", "-+"))


def steps(path: Column, n: int) -> Column:
    """All runs of n consecutive nodes."""
    return F.when(F.size(path) >= n, F.transform(F.sequence(F.lit(1), F.size(path) - (n - 1)), lambda i: F.slice(path, i, n))).otherwise(F.array().cast("array<array<string>>"))


def is_gap(node: Column) -> Column:
    return node.startswith("[")


def gap_length(node: Column) -> Column:
    return F.regexp_extract(node, r"^\[N([0-9]+)N", 1).cast("long")
