"""Superbubbles, bubble and tip popping, loops: operators whose steps depend on their order.

A connected component is the unit: it is handed to one Python worker as a table of arcs with node
lengths and coverages, and worked on in the order of names. Components beyond MAX_ARCS are refused
loudly; contract them first (unitigs, or cuts at unique nodes).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from .graph import graph_components

MAX_ARCS = 2_000_000


def turned(node: str) -> str:
    return ("<" if node[0] == ">" else ">") + node[1:]


class Component:
    """Arcs of one component, mirrors included."""

    def __init__(self, rows: Iterable[tuple[str, str]], length: dict[str, int] | None = None, coverage: dict[str, float] | None = None):
        self.out: dict[str, set[str]] = defaultdict(set)
        for u, v in rows:
            self.out[u].add(v)
            self.out[turned(v)].add(turned(u))
        self.length, self.coverage = length or {}, coverage or {}

    def followers(self, node: str) -> list[str]:
        return sorted(self.out.get(node, ()))

    def predecessors(self, node: str) -> list[str]:
        return sorted(turned(x) for x in self.out.get(turned(node), ()))

    def drop_arc(self, u: str, v: str) -> None:
        self.out[u].discard(v)
        self.out[turned(v)].discard(turned(u))

    def drop_node(self, name: str) -> None:
        for node in (">" + name, "<" + name):
            for v in list(self.out.get(node, ())):
                self.drop_arc(node, v)

    def superbubble(self, start: str, max_size: int | None = None, chain_steps: bool = False) -> str | None:
        """Where the branches from start all meet again, after Onodera and others (2013).

        No tip, cycle or inversion may lie inside. With chain_steps an unbranched step counts as a bubble.
        """
        out = self.followers(start)
        if chain_steps and len(out) == 1 and len(self.predecessors(out[0])) == 1:
            return out[0]
        if len(out) < 2:
            return None
        ready, waiting, visited = [start], {start}, set()
        while ready:
            node = ready.pop()
            waiting.discard(node)
            visited.add(node)
            if max_size is not None and node != start and self.length.get(node[1:], 0) > max_size:
                return None
            following = self.followers(node)
            if not following:
                return None
            for v in following:
                if v[1:] == node[1:] or turned(v) in visited or v == start:
                    return None
                waiting.add(v)
                if all(p in visited for p in self.predecessors(v)):
                    ready.append(v)
            if len(ready) == 1 and waiting == set(ready):
                end = ready.pop()
                return None if start in self.out.get(end, ()) else end
        return None

    def inside(self, start: str, end: str) -> tuple[set[str], set[tuple[str, str]]]:
        """Nodes and arcs between the two ends of a bubble, ends included."""
        nodes, arcs, stack = {start}, set(), [start]
        while stack:
            node = stack.pop()
            if node == end:
                continue
            for v in self.followers(node):
                arcs.add((node, v))
                if v not in nodes:
                    nodes.add(v)
                    stack.append(v)
        return nodes, arcs

    def widest(self, start: str, end: str) -> list[str]:
        """The path through a bubble whose least covered inner node is covered best; ties by name.

        A direct arc from start to end competes with a width of half a copy's coverage only if nothing else is wider.
        """
        order, seen = [], set()

        def visit(node: str) -> None:
            stack = [(node, iter(self.followers(node) if node != end else ()))]
            seen.add(node)
            while stack:
                top, it = stack[-1]
                v = next((x for x in it if x not in seen), None)
                if v is None:
                    order.append(top)
                    stack.pop()
                else:
                    seen.add(v)
                    stack.append((v, iter(self.followers(v) if v != end else ())))

        visit(start)
        best: dict[str, tuple[float, list[str]]] = {start: (float("inf"), [start])}
        for node in reversed(order):
            if node not in best or node == end:
                continue
            width, path = best[node]
            for v in self.followers(node):
                w = width if v == end else min(width, self.coverage.get(v[1:], 0.0))
                if node == start and v == end:
                    w = -1.0
                if v not in best or (w, [-ord(c) for c in "".join(path)]) > (best[v][0], [-ord(c) for c in "".join(best[v][1][:-1])]):
                    best[v] = (w, [*path, v])
        return best[end][1]


def pop_bubble(g: Component, start: str, end: str, max_node: int, limit: float, max_nodes: int) -> tuple[set[str], set[tuple[str, str]]]:
    """Removes from a bubble what is off its widest path and covered by at most limit: names of nodes, arcs."""
    nodes, arcs = g.inside(start, end)
    names = {n[1:] for n in nodes}
    inner = names - {start[1:], end[1:]}
    if len(names) > max_nodes or (len(names) > 3 and any(g.length.get(n, 0) > max_node for n in inner)):
        return set(), set()
    path = g.widest(start, end)
    kept = {n[1:] for n in path}
    gone = {n for n in sorted(names - kept) if g.coverage.get(n, 0.0) <= limit}
    kept = names - gone
    walked = set(zip(path, path[1:], strict=False))
    cut = set()
    for u, v in arcs:
        if (u, v) in walked or u[1:] in gone or v[1:] in gone:
            continue
        if (u, v) == (start, end) and len(kept) > 2:
            cut.add((u, v))
    for n in gone:
        g.drop_node(n)
    for u, v in cut:
        g.drop_arc(u, v)
    return gone, cut


def pop_tips(g: Component, start: str, max_coverage: float, max_length: int) -> set[str]:
    """Of 2 to 4 followers of start, the dead ends with no other predecessor that are covered worse than the best; one stays."""
    out = g.followers(start)
    if not 2 <= len(out) <= 4:
        return set()
    cov = {v: g.coverage.get(v[1:], 0.0) for v in out}
    best, longest = max(cov.values()), max(g.length.get(v[1:], 0) for v in out)
    gone: list[str] = []
    for v in out:
        dead = len(g.predecessors(v)) == 1 and not g.followers(v)
        worse = cov[v] < best or (cov[v] == best and g.length.get(v[1:], 0) < longest)
        if dead and worse and cov[v] < max_coverage and len(gone) + 1 < len(out) and g.length.get(v[1:], 0) <= max_length:
            gone.append(v[1:])
    for n in gone:
        g.drop_node(n)
    return set(gone)


def per_component(nodes: DataFrame, graph: DataFrame, work: Callable[[Component], list[tuple]], schema: str) -> DataFrame:
    """Runs work on every component; nodes: node, length and coverage (0 where null)."""
    label = graph_components(nodes, graph)
    arcs = graph.join(label, P.bare(F.col("u")) == F.col("node")).select("component", "u", "v", F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("length"), F.lit(None).cast("double").alias("coverage"))
    own = nodes.join(label, "node").select("component", F.lit(None).cast("string").alias("u"), F.lit(None).cast("string").alias("v"), F.col("node").alias("name"), F.col("length").cast("long"), F.col("coverage").cast("double"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        edges = group[group["u"].notna()]
        if len(edges) > MAX_ARCS:
            raise ValueError(f"a component has {len(edges)} arcs, over the limit of {MAX_ARCS}; contract it first")
        own = group[group["name"].notna()]
        g = Component(zip(edges["u"], edges["v"], strict=True), dict(zip(own["name"], own["length"].fillna(0).astype(int), strict=True)), dict(zip(own["name"], own["coverage"].fillna(0.0), strict=True)))
        return pd.DataFrame(work(g), columns=names)

    return arcs.unionByName(own).groupBy("component").applyInPandas(run, schema)


def superbubbles(nodes: DataFrame, graph: DataFrame, max_size: int | None = None, chain_steps: bool = False) -> DataFrame:
    """(s, t): start and end of every superbubble, from both sides."""

    def work(g: Component) -> list[tuple]:
        return [(s, t) for s in sorted(g.out) if (t := g.superbubble(s, max_size, chain_steps))]

    return per_component(nodes, graph, work, "s string, t string")


def popped(nodes: DataFrame, graph: DataFrame, mean: float, max_node: int = 50_000, share: float = 0.5, max_nodes: int = 20, tip_share: float = 0.5, tip_length: int = 50_000) -> DataFrame:
    """(kind, a, b): nodes (b null) and arcs that bubble and tip popping removes, in rounds until nothing changes."""

    def work(g: Component) -> list[tuple]:
        out: list[tuple] = []
        while True:
            before = len(out)
            for s in sorted(g.out):
                if t := g.superbubble(s):
                    gone, cut = pop_bubble(g, s, t, max_node, share * mean, max_nodes)
                    out += [("node", n, None) for n in sorted(gone)] + [("arc", u, v) for u, v in sorted(cut)]
            for s in sorted(g.out):
                out += [("node", n, None) for n in sorted(pop_tips(g, s, tip_share * mean, tip_length))]
            if len(out) == before:
                break
        return out

    return per_component(nodes, graph, work, "kind string, a string, b string").distinct()


def simple_loops(nodes: DataFrame, graph: DataFrame, mean: float, min_length: int = 0) -> DataFrame:
    """(loop, repeat, before, behind): before > repeat > loop > repeat > behind, where repeat can be written out twice.

    loop has one follower and one predecessor, the same oriented node; its coverage is at most 1.5 copies, the
    repeat's between 0.5 and 2.5. A repeat is taken once, and not beside another one that was.
    """

    def work(g: Component) -> list[tuple]:
        out, taken = [], set()
        for name in sorted({n[1:] for n in g.out}):
            after, before = g.followers(">" + name), g.predecessors(">" + name)
            if len(after) != 1 or len(before) != 1 or after[0] != before[0]:
                continue
            r = after[0]
            if r[1:] == name or r in g.out.get(r, ()):
                continue
            if name not in g.coverage or r[1:] not in g.coverage or g.coverage[name] > 1.5 * mean or not 0.5 * mean < g.coverage[r[1:]] < 2.5 * mean:
                continue
            ins = [x for x in g.predecessors(r) if x[1:] != name]
            outs = [x for x in g.followers(r) if x[1:] != name]
            around = {x[1:] for x in (*ins, *outs)}
            if len(ins) > 1 or len(outs) > 1 or not around or r[1:] in around or r[1:] in taken or around & taken:
                continue
            if any(g.coverage.get(x, 0.0) >= 2.5 * mean or g.length.get(x, 0) < min_length / 6 for x in around):
                continue
            taken.add(r[1:])
            out.append((">" + name, r, ins[0] if ins else None, outs[0] if outs else None))
        return out

    return per_component(nodes, graph, work, "loop string, repeat string, before string, behind string")


def unrolled(nodes: DataFrame, graph: DataFrame, loops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, source; arcs) with every repeat of loops as two copies, before and behind its loop."""
    copies = loops.select("loop", "repeat", "before", "behind", F.concat("repeat", F.lit("_copy1")).alias("c1"), F.concat("repeat", F.lit("_copy2")).alias("c2"))
    kept = nodes.select("node").join(loops.select(P.bare(F.col("repeat")).alias("node")), "node", "left_anti")
    out = kept.select("node", F.col("node").alias("source")).union(copies.select(F.explode(F.array(P.bare(F.col("c1")), P.bare(F.col("c2")))), P.bare(F.col("repeat"))))
    overlap = graph.select(F.col("u").alias("_u"), F.col("v").alias("_v"), "overlap")
    part = lambda a, b, x, y: copies.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("_u"), F.col(b).alias("_v"), F.col(x).alias("u"), F.col(y).alias("v")).join(overlap, ["_u", "_v"]).select("u", "v", "overlap")
    new = part("before", "repeat", "before", "c1").union(part("repeat", "loop", "c1", "loop")).union(part("loop", "repeat", "loop", "c2")).union(part("repeat", "behind", "c2", "behind"))
    gone = loops.select(P.bare(F.col("repeat")).alias("_g"))
    old = graph.join(gone, P.bare(F.col("u")) == F.col("_g"), "left_anti").join(gone, P.bare(F.col("v")) == F.col("_g"), "left_anti")
    arcs = old.select("u", "v", "overlap").unionByName(new).unionByName(new.select(P.flipped(F.col("v")).alias("u"), P.flipped(F.col("u")).alias("v"), "overlap")).distinct()
    return out, arcs


def tip_loops(graph: DataFrame, paths: DataFrame, cov: DataFrame, mean: float, k: int) -> DataFrame:
    """(node, copies): nodes with an arc to themselves and at most one other neighbour a side, walked round the
    k-th largest number of times in a path, where coverage is above 1.1 copies."""
    own = graph.where("u = v").select(P.bare(F.col("u")).alias("node")).distinct()
    degree = graph.groupBy("u").agg(F.countDistinct("v").alias("n")).groupBy(P.bare(F.col("u")).alias("node")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("sides")).where("most <= 2 AND sides = 2")
    ready = own.join(degree.select("node"), "node", "left_semi").join(cov.select("node", "coverage"), "node", "left").where(F.col("coverage").isNull() | (F.col("coverage") >= 1.1 * mean)).select("node")
    walks = paths.select("path", F.monotonically_increasing_id().alias("_p")).select("_p", F.explode(F.transform("path", P.bare)).alias("node")).groupBy("_p", "node").agg(F.count(F.lit(1)).alias("n"))
    top = walks.join(ready, "node", "left_semi").groupBy("node").agg(F.sort_array(F.collect_list("n"), asc=False).alias("s")).where(F.size("s") >= k)
    return top.select("node", F.element_at("s", k).alias("copies"))
