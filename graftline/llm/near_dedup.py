"""MinHash near-duplicates by bottom-k sketches from one hash function.

1. Each document becomes its set of word shingles, hashed to 64 bits; its sketch is the KEEP
   smallest hashes. Texts of equal words (by SHA-256) form a class, named by its smallest identifier.
2. Inverted lists: keys are runs of RUN consecutive retained values (half of them, chosen by hash, for sets
   larger than the sketch; single values for tiny sets). Two sets over the threshold share many runs.
   Sets as large as the sketch or smaller share a key with certainty, larger ones with a probability that
   differs from 1 by less than 1e-5 at the threshold itself (tests measure it).
3. Every member of a list is compared with the list's leader: union sketches estimate the similarity and
   drop pairs far below the threshold, the full sets confirm the rest: shingles count as equal only when
   their words are, byte for byte, so no link rests on a hash. Confirmed links make components.
4. Lists whose members are not all connected by then are finished exactly: short ones by all pairs from
   different components, long ones in blocks of bounded size, in which the members outside the list's
   largest component meet all members; a block returns links of a spanning forest only. So no link that
   joins components is lost, and no group of copies is expanded into all its pairs.
5. Components of all links give the classes.

Scale: texts are read twice; only documents on some list travel, compressed, and are kept in the shared folder.
Hot classes and keys are combined before shuffles, or met by joins that adaptive execution can split. A
long list of documents that share a passage but are no near-duplicates costs the square of its length in
comparisons, spread over blocks: the exact way has this price.

Defined results: words are cut at ASCII white space; with fewer words than a shingle, the whole sequence is one shingle;
null and wordless texts have no shingles and are linked with nothing; rows with the same identifier count as one
document, linked by it; a null identifier is kept and linked to nothing; identifiers are whole numbers. Other columns are
not read and may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, hinted, saved, table, tidied, without, written
from .word_hashes import chunks, exact_shingles, run_hash, shingle_sets

SHINGLE, PERCENT = 5, 80
KEEP = 64
RUN = 3
#: Sets up to TINY also have single values as keys, from LEAST on also runs.
TINY, LEAST = 10, 6
#: An estimate may be this much below the threshold: 5 standard deviations of KEEP draws.
MARGIN = 0.25
SHORT_LIST = 32
#: Shingles that a block of a long list holds, of members and of those outside the largest component.
BLOCK_ALL, BLOCK_FEW = 750_000, 300_000
#: Rows of the same.
ROWS_ALL, ROWS_FEW = 3_000, 1_500


def _keys(sketch: np.ndarray, n: int) -> np.ndarray:
    out = [sketch] if n <= TINY else []
    if n >= LEAST:
        runs = run_hash(sketch, np.arange(len(sketch) - RUN + 1), RUN)
        out.append(runs if n <= KEEP else runs[runs & np.uint64(1) == 0])
    return np.concatenate(out) if out else sketch[:0]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sketched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(batch.column(1)):
            h, n, good = exact_shingles(texts, size)
            h, count = (h, n) if good else shingle_sets(texts, size)
            kept = np.minimum(count, KEEP)
            place = np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept) + np.repeat(np.cumsum(count) - count, kept)
            whole = b"".join(hashlib.sha256(b" ".join(t.lower().split())).digest()[:16] for t in texts)
            digests = np.frombuffer(whole, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(n, pa.int64()), *(pa.array(digests[:, i]) for i in (0, 1)), _lists(h[place], kept)], names=["id", "n", "d1", "d2", "sketch"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches, n = batch.column(2), batch.column(1).to_numpy()
        keys = [_keys(s.values.to_numpy(zero_copy_only=False).view(np.uint64), int(m)) for s, m in zip(sketches, n, strict=True)]
        counts = np.fromiter(map(len, keys), np.int64, len(keys))
        flat = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
        rows = pa.array(np.repeat(np.arange(len(keys)), counts))
        yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(rows)], names=["key", "rep"])


def estimates(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Similarity of each pair: of the KEEP smallest values of both sketches' union, the share that both have."""
    both = np.full((len(a), 2 * KEEP), np.iinfo(np.uint64).max, np.uint64)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        both[i, : len(x)] = x
        both[i, len(x) : len(x) + len(y)] = y
    used = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.int64, len(a))
    both.sort(axis=1)
    real = np.arange(2 * KEEP) < used[:, None]
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    inside = (np.cumsum(real & ~again, axis=1) <= KEEP) & real
    return (again & inside).sum(1) / np.maximum(1, (inside & ~again).sum(1))


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = ([s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in batch.column(i)] for i in (2, 3))
        keep = pa.array(np.flatnonzero(estimates(a, b) >= least) if len(a) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in (0, 1)], names=["a", "b"])


def _confirmed(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        at = 0
        while at < len(batch):
            texts, first = [], at
            while at < len(batch) and (at == first or sum(map(len, texts)) < 1_000_000):
                texts += [(batch.column(i)[at].as_py() or "").encode("utf-8", "surrogatepass") for i in (2, 3)]
                at += 1
            h, count, _ = exact_shingles(texts, size)
            # Numbers of one pair that occur twice are in both sets.
            pair = np.repeat(np.arange(len(texts)) // 2, count)
            order = np.lexsort((h, pair))
            h, pair = h[order], pair[order]
            shared = np.bincount(pair[1:][(h[1:] == h[:-1]) & (pair[1:] == pair[:-1])], minlength=at - first)
            union = count[0::2] + count[1::2] - shared
            found.append(first + np.flatnonzero((100 * shared >= percent * union) & (shared > 0)))
        rows = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(i).take(rows) for i in (0, 1)], names=["a", "b"])


def _block_links(group: pa.Table, size: int, percent: int) -> pa.Table:
    """Links of a spanning forest between the `few` rows and all rows of a block, beyond the given components."""
    group = group.combine_chunks()
    reps, labels, few = (group.column(c).to_pylist() for c in ("rep", "comp", "few"))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def linked(i: int, j: int) -> bool:
        """Whether the texts are linked, by their words and not by hashes of these."""
        h, c, _ = exact_shingles([(column[k].as_py() or "").encode("utf-8", "surrogatepass") for k in (i, j)], size)
        shared = int(c.sum()) - len(np.unique(h))
        return 100 * shared >= percent * (int(c.sum()) - shared)

    sets, counts = [], []
    column = group.column("text").chunk(0) if group.num_rows else pa.array([], pa.string())
    for _, texts in chunks(column):
        h, c = shingle_sets(texts, size)
        sets.append(h)
        counts.append(c)
    links = []
    if sets:
        count = np.concatenate(counts)
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(count) - count
        full = count > 0
        for i in (i for i, f in enumerate(few) if f and count[i]):
            mark = np.zeros(len(values), np.int32)
            mark[flat[starts[i] : starts[i] + count[i]]] = 1
            shared = np.zeros(len(count), np.int64)
            shared[full] = np.add.reduceat(mark[flat], starts[full])
            for j in np.flatnonzero((100 * shared >= percent * (count + count[i] - shared)) & full).tolist():
                x, y = root(labels[i]), root(labels[j])
                if x != y and linked(i, j):
                    parent[max(x, y)] = min(x, y)
                    links.append((reps[i], reps[j]))
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: id, n (shingles), component. Identifiers are whole numbers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    digest = ["n", "d1", "d2"]
    sketches = written(rows.mapInArrow(lambda it: tidied(_sketched(it, size)), "id long, n long, d1 long, d2 long, sketch array<long>"))
    named = sketches.where("n > 0 AND id IS NOT NULL")
    classes = named.groupBy(*digest).agg(F.min("id").alias("rep"))
    owners = classes.select(*[F.col(c).alias(f"_{c}") for c in digest], "rep")
    own = (F.col("id") == F.col("rep")) & (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    reps = written(named.join(owners, own).select("rep", "n", "d1", "d2", "sketch").dropDuplicates(["rep", "d1", "d2"]))

    keys = reps.select("rep", "n", "sketch").mapInArrow(lambda it: tidied(_keyed(it)), "key long, rep long")
    lists = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("low"), F.min_by("rep", F.xxhash64("rep", "key")).alias("any")).where("m > 1")
    leader = F.when((F.col("m") > SHORT_LIST) & (F.pmod(F.col("key"), F.lit(8)) == 0), F.col("any")).otherwise(F.col("low"))
    members = written(keys.join(lists.select("key", "m", leader.alias("leader")), "key"))

    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    on_lists = members.select(F.col("rep").alias("_rep")).distinct()
    some = reps.join(hinted(saved(on_lists)), F.col("rep") == F.col("_rep"), "left_semi").select("rep", "d1", "d2", "sketch")
    some = written(some)
    wanted = some.select(F.col("rep").alias("_rep")).distinct()
    texts = rows.join(hinted(wanted), F.col("id") == F.col("_rep"), "left_semi")
    if _repeats(sketches):  # an identifier with several texts stays with each of them
        texts = texts.withColumn("_h", F.xxhash64("text")).dropDuplicates(["id", "_h"]).drop("_h")
    texts = written(texts)
    one = some.select("rep", "sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left, right = (one.select(F.col("rep").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab")
        likely = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(lambda it: tidied(_likely(it, percent / 100 - MARGIN)), "a long, b long")
        left, right = (texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
        both = likely.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
        return saved(both.mapInArrow(lambda it: tidied(_confirmed(it, size, percent)), "a long, b long"))

    first = confirmed(members.select(*pair("rep", "leader")).where("a <> b").distinct())
    label = components(first)
    known = label.select(F.col("node").alias("rep"), "label")
    labelled = members.join(hinted(known), "rep", "left").select("key", "m", "rep", F.coalesce("label", "rep").alias("comp"))
    sizes = labelled.groupBy("key", "m", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("s"))
    open_ = sizes.groupBy("key", "m").agg(F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("p"), F.sum("s").alias("s")).where("p > 1")
    # Lists with the same members are the same work.
    open_ = saved(open_.groupBy("m", "s").agg(F.min(F.struct("key", "top")).alias("x")).select("m", F.col("x.key").alias("key"), F.col("x.top.comp").alias("top")))
    left = written(labelled.join(hinted(open_.select("key", "top")), "key"))

    short = left.where(F.col("m") <= SHORT_LIST).groupBy("key").agg(F.collect_list(F.struct("rep", "comp")).alias("l"))
    x = short.select("l", F.explode("l").alias("x"))
    y = x.select("x", F.explode(F.filter("l", lambda e: (e["rep"] > F.col("x.rep")) & (e["comp"] != F.col("x.comp")))).alias("y"))
    links = first.unionByName(confirmed(y.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()))

    long_ = left.where(F.col("m") > SHORT_LIST)
    if not long_.isEmpty():
        sized = written(long_.join(reps.groupBy("rep").agg(F.max("n").alias("n")), "rep").withColumn("few", F.col("comp") != F.col("top")))
        blocks = lambda some, shingles, most: F.ceil(F.greatest(F.sum(F.when(some, F.col("n"))) / shingles, F.count(F.when(some, 1)) / most)).cast("int")
        parts = sized.groupBy("key").agg(blocks(F.lit(True), BLOCK_ALL, ROWS_ALL).alias("pa"), blocks(F.col("few"), BLOCK_FEW, ROWS_FEW).alias("pf"))
        dealt = sized.join(hinted(parts), "key")
        at = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
        every = dealt.select("key", "rep", "comp", F.lit(False).alias("few"), at("pa", 1).alias("i"), F.explode(F.expr("sequence(0, pf - 1)")).alias("j"))
        few = dealt.where("few").select("key", "rep", "comp", "few", F.explode(F.expr("sequence(0, pa - 1)")).alias("i"), at("pf", 2).alias("j"))
        block = every.unionByName(few).join(texts.select(F.col("id").alias("rep"), "text"), "rep")
        found = block.groupBy("key", "i", "j").applyInArrow(lambda t: _block_links(t, size, percent), "a long, b long")
        links = links.unionByName(saved(found.select(*pair("a", "b")).distinct()))

    # Rows with one identifier are one document: its sets are linked through it.
    if _repeats(sketches):
        twice = hinted(saved(_repeated_ids(sketches)))
        links = links.unionByName(named.join(twice, F.col("id") == F.col("_id"), "left_semi").select("id", *digest).join(classes, digest).select(*pair("id", "rep")).where("a <> b"))
    final = components(links)
    placed = sketches.drop("sketch").join(owners, (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left")
    placed = placed.join(hinted(final), F.col("rep") == F.col("node"), "left")
    return placed.select("id", "n", F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("label", "rep")).alias("component"))


def _repeated_ids(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("id").count().where("count > 1 AND id IS NOT NULL").select(F.col("id").alias("_id"))


def _repeats(sketches: DataFrame) -> bool:
    return not _repeated_ids(sketches).isEmpty()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs without the rows whose component has a smaller identifier; columns unchanged."""
    lost = saved(near_components(docs, id_col, text_col, size, percent).where("id <> component").select("id").distinct())
    return without(docs, id_col, lost)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_components(table(spark, sf_dir, "documents"), size=3, percent=85)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
