"""Near-dedup with circulant MinHash (operator 4).

One permutation (sigma) shuffles the shingle universe, a second one (pi),
circularly shifted by k places, gives signature coordinate k:
``h_k(S) = min over v in S of pi(sigma(v) + k)``, all modulo 2**32. Bands of
coordinates bucket the documents; every link is confirmed on the full sets of
64-bit shingle hashes.

Work that does not grow with the square of a group:
* documents with the same shingle set are one node (found by a 128-bit set hash);
* a bucket's members are compared with one member of the bucket, the one
  that meets the most documents over all bands, and the links give components;
* only members of buckets that still hold several components are compared
  further, over a prefix-filter join (pairs at the threshold share one of
  their rarest shingles), which is exact, so no link is lost to the stars.

Defined cases: null or empty texts have no shingles and are components of
their own; a text with fewer words than a shingle is one shingle; rows with the
same id and text are one document; a null id counts as the smallest id; other
columns of the input are ignored; an empty table gives an empty result.
Signature misses: two sets at the threshold miss all bands with probability
(1 - 0.8**5)**36 < 1e-6, or (1 - 0.85**7)**36 < 1e-6 with the seven rows of
the query for 0.85; more rows make fewer accidental meetings.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as X
from .components import components
from .storage import free, given_id, identified, read, written

ROWS = 5                # coordinates of a band, for a similarity of 0.8
BANDS = 36


def _bijection(x: np.ndarray, tmp: np.ndarray, m1: int, m2: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place (xor-shifts and odd multipliers)."""
    for shift, mult in ((16, m1), (13, m2), (16, None)):
        np.right_shift(x, np.uint32(shift), out=tmp)
        np.bitwise_xor(x, tmp, out=x)
        if mult:
            np.multiply(x, np.uint32(mult), out=x)
    return x


def sigma(v: np.ndarray) -> np.ndarray:
    return _bijection(v.astype(np.uint32), np.empty(len(v), np.uint32), 0x7FEB352D, 0x846CA68B)


def pi(v: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    return _bijection(v, tmp, 0x85EBCA6B, 0xC2B2AE35)


def signatures(shingles: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    """k coordinates of every set; set i holds shingles[start[i]:start[i + 1]] and is not empty."""
    base = sigma(shingles >> X.U(32))
    out = np.empty((len(start), k), np.uint32)
    x, tmp = np.empty_like(base), np.empty_like(base)
    for j in range(k):
        np.add(base, np.uint32(j), out=x)                    # the shift, modulo 2**32
        out[:, j] = np.minimum.reduceat(pi(x, tmp), start)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, k = sig.shape
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64), (n, k // rows)).copy()
    for j in range(rows):
        key = X.mix64(key * X.U(X._MULT) + sig[:, j::rows].astype(np.uint64))
    return key


def shingle_sets(b: X.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, row of each), rows ascending; texts of fewer than k words are one shingle."""
    ws, we, row = b.words()
    wh = X.span_hashes(b.sums(b.lower()), ws, we)
    at, h = X.window_hashes(wh, row, k)
    r = row[at]
    n = np.bincount(row, minlength=b.n)
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    for w in range(1, k):
        few = np.flatnonzero(n == w)
        if len(few):
            h = np.concatenate((h, X.span_hashes(X.prefix_sums(wh, X._WMULT), first[few], first[few] + w, X._WMULT)))
            r = np.concatenate((r, few))
    _, i = np.unique(X.in_row(h, r), return_index=True)
    i = i[np.lexsort((h[i], r[i]))]
    return h[i], r[i]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values))


def signed(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """(doc, tk, n, s1, s2, bands) of every row: set size, 128-bit set hash, band keys (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in X.blocks(batch.column(2)):
                h, r = shingle_sets(b, k)
                n = np.bincount(r, minlength=b.n)
                full = np.flatnonzero(n)
                s = np.zeros((2, b.n), X.U)
                keys = np.zeros((0, bands), np.uint64)
                if len(full):
                    start = np.concatenate(([0], np.cumsum(n[full])))[:-1]
                    for i in range(2):
                        s[i, full] = np.add.reduceat(X.mix64(h ^ X.U(0x5851F42D4C957F2D * (i + 1) & (2**64 - 1))), start)
                    keys = band_keys(signatures(h, start, rows * bands), rows)
                size = np.where(n > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, b.n), batch.column(1).slice(b.first, b.n), pa.array(n.astype(np.int64)),
                     pa.array(X.as_i64(s[0])), pa.array(X.as_i64(s[1])), _lists(X.as_i64(keys.reshape(-1)), size)],
                    names=["doc", "tk", "n", "s1", "s2", "bands"])

    return docs.select("doc", "tk", "text").mapInArrow(
        run, "doc bigint, tk bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>")


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, n, shingles) of rows (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in X.blocks(batch.column(1)):
                h, r = shingle_sets(b, k)
                n = np.bincount(r, minlength=b.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.first, b.n), pa.array(n.astype(np.int64)), _lists(X.as_i64(h), n)], names=["node", "n", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node bigint, n bigint, shingles array<bigint>")


def _once(rows: DataFrame, again: DataFrame) -> DataFrame:
    """One of the equal rows of each (doc, tk). ``again``: the (doc, tk) that repeat, few or none; only their rows are sorted."""
    marked = rows.join(again.withColumn("again", F.lit(True)), ["doc", "tk"], "left")
    single = marked.filter("again IS NULL").drop("again")
    return single.unionByName(marked.filter("again").drop("again").dropDuplicates(["doc", "tk"]))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity: 100 * intersection >= percent * union."""
    a = sets.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("shingles").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("shingles").alias("sv"))
    sized = (pairs.join(a.drop("su"), "u").join(b.drop("sv"), "v")
             .filter(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")).select("u", "v"))
    both = F.size(F.array_intersect("su", "sv")).cast("long")
    return (sized.join(a, "u").join(b, "v")
            .filter(100 * both >= percent * (F.col("nu") + F.col("nv") - both)).select("u", "v"))


CLASSES = 50            # size classes per factor e, for the prefix join


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(pairs, the written tables that they read). Pairs of members (node, label) under other labels that can reach the similarity, by a positional prefix join.

    Shingles are ordered by how many members have them, rarest first; those of one member alone come first and cannot
    be shared. Sets of sizes m <= n at the threshold share ``need = percent * (m + n) / (100 + percent)``, so
    they share one of the first ``n - need + 1`` of the larger and of the smaller. The larger set looks up each class of partner
    sizes with the prefix for that class, so a variant with many shingles of its own looks up nothing among sets of its size:
    a passage or a group of copies pairs nobody by itself.
    """
    whole = written(members.select("node").join(sets, "node").select("node", F.explode("shingles").alias("t")), "rest-tokens")
    counts = whole.groupBy("t").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    ordered = whole.join(counts, "t").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("ts"))
    shared = written(ordered.join(members.join(sets.select("node", "n"), "node"), "node"), "rest-shared")
    own = F.col("n") - F.size("ts")
    need = lambda m: F.ceil((m + F.col("n")) * percent / (100 + percent))
    size_class = lambda n: F.floor(F.log(n.cast("double")) * CLASSES)
    least = F.ceil(F.col("n") * percent / 100)

    def prefix(rows: DataFrame, length: Column) -> DataFrame:
        keep = F.greatest(F.lit(0), F.least(F.size("ts").cast("long"), length - own)).cast("int")
        return (rows.select("node", "label", "n", own.alias("own"), "class", F.posexplode(F.slice("ts", F.lit(1), keep)).alias("i", "x"))
                .select("node", "label", "n", "class", F.col("x.t").alias("t"), (F.col("own") + F.col("i") + 1).alias("at")))

    small = prefix(shared.withColumn("class", size_class(F.col("n"))), F.col("n") - need(F.col("n")) + 1)
    classes = F.sequence(size_class(least), size_class(F.col("n")))
    # the least size of a class, rounded down, makes the prefix long enough for all of it
    from_size = F.greatest(least, F.floor(F.exp(F.col("class") / CLASSES)))
    large = prefix(shared.withColumn("class", F.explode(classes)), F.col("n") - need(from_size) + 1)
    large, small = written(large, "rest-large"), written(small, "rest-small")
    free(whole, shared)
    a = large.select(F.col("node").alias("u"), F.col("label").alias("lu"), F.col("n").alias("nu"), F.col("at").alias("iu"), "class", "t")
    b = small.select(F.col("node").alias("v"), F.col("label").alias("lv"), F.col("n").alias("nv"), F.col("at").alias("iv"), "class", "t")
    possible = (1 + F.least(F.col("nu") - F.col("iu"), F.col("nv") - F.col("iv"))) * (100 + percent) >= percent * (F.col("nu") + F.col("nv"))
    pairs = (a.join(b, ["class", "t"])
             .filter((F.col("lu") != F.col("lv")) & (F.col("nu") >= F.col("nv")) & (100 * F.col("nv") >= percent * F.col("nu")) & possible)
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return pairs, [large, small]


def _labelled(rows: DataFrame, labels: DataFrame, node: str = "node") -> DataFrame:
    return (rows.join(labels.withColumnRenamed("node", node), node, "left")
            .withColumn("label", F.coalesce("label", F.col(node))))


@contextmanager
def _filtered_early(spark: SparkSession):
    """Lets Spark put a Bloom filter of the smaller side (8 MB at most, whatever the input) in front of the larger one's shuffle."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    wanted = {f"{prefix}.enabled": "true", f"{prefix}.applicationSideScanSizeThreshold": "0", f"{prefix}.creationSideThreshold": "10g"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tk, n_shingles, root): every row with the least (doc, tk) of its component."""
    src = identified(docs, id_col, text_col)
    signatures = written(signed(src, k, rows, bands), "signatures")
    name = F.struct("doc", "tk")
    # a node is a distinct set; inside, nodes are numbers
    nodes = written(signatures.filter("n > 0").groupBy("s1", "s2").agg(F.min(name).alias("name"), F.first("bands").alias("bands"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    sig = written(signatures.drop("bands"), "rows")
    free(signatures)
    again = written(sig.groupBy("doc", "tk").count().filter("count > 1").select("doc", "tk"), "again")
    member = nodes.select("node", F.explode("bands").alias("key"))
    # One centre per bucket: the member that meets the most documents over all its buckets, which is the likely origin of
    # a group of copies; so a group is compared with few centres. (The rest is compared exactly below.)
    size = member.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = written(member.join(size, "key"), "met")
    known = met.groupBy("node").agg(F.sum("size").alias("met"))
    ranked = written(met.select("key", "node").join(known, "node"), "ranked")
    centre = ranked.groupBy("key").agg(F.max(F.struct("met", F.xxhash64("node"), "node")).alias("c")).select("key", F.col("c.node").alias("v"))
    shared = written(ranked.select("key", "node").join(centre, "key"), "shared-buckets")
    free(met, ranked)
    stars = written(shared.filter("node != v").select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct(),
                    "stars")
    used = stars.select(F.col("u").alias("node")).unionByName(stars.select(F.col("v").alias("node"))).distinct()
    wanted = written(nodes.select("node", "name.*").join(used, "node"), "wanted")
    with _filtered_early(docs.sparkSession):
        sets = written(_full_sets(_once(src.join(wanted.filter("node >= 0"), ["doc", "tk"]), again), k), "sets")
    links = written(confirmed(stars, sets, percent), "links")
    free(stars)
    labels = components(links)
    # buckets that still hold several components: compare their members exactly
    # (sets that reach the similarity are in the same or in neighbouring classes of this width)
    width = F.floor(F.log(F.col("n").cast("double")) / float(-1.001 * np.log(percent / 100)))
    inside = written(_labelled(shared.join(sets.select("node", "n"), "node"), labels)
                     .select("key", "node", "label", F.explode(F.array(width, width + 1)).alias("width")), "inside")
    free(shared)
    mixed = inside.groupBy("key", "width").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a != b")
    left = written(inside.join(mixed.select("key", "width"), ["key", "width"], "left_semi").select("node", "label").distinct(), "left-over")
    free(inside)
    pairs, read_by = _rest(left, sets, percent)
    more = written(confirmed(pairs, sets, percent), "more-links")
    free(left, sets, *read_by)
    if not more.isEmpty():
        # the first components are stars already: their links stand for all that made them
        labels = components(more.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
    # the least name of each component; a node without a link is its own
    linked = labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
    named = written(linked.join(nodes.select("node", "name"), "node"), "named")
    least = named.groupBy("label").agg(F.min("name").alias("root"))
    rooted = named.join(least, "label").select("node", "root")
    roots = (nodes.select("s1", "s2", "node", "name").join(rooted, "node", "left")
             .select("s1", "s2", F.coalesce("root", "name").alias("root")))
    return (sig.join(roots, ["s1", "s2"], "left")
            .select("doc", "tk", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root")).otherwise(name).alias("root")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of every component, with all its columns."""
    found = written(near_duplicates(docs, k, percent, rows, bands, id_col, text_col), "found")
    first = found.filter((F.col("doc") == F.col("root.doc")) & (F.col("tk") == F.col("root.tk"))).select("doc", "tk")
    counted = written(first.groupBy("doc", "tk").count(), "first")
    src = docs.select(F.struct("*").alias("row"), *identified(docs, id_col, text_col, columns=True)[:2])
    return _once(src.join(counted.select("doc", "tk"), ["doc", "tk"]), counted.filter("count > 1").select("doc", "tk")).select("row.*")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85, rows=7)
    return found.select(given_id(F.col("doc")).alias("doc_id"), "n_shingles", given_id(F.col("root.doc")).alias("component_id"),
                        (F.col("doc") == F.col("root.doc")).alias("kept"))
