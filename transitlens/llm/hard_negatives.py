"""Hard-negative mining by angular triangle filtering, with exact integer scores.

Every row stores its angles to a few *reference directions*. For two vectors
the triangle inequality on the sphere bounds their angle through each
direction: |s - t| <= angle <= min(s + t, 2 pi - s - t). The best bounds over all
directions give an interval of the cosine; times the norms it is an interval
of the score, widened by more than rounding can move it. Rows are kept in
*windows*: runs of up to ``WINDOW`` rows of the same nearest direction and
neighbouring angles, with the ranges of their angles and norms. Of a window
all bounds are taken at once, and only windows whose bounds reach what an
anchor still looks for get integer scores. So the filter changes the work,
never the result, whatever the directions are. How much it skips depends on the
data: much where vectors form groups, next to nothing where they point in
all directions alike.

Steps, all Spark jobs over written tables:

1. ``prepared``: valid rows with integer components, norm and angles, dealt by
   range of (nearest direction, angle) to groups of windows.
2. ``seeds``: the anchors of a group look for their positives among the rows
   of that group; the last score found is where the search over all groups may stop.
3. ``positives``: every anchor against every group in blocks: first rows of its label.
4. ``negatives``: the same search, with one score range for each positive.

A search deals out anchors and rows as a grid of tasks: a task holds one
group of rows (about ``GROUP_VALUES`` components at most) and streams one slice of the
anchors past it, so neither side is broadcast, collected or bound to one task.
Each task returns the first few per anchor and range; a window keeps the
first few of all tasks.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; rows of equal id, label and components are one
row. Other rows that repeat an id are rows of their own. Equal scores are
ordered by id, then by content. Missing components of the shorter of two
vectors are zeros; an empty vector has the score 0 with all. Components
and scores beyond 64 bits stay at the largest 64-bit value. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import read, written

WINDOW = 256             # rows that are skipped or scored together
GROUP_VALUES = 1 << 23   # components that a task holds (131,072 rows of 64)
CHUNK = 256              # anchors that are scored together
DIRECTIONS = 16
SAMPLE = 4096            # rows that the directions are fitted on; results do not depend on them
SLACK = 1e-6             # radians, far above the rounding of a stored angle
TOP = (1 << 63) - 1


# ------------------------------------------------------------------ vectors

def matrix(column: pa.Array) -> np.ndarray:
    """A list<long> column as rows of doubles, shorter ones filled with zeros (object numbers where doubles are not exact)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    exact = flat.size == 0 or int(np.abs(flat.astype(float)).max()) ** 2 * max(1, int(size.max())) < 1 << 52
    out = np.zeros((len(size), int(size.max(initial=0))), float if exact else object)
    out[np.arange(out.shape[1]) < size[:, None]] = flat if exact else flat.astype(object)
    return out


def fixed(column: pa.ChunkedArray) -> np.ndarray:
    """A list<double> column of one length."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def widened(a: np.ndarray, dim: int) -> np.ndarray:
    return a if a.shape[1] == dim else np.hstack([a, np.zeros((len(a), dim - a.shape[1]), a.dtype)])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products (64 bits): doubles where they hold every sum exactly, else Python integers."""
    dim = max(a.shape[1], b.shape[1])
    a, b = widened(a, dim), widened(b, dim)
    most = [float(np.abs(x).max()) if x.size else 0.0 for x in (a, b)]
    if a.dtype != object and b.dtype != object and most[0] * most[1] * dim < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b)]
    out = [[max(-TOP - 1, min(TOP, sum(map(int.__mul__, x, y)))) for y in whole[1]] for x in whole[0]]
    return np.array(out, np.int64).reshape(len(a), len(b))


def norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a.astype(float) ** 2).sum(1))


def angles(a: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles to unit directions; a right angle for the zero vector, whose scores are 0 anyway."""
    dim = max(a.shape[1], directions.shape[1])
    n = norms(a)
    cos = widened(a.astype(float), dim) @ widened(directions, dim).T / np.where(n > 0, n, 1)[:, None]
    return np.arccos(np.clip(cos, -1, 1))


def fitted(sample: np.ndarray, n: int = DIRECTIONS, rounds: int = 8) -> np.ndarray:
    """Unit directions: spherical k-means of a sample, started at rows far from those before."""
    unit = sample / np.maximum(norms(sample), 1e-300)[:, None]
    unit = unit[norms(unit) > 0.5]
    if not len(unit):
        return np.zeros((1, max(1, sample.shape[1])))
    at, near = [0], unit @ unit[0]
    for _ in range(min(n, len(unit)) - 1):
        at.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[at[-1]])
    out = unit[at]
    for _ in range(rounds):
        own = (unit @ out.T).argmax(1)
        mean = np.stack([unit[own == j].sum(0) if (own == j).any() else out[j] for j in range(len(out))])
        size = norms(mean)[:, None]
        out = np.where(size > 1e-9, mean / np.maximum(size, 1e-300), out)
    return out


# ------------------------------------------------------------------ one group of rows

class Group:
    """Rows of one group, cut into windows with the ranges of their angles and norms."""

    def __init__(self, t: pa.Table):
        self.id, self.label, self.tie = (t[c].to_numpy() for c in ("vec_id", "label", "tie"))
        self.comps = matrix(t["comps"])
        self.norm = t["norm"].to_numpy()
        self.angle = fixed(t["angles"])
        near = t["near"].to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
        self.start = np.concatenate([np.arange(a, b, WINDOW) for a, b in zip(edge, [*edge[1:], len(near)])])
        self.end = np.concatenate((self.start[1:], [len(near)]))
        self.low, self.high = (f.reduceat(self.angle, self.start) for f in (np.minimum, np.maximum))
        self.least, self.most = (f.reduceat(self.norm, self.start) for f in (np.minimum, np.maximum))
        self.seen = self.scored = 0

    def bounds(self, angle: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) score of every anchor with the rows of every window."""
        a = angle[:, None, :]
        near = np.maximum(np.maximum(a - self.high, self.low - a).max(2) - SLACK, 0)
        far = np.minimum(np.minimum(a + self.high, 2 * math.pi - a - self.low).min(2) + SLACK, math.pi)

        def outer(cos, up):
            end = np.where((cos >= 0) == up, self.most, self.least)
            room = 1 + 1e-9 * norm[:, None] * self.most
            return norm[:, None] * end * cos + (room if up else -room)

        return outer(np.cos(far), False), outer(np.cos(near), True)

    def best(self, q: dict, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> Iterator[tuple]:
        """(anchor, range, row, score) arrays: for every anchor and score range [low, high] its first k rows.

        ``same``: rows of the anchor's label other than itself, else rows of other labels.
        """
        n, ranges = low.shape
        need = low.copy()                        # what a row must reach to be among the first k
        least, most = self.bounds(q["angle"], q["norm"])
        found = [np.empty(0, np.int64)] * 4
        waiting, size = [], 0
        top = high.max(1, initial=-TOP)

        def settle():
            nonlocal found, waiting, size
            if not waiting:
                return
            new = [np.concatenate(x) for x in zip(*waiting)]
            waiting, size = [], 0
            rows = [found]
            for w in range(ranges):
                ok = (new[2] >= need[new[0], w]) & (new[2] <= high[new[0], w])
                rows.append([new[0][ok], np.full(ok.sum(), w), new[1][ok], new[2][ok]])
            a, w, r, s = (np.concatenate(x) for x in zip(*rows))
            order = np.lexsort((self.tie[r], self.id[r], -s, w, a))
            a, w, r, s = a[order], w[order], r[order], s[order]
            first = np.concatenate(([True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])))
            at = np.arange(len(a))
            rank = at - np.maximum.accumulate(np.where(first, at, 0))
            last = rank == k - 1
            need[a[last], w[last]] = s[last]      # equal scores may still win by their id
            found = [x[rank < k] for x in (a, w, r, s)]

        for i in np.argsort(-most.max(0), kind="stable"):
            self.seen += n
            use = np.flatnonzero((most[:, i] >= need.min(1)) & (least[:, i] <= top))
            if not len(use):
                continue
            self.scored += len(use)
            span = slice(self.start[i], self.end[i])
            s = scores(q["comps"][use], self.comps[span])
            ok = (s >= need.min(1)[use][:, None]) & (s <= top[use][:, None])
            ok &= (q["label"][use][:, None] == self.label[span]) == same
            if same:
                ok &= (q["vec_id"][use][:, None] != self.id[span]) | (q["tie"][use][:, None] != self.tie[span])
            a, r = np.nonzero(ok)
            waiting.append((use[a], r + span.start, s[a, r]))
            size += len(a)
            if size > 20_000 or not len(found[0]):
                settle()
        settle()
        return tuple(found)


def anchor_rows(t: pa.Table) -> dict:
    return {"vec_id": t["vec_id"].to_numpy(), "label": t["label"].to_numpy(), "tie": t["tie"].to_numpy(),
            "comps": matrix(t["comps"]), "norm": t["norm"].to_numpy(), "angle": fixed(t["angles"])}


def limits(t: pa.Table, column: str, fill: int) -> np.ndarray:
    """A list<long> column as a matrix; ranges that an anchor does not have are empty ones."""
    rows = t[column].to_pylist()
    out = np.full((len(rows), max(map(len, rows), default=0)), fill, np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


FOUND = "anchor long, anchor_tie long, place int, vec_id long, tie long, score long"


def searched(k: int, same: bool):
    """Task function over batches sorted by cell: the rows of a cell, then the anchors that look through them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = group = None
        rows: list[pa.Table] = []
        for batch in batches:
            t = pa.Table.from_batches([batch])
            number, anchor = t["cell"].to_numpy(), t["anchor"].to_numpy(zero_copy_only=False).astype(np.int64)
            key = number * 2 + anchor
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for a, b in zip(edge, [*edge[1:], len(key)]):
                part = t.slice(a, b - a)
                if number[a] != cell:
                    cell, group, rows = number[a], None, []
                if not anchor[a]:
                    rows.append(part)
                    continue
                if not rows and group is None:      # no rows in this cell
                    continue
                if group is None:
                    group, rows = Group(pa.concat_tables(rows)), []
                for c in range(0, part.num_rows, CHUNK):
                    some = part.slice(c, CHUNK)
                    q = anchor_rows(some)
                    i, w, r, s = group.best(q, limits(some, "low", TOP), limits(some, "high", -TOP), k, same)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (q["vec_id"][i], q["tie"][i], w.astype(np.int32), group.id[r], group.tie[r], s)],
                        ["anchor", "anchor_tie", "place", "vec_id", "tie", "score"])
    return run


# ------------------------------------------------------------------ jobs

def valid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, comps, tie) of the rows that take part, each once. ``tie``: a hash of label and components."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                      F.transform(x, lambda v: F.floor(v * 256).cast("long")).alias("comps"))
    return out.withColumn("tie", F.xxhash64("label", "comps"))


PREPARED = "vec_id long, label long, comps array<long>, tie long, norm double, angles array<double>, near int, angle double"


def prepared(rows: DataFrame) -> DataFrame:
    """Rows with norm, angles and nearest direction, written in groups by range: column ``part``."""
    spark = rows.sparkSession
    rows = written(rows.distinct(), "vectors")
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("comps")), F.lit(0))).first()
    sample = rows.select("comps").orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id", "tie").limit(SAMPLE).toArrow()
    directions = fitted(matrix(sample["comps"]).astype(float)) if n else np.zeros((1, 1))

    def measured(batches):
        for b in batches:
            comps = matrix(b["comps"])
            angle = angles(comps, directions)
            near = angle.argmin(1)
            own = angle[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(norms(comps)), pa.array(list(angle), pa.list_(pa.float64())), pa.array(near.astype(np.int32)), pa.array(own)],
                [*b.schema.names, "norm", "angles", "near", "angle"])

    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * dim / GROUP_VALUES))
    order = ["near", "angle", "vec_id", "tie"]
    return written(rows.mapInArrow(measured, PREPARED).repartitionByRange(groups, *order)
                   .sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "prepared")


def first(found: DataFrame, k: int) -> DataFrame:
    """The first k of every anchor and place, with their rank."""
    w = Window.partitionBy("anchor", "anchor_tie", "place").orderBy(F.desc("score"), "vec_id", "tie")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool, grid: bool = True) -> DataFrame:
    """The first k rows of every anchor (with ``low`` and ``high``: one score range each) as FOUND rows, not yet merged.

    ``grid``: every anchor against all groups; else against its own one only.
    """
    names = ["vec_id", "label", "tie", "comps", "norm", "angles"]
    none = F.array().cast("array<long>")
    left = rows.select("part", F.lit(False).alias("anchor"), *names, "near", "angle", none.alias("low"), none.alias("high"))
    right = anchors.select("part", F.lit(True).alias("anchor"), *names, "near", "angle", "low", "high")
    parts = rows.agg(F.coalesce(F.max("part"), F.lit(-1))).first()[0] + 1
    values = anchors.agg(F.coalesce(F.sum(F.size("comps")), F.lit(0))).first()[0]
    slices = max(1, math.ceil(values / GROUP_VALUES)) if grid else 1
    if grid:
        own = F.pmod(F.xxhash64("vec_id"), F.lit(slices))
        left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")).withColumn("cell", F.col("part") * slices + F.col("slice"))
        right = right.withColumn("slice", own.cast("int")).select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p")) \
            .withColumn("cell", F.col("p") * slices + F.col("slice"))
    else:
        left, right = (x.withColumn("cell", F.col("part")) for x in (left, right))
    columns = ["cell", "anchor", *names, "near", "angle", "low", "high"]
    both = left.select(columns).unionByName(right.select(columns))
    dealt = both.repartitionById(max(1, parts * slices), F.col("cell").cast("int")).sortWithinPartitions("cell", "anchor", "near", "angle")
    return dealt.mapInArrow(searched(k, same), FOUND)


def mined(vectors: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of valid rows (see ``valid``) for the anchors whose id ``every`` divides.

    An anchor's positives are its first ``n_positives`` other rows of its label. For each, the first
    ``n_negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    rows = prepared(vectors)
    anchors = rows.where(F.col("vec_id") % every == 0)
    all_scores = {"low": F.array(F.lit(-TOP - 1)), "high": F.array(F.lit(TOP))}
    here = first(search(rows, anchors.withColumns(all_scores), n_positives, True, grid=False), n_positives)
    seeds = here.where(F.col("rank") == n_positives).select(F.col("anchor").alias("vec_id"), F.col("anchor_tie").alias("tie"), F.array("score").alias("seed"))
    seeded = written(anchors.withColumns(all_scores).join(seeds, ["vec_id", "tie"], "left").withColumn("low", F.coalesce("seed", "low")), "seeded")
    positives = written(first(search(rows, seeded, n_positives, True), n_positives)
                        .select("anchor", "anchor_tie", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score")), "positives")

    # Rounded inwards, without leaving 64 bits. A negative positive_score has no range; scores fall with the place, so the rest are 0, 1, ...
    whole, rest = F.expr("positive_score div 100"), F.col("positive_score") % 100
    ranges = (positives.where(F.col("positive_score") >= 0)
              .withColumn("from", whole * low + F.ceil(rest * low / 100)).withColumn("to", whole * high + F.floor(rest * high / 100))
              .groupBy("anchor", "anchor_tie").agg(F.sort_array(F.collect_list(F.struct("place", "from", "to"))).alias("ranges"))
              .select(F.col("anchor").alias("vec_id"), F.col("anchor_tie").alias("tie"),
                      F.col("ranges.from").alias("low"), F.col("ranges.to").alias("high")))
    asked = written(anchors.join(ranges, ["vec_id", "tie"]), "asked")
    negatives = first(search(rows, asked, n_negatives, False), n_negatives)
    return negatives.join(positives, ["anchor", "anchor_tie", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all embeddings, with the stated change of labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(valid(read(spark, sf_dir, "embeddings").withColumn("label", label)))
