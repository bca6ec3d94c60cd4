"""Exact dedup with a persistent digest index (native: DataFrame and SQL operations only).

The index is a Parquet table of one row per distinct text ever added: the
SHA-256 digest of the normalised text and the id of the document that stays.
It is bucketed and sorted by the digest and partitioned by the load that added
the rows. A load works like this:

1. The texts are read once: (id, digest) rows are written.
2. They are aggregated to one row per digest, map-side first, so a text that a
   third of the rows share crosses the shuffle once per task.
3. Those rows meet the index in a sort-merge join on the digest. The index
   side is read by bucket and is never shuffled; an anti-join gives the new
   digests, which are appended.
4. Verdicts (one row per digest) go back to the rows by an equi join of
   narrow rows; Spark splits it where one digest has very many rows.

What is in the index stays there: a text of an earlier load wins over its
copies of a later one. Within a load, of equal texts the largest id stays.
A load is named; running it again after a failure overwrites its own
partition of the index, and its own rows are not taken for older ones.

Defined results: null text is the empty text, which has a digest like any
other; null ids come before all others (``keep_id`` is null only where all
copies lack an id). Rows that repeat both id and text are one document with
one answer, and all of them count in the size of the group. An empty table
adds nothing. Columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, scratch_path
from .storage import NO_ID, read, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 16
BUCKET_ROWS = 2_000_000


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of a text with A-Z in lower case; null is the empty text."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, digest) of every row, written: the texts are not needed again."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc")
    return written(docs.select(doc, digest(F.col(text_col)).alias("digest")), "digests")


class DigestIndex:
    """A digest index at ``path``.

    ``buckets`` belongs to the index: open it with the number it was made
    with. A bucket is what one task sorts and joins, so take the expected
    number of distinct texts over ``BUCKET_ROWS``. ``name``: the table's name in
    the session's catalog; the data outlive the session and its catalog.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, name: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        place = path.replace("'", "\\'")
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep BIGINT, load STRING) USING parquet
                      PARTITIONED BY (load) CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'""")
        if exists(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {self.name}")      # loads that other sessions added

    def rows(self) -> DataFrame:
        """(digest, keep, load)."""
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, load: str) -> DataFrame:
        """Add the (doc, digest) rows of a load; its verdicts, written: (digest, keep, copies, known).

        ``keep``: the id that stays; ``copies``: rows of this load; ``known``: the text was there before this load.
        """
        # Bucketed like the index, so neither the joins nor the append shuffle again.
        batch = written(rows.groupBy("digest").agg(F.max("doc").alias("own"), F.count(F.lit(1)).alias("copies")), "batch-digests")
        older = self.rows().where(F.col("load") != load).select("digest", "keep")
        new = batch.join(older.hint("merge"), "digest", "left_anti")
        known = batch.join(older.hint("merge"), "digest")
        verdicts = written(new.select("digest", F.col("own").alias("keep"), "copies", F.lit(False).alias("known"))
                           .unionByName(known.select("digest", "keep", "copies", F.lit(True).alias("known"))), "verdicts")
        fresh = verdicts.where(~F.col("known")).select("digest", "keep").repartition(self.buckets, "digest")
        fresh.createOrReplaceTempView(view := f"{self.name}_new")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (load = '{load}') SELECT digest, keep FROM {view}")
        self.spark.catalog.dropTempView(view)
        return verdicts

    def close(self) -> None:
        """Forget the table's name; the data stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def unique(docs: DataFrame, index: DigestIndex, load: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay after this load, with all their columns."""
    rows = digests(docs, id_col, text_col)
    kept = index.add(rows, load).where(~F.col("known")).select(F.col("digest").alias("_digest"), F.col("keep").alias("_keep"))
    marked = docs.withColumns({"_digest": digest(F.col(text_col)),
                               "_keep": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))})
    return marked.join(kept, ["_digest", "_keep"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def decisions(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of (doc, digest) rows, from the verdicts of all their loads."""
    whole = verdicts.groupBy("digest").agg(F.max("keep").alias("keep"), F.sum("copies").alias("copies"))
    groups = written(whole.where((F.col("copies") > 1)), "groups")        # a text of its own needs no join
    keep = F.coalesce("keep", "doc")
    return rows.join(groups, "digest", "left").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        F.when(keep != NO_ID, keep).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        (keep == F.col("doc")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two loads into a new index: the later half of the ids
    first, so that what the second load finds in the index has the larger id."""
    rows = digests(read(spark, sf_dir, "documents"))
    middle, n = rows.agg(F.percentile_approx("doc", F.lit(0.5)), F.count(F.lit(1))).first()
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), max(BUCKETS, math.ceil(n / BUCKET_ROWS)))
    later = F.col("doc") >= F.lit(middle if middle is not None else 0)
    verdicts = index.add(rows.where(later), "later").unionByName(index.add(rows.where(~later), "earlier"))
    index.close()
    return decisions(rows, verdicts)
