"""Exact duplicates against a persistent index of text digests.

The index is a table of digests, bucketed and sorted by digest, that outlives a session.  A
batch of documents is hashed, grouped by digest (combined before the shuffle, so that a
text of which a third of all rows are copies costs a row per task), and sort-merge
anti-joined with the index: digests that the index lacks are appended, with the largest
doc_id of the batch as the row that stays.  Documents of later batches whose digest is
known go, and refer to the row that stayed before.

Texts are equal when their bytes are; null counts as empty.  Of rows that repeat both
doc_id and text one stays.  A missing doc_id is smaller than all others.  A batch that is
added again under its name changes nothing.  An empty batch gives no rows.  Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm.common import fresh, shared_path, stored

# Buckets of a new index: a billion digests are 15 million, or 0.6 GB, in each.
BUCKETS = 64
# Groups that hold more than this part of all rows are joined by broadcast: fewer than so many.
HOT_GROUPS = 4096


def digest_of(text: str | Column = "text") -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(column.cast("string"), F.lit("")).cast("binary"), 256))


def heads(docs: DataFrame, batch: Column) -> DataFrame:
    """(doc_id, digest, batch, row) of every row; stored, so that ``row`` stays the row's own."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of().alias("digest"), batch.alias("batch"))
    return stored(narrow.withColumn("row", F.monotonically_increasing_id()), "heads")


class DigestIndex:
    """Digests of all texts seen, below ``path``: ``entries`` and, by batch, ``counts``."""

    ENTRIES = "digest BINARY, keep_id BIGINT, batch STRING"
    COUNTS = "digest BINARY, n BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._layout(buckets)
        # The catalog of a session may be new; the files are what persists.
        self.table = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()}"
        place = f"{self.path}/entries".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.ENTRIES}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _layout(self, buckets: int) -> int:
        """The number of buckets the index was made with, or that of a new one."""
        rows = self.spark.range(1).select(F.lit(buckets).cast("int").alias("buckets"))
        try:
            found = self.spark.read.schema(rows.schema).parquet(f"{self.path}/layout").first()
        except AnalysisException:
            found = None
        if found is None:
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout")
        return found.buckets if found else buckets

    def entries(self) -> DataFrame:
        """(digest, keep_id, batch) of all texts; a scan is in buckets."""
        return self.spark.table(self.table)

    def counts(self) -> DataFrame:
        """(digest, n, batch): rows of each text by batch."""
        return self.spark.read.schema(self.COUNTS).parquet(f"{self.path}/counts")

    def _append(self, rows: DataFrame) -> None:
        rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").write.insertInto(self.table)

    def add(self, rows: DataFrame, batch: str) -> None:
        """Append what the index lacks of a batch's ``heads``."""
        own = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
        own = stored(own, "digests")
        new = own.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")
        self._append(stored(new, "new-digests").withColumn("batch", F.lit(batch)))
        place = f"{self.path}/counts/batch={batch}"
        own.select("digest", "n").write.mode("overwrite").parquet(place)

    def decisions(self, rows: DataFrame) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, text_sha256) of the ``heads`` of added batches.

        ``group_size`` counts the rows of all batches of the index.
        """
        sizes = self.counts().groupBy("digest").agg(F.sum("n").alias("group_size"))
        total = self.counts().agg(F.sum("n")).first()[0] or 0
        tops = rows.groupBy("digest", "batch").agg(F.max(F.struct("doc_id", "row")).alias("top"))
        tops = tops.select(F.col("digest").alias("top_digest"), F.col("batch").alias("top_batch"), F.col("top.row").alias("keep_row"))
        known = self.entries().join(sizes.filter("group_size > 1").hint("merge"), "digest")
        same = (F.col("digest") == F.col("top_digest")) & (F.col("batch") == F.col("top_batch"))
        facts = known.join(tops, same, "left").select(F.col("digest").alias("text"), "keep_id", "group_size", "keep_row")
        facts = stored(facts, "groups")
        # Fewer than HOT_GROUPS groups can hold more than that part of all rows each.
        hot = facts.filter(F.col("group_size") > total // HOT_GROUPS)
        cool = facts.filter(F.col("group_size") <= total // HOT_GROUPS)
        here = F.col("digest") == F.col("text")
        told = rows.join(F.broadcast(hot), here, "left")
        rest = told.filter("text IS NULL").select(*rows.columns).join(cool, here, "left")
        alone = F.col("text").isNull()
        return told.filter("text IS NOT NULL").unionByName(rest).select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (alone | F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def compacted(self, path: str) -> DigestIndex:
        """The same index below another path, with a sorted file per bucket."""
        out = DigestIndex(self.spark, path, self.buckets)
        out._append(self.entries())
        self.counts().write.partitionBy("batch").mode("overwrite").parquet(f"{out.path}/counts")
        return out


def decided(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Add a batch of ``docs`` (doc_id, text) to the index; what it says of every row."""
    rows = heads(docs, F.lit(batch))
    index.add(rows, batch)
    return index.decisions(rows)


def deduplicated(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The rows of a new batch that stay, whole.

    Of rows that repeat doc_id and text and differ elsewhere, the one of the largest hash stays.
    """
    kept = decided(docs, index, batch).filter("kept").select(F.col("doc_id").alias("kept_doc"), F.unhex("text_sha256").alias("kept_text"))
    digest, one = fresh(docs, "digest"), fresh(docs, "one")
    named = docs.withColumn(digest, digest_of())
    key = F.col("doc_id").cast("long")
    repeated = named.groupBy(key.alias("kept_doc"), F.col(digest).alias("kept_text")).count().filter("count > 1").drop("count")

    def same(other: DataFrame) -> Column:
        return key.eqNullSafe(other["kept_doc"]) & (F.col(digest) == other["kept_text"])

    staying = named.join(kept, same(kept), "left_semi")
    single = staying.join(repeated, same(repeated), "left_anti").drop(digest)
    # Combined before the shuffle: a row per task and text.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = staying.join(repeated, same(repeated), "left_semi").groupBy("doc_id", digest).agg(F.max_by(whole, F.xxhash64(F.to_json(whole))).alias(one))
    return single.unionByName(several.select(f"{one}.*"))


def newest_first(docs: DataFrame, path: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Decisions on all ``docs``, added to an index in two batches, the larger ids first.

    So the largest doc_id of equal texts stays, whichever batches they fall into.
    """
    spark = docs.sparkSession
    middle = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), 0.5, 100)).first()[0]
    late = F.coalesce(F.col("doc_id").cast("long") >= F.lit(middle).cast("long"), F.lit(False))
    rows = heads(docs, F.when(late, F.lit("newer")).otherwise(F.lit("older")))
    index = DigestIndex(spark, path or shared_path(spark, "digest-index"), buckets)
    for batch in ("newer", "older"):
        index.add(rows.filter(F.col("batch") == batch), batch)
    return index.decisions(rows)


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
