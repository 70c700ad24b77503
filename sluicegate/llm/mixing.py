"""Mixing sources to target weights by Efraimidis-Spirakis sampling; DataFrame functions only.

Every document gets the key ``-ln(u) / quality`` with u drawn from a hash of its id, and a
source takes its documents in the order of their keys.  Its budget of words is spent on
complete epochs first; what is left goes to the documents whose running total of words,
taken at their middle, stays within it.

No source is sorted as a whole: keys fall into buckets, totals per bucket are summed up,
and only the bucket in which a budget ends is sorted.  What comes out is one cut per
source, which a second scan of the documents compares their keys with; texts never move.

Null and empty texts have no words.  A null source is a source, the last one.  Rows with the
same id and size are ties and are taken together; a null id has a key like any other.  Empty
tables give no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluicegate.llm.common import fresh, stored

# Weights by rank of the source, epochs in all and per source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"
# Marks that prose has few of; a text of nothing else keeps a tenth of its weight.
MARKS = r"[^#$%&*|<>{}=^~@_\[\]\\]+"
LEAST_QUALITY = 0.1
# Documents per bucket of keys, and the least number of buckets.
BUCKET_ROWS = 2048
BUCKETS = 256


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: str = "text") -> Column:
    """Share of characters that are not marks, LEAST_QUALITY at least; 1 for empty texts."""
    marks = F.length(F.regexp_replace(F.col(text), MARKS, ""))
    share = F.lit(1.0) - F.coalesce(marks / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))
    return F.greatest(F.lit(LEAST_QUALITY), share)


def uniform(doc_id: str = "doc_id") -> Column:
    """A number between 0 and 1 from a hash of the id."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Where the cap binds, the excess is shared anew by weight.  In the order of size per
    weight, capped sources come first, and the level of the others is the largest of what
    would be left per weight after each of them.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank - 1) % len(WEIGHTS) + 1)
    ranked = sources.select("source", "source_size", weight.alias("weight"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(SHARE)
    left = ranked.withColumn("left", (total - before * float(MOST_EPOCHS)) / rest)
    level = F.max("left").over(everything)
    target = F.least(F.col("source_size") * float(MOST_EPOCHS), level * F.col("weight"))
    return left.select("source", "source_size", target.cast("double").alias("target"))


def keyed(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """(doc_id, source, size, key) of every document."""
    key = -F.log(uniform()) / (quality() if weight is None else weight)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.col("source").cast("string"), text.alias("text"))
    return rows.select("doc_id", "source", n_words().alias("size"), key.alias("key"))


def _bucket(key: Column, buckets: int) -> Column:
    return F.least(F.lit(buckets - 1), F.floor((F.lit(1.0) - F.exp(-key)) * buckets)).cast("int")


def cuts(keys: DataFrame) -> DataFrame:
    """Per source: source_size, target, complete epochs, and the last row of the part epoch.

    ``keys`` (doc_id, source, size, key) should be stored: it is read three times.
    """
    buckets = max(BUCKETS, keys.count() // BUCKET_ROWS)
    placed = keys.withColumn("bucket", _bucket(F.col("key"), buckets))
    totals = stored(placed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "totals")
    aims = targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")))
    full = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    aims = aims.withColumn("epochs", full)
    aims = stored(aims.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "aims")
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    running = totals.withColumn("upto", running).withColumnRenamed("source", "s")
    ends = running.join(aims, F.col("s").eqNullSafe(F.col("source")))
    ends = ends.filter("upto > budget AND upto - words <= budget")
    ends = ends.select("s", F.col("bucket").alias("b"), (F.col("budget") - (F.col("upto") - F.col("words"))).alias("rest"))
    last = placed.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    # Ties share a running total, so that they are taken together.
    order = Window.partitionBy("s").orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    tied = F.sum("size").over(Window.partitionBy("s", "key", "doc_id", "size"))
    last = last.withColumn("middle", upto - tied / 2)
    place = F.struct("key", "doc_id", "size")
    found = last.groupBy("s").agg(
        F.first("b").alias("cut_bucket"), F.max(F.when(F.col("middle") <= F.col("rest"), place)).alias("cut")
    )
    out = aims.join(found, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("buckets", F.lit(buckets))
    return out.select("source", "source_size", "target", "epochs", "cut_bucket", "cut", "buckets")


def _copies(rows: DataFrame) -> Column:
    """How often the mix takes a document: complete epochs, and the part one."""
    bucket = F.least(F.col("buckets") - 1, F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("buckets")))
    early = bucket < F.col("cut_bucket")
    within = (bucket == F.col("cut_bucket")) & (F.struct("key", "doc_id", "size") <= F.col("cut"))
    return F.col("epochs") + F.coalesce(early | within, F.lit(False)).cast("long")


def mix(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies) of every document."""
    keys = stored(keyed(docs, weight), "keys")
    rule = stored(cuts(keys), "cuts").withColumnRenamed("source", "s")
    rows = keys.join(rule, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies(keys))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def mixed_documents(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """The rows that the mix takes, as often as it takes them, with their own columns.

    Keys are computed again from the texts instead of moving the texts to their keys.
    """
    rule = stored(cuts(stored(keyed(docs, weight), "keys")), "cuts")
    own, rule_column = fresh(docs, "own"), fresh(docs, "rule")
    rule = rule.select(F.col("source").alias(fresh(docs, "s")), F.struct(*rule.columns).alias(rule_column))
    key = -F.log(uniform()) / (quality() if weight is None else weight)
    whole = docs.withColumn(own, F.struct(key.alias("key"), F.col("doc_id"), n_words().alias("size")))
    rows = whole.join(rule, F.col("source").cast("string").eqNullSafe(F.col(rule.columns[0])))
    part, at = F.col(rule_column), F.col(own)
    bucket = F.least(part["buckets"] - 1, F.floor((F.lit(1.0) - F.exp(-at["key"])) * part["buckets"]))
    within = (bucket < part["cut_bucket"]) | ((bucket == part["cut_bucket"]) & (at <= part["cut"]))
    copies = (part["epochs"] + F.coalesce(within, F.lit(False)).cast("long")).cast("int")
    times = F.explode(F.array_repeat(F.lit(1), copies))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], times.alias(fresh(docs, "time"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS UBIGINT) + 0.5)
        / 281474976710656.0::DOUBLE)
      / greatest(0.1::DOUBLE, 1.0::DOUBLE - coalesce(CAST(length(regexp_replace(text,
          '[^#$%&*|<>{}=^~@_\[\]\\]+', '', 'g')) AS DOUBLE) / nullif(length(text), 0), 0.0::DOUBLE)) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0::DOUBLE)
        / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
t AS (SELECT source, source_size,
        least(source_size * 2.0::DOUBLE, (max(rest) OVER ()) * weight) AS target FROM l),
e AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, d.source,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size RANGE UNBOUNDED PRECEDING))::DOUBLE
          - (sum(d.size) OVER (PARTITION BY d.source, d.key, d.doc_id, d.size))::DOUBLE / 2 AS middle
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
c AS (SELECT *, epochs + CASE WHEN source_size > 0 AND middle <= target - epochs * source_size THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, source,
  copies::BIGINT AS copies FROM c
"""
