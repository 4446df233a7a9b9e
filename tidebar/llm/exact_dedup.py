"""Exact dedup: group by a 128-bit hash of the content, keep the smallest id, compare bytes within groups.

DataFrame functions only. The texts themselves are shuffled once, as a grouping key next to their
MD5: copies meet in the map-side aggregate first, so a group of copies of any size becomes one row
for each task, and texts that differ stay apart even if their hashes agree. Every row then finds its
group by hash alone; only hashes with more than one text (collisions) are joined by their bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, column, cut


def normalised(text: str = "text") -> F.Column:
    """The text with every run of white space as one space; null as an empty text."""
    return F.regexp_replace(F.coalesce(column(text), F.lit("")), SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=F.md5) -> DataFrame:
    """One row for each row of docs: its id, the id that stays, the group's size, whether it stays, the text's SHA-256.

    * Null texts count as empty; all empty texts are one group.
    * Of ids, null is never the smallest: a row without an id stays only if no row of its group has one.
    * Repeated rows (same id, same text) all count in group_size and share their verdict; they can't be told apart.
    * An empty table gives an empty result. Other columns are not read, so their names don't matter.

    hash_of: the content hash, a function of a binary column that gives a 128-bit hex string; tests pass a weak one.
    """
    rows = docs.select(column(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    rows = rows.withColumn("h", hash_of(F.col("norm").cast("binary")))
    groups = rows.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = cut(groups.select("h", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "keep_id", "group_size"), "groups")
    many = groups.groupBy("h").count().where("count > 1").select("h")
    rows = rows.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    if many.isEmpty():
        out = rows.drop("norm").join(groups.drop("sha"), "h")
    else:  # texts whose 128-bit hashes collide: their rows are matched by the bytes
        many = cut(many, "collisions")
        whole = rows.join(many, "h", "left_semi")
        by_bytes = whole.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        single = groups.join(many, "h", "left_anti").drop("sha")
        out = rows.drop("norm").join(single, "h").unionByName(whole.join(by_bytes, ["h", "norm"]).drop("norm"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts one row, that of the smallest id.

    Ids that are null come last, and rows that tie in id and text leave one. The text travels once, as the
    grouping key; a text that normalising changes goes along as it was.
    """
    text = column(text_col)
    rest = F.struct(*[column(c).alias(c) for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.lit(None)
    whole = F.struct(rest.alias("rest"), F.when(~text.eqNullSafe(normalised(text_col)), F.struct(text.alias("text"))).alias("was"))
    rows = docs.select(normalised(text_col).alias("norm"), whole.alias("row"), F.struct(column(id_col).isNull(), column(id_col), F.xxhash64(whole)).alias("order"))
    kept = rows.groupBy(F.md5(F.col("norm").cast("binary")).alias("h"), "norm").agg(F.min_by("row", "order").alias("row"))
    text = F.when(F.col("row.was").isNull(), F.col("norm")).otherwise(F.col("row.was.text"))
    return kept.select(*[text.alias(c) if c == text_col else F.col("row.rest").getField(c).alias(c) for c in docs.columns])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
