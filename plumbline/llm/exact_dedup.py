"""Exact dedup: 128-bit content hash, smallest or largest stable id, bytes compared inside groups.

A group's texts are compared by the smallest and the largest of them, which partial
aggregation reduces to two texts per task, so neither a hot text nor a collision brings a
group into one task.  A hash whose texts differ is grouped again by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, fresh, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str | Column) -> Column:
    """Lower-case A to Z only; null counts as empty."""
    return F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), UPPER, LOWER)


def content_hash(normal: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(normal))


def exact_groups(docs: DataFrame, keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """Every row's id with its group: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A to Z; a null text is an empty one.
    ``keep`` names the row that stays: "smallest" or "largest" id.  Rows that repeat one id
    and text share their decision.  A missing id never stays while another row of the group
    has one; keep_id of a group without any id is null and its rows are kept, as nothing
    tells them apart.  An empty table gives no rows; other columns are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    normal = ascii_lower("text")
    rows = docs.select(F.col(ID), hash_of(normal).alias("h"), normal.alias("normal"))
    # the text rides along only here
    seen = rows.groupBy("h").agg(
        best(ID).alias("keep_id"), F.count("*").alias("group_size"), F.min("normal").alias("lo"), F.max("normal").alias("hi")
    )
    groups = settle(seen.select("h", "keep_id", "group_size", (F.col("lo") != F.col("hi")).alias("clash")))
    plain = docs.select(F.col(ID), hash_of(normal).alias("h"), F.unhex(F.sha2(normal, 256)).alias("sha"))
    found = plain.join(groups, "h").filter(~F.col("clash")).select(ID, "keep_id", "group_size", "sha")
    clashing = groups.filter("clash")
    if not clashing.isEmpty():
        apart = rows.join(clashing.select("h"), "h", "left_semi")
        by_text = apart.groupBy("normal").agg(best(ID).alias("keep_id"), F.count("*").alias("group_size"))
        split = apart.join(by_text, "normal").select(
            ID, "keep_id", "group_size", F.unhex(F.sha2(F.col("normal"), 256)).alias("sha")
        )
        found = found.unionByName(split)
    return found.select(
        ID,
        "keep_id",
        "group_size",
        F.col(ID).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, keep: str = "smallest", hash_of=content_hash) -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat id and text one stays.

    Only ids and hashes decide; texts move once, spread by id, so a hot group is no hot task.
    """
    key = fresh(docs, "key")
    named = lambda sha: F.concat_ws(":", F.coalesce(F.col(ID).cast("string"), F.lit("-")), sha)
    stay = exact_groups(docs, keep, hash_of).filter("kept").select(named(F.col("text_sha256")).alias(key)).distinct()
    keyed = docs.withColumn(key, named(F.sha2(ascii_lower("text"), 256)))
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).drop(key)
