"""Exact duplicates: grouped by a 128-bit content hash, confirmed byte by byte.

Only ids and hashes are grouped. Texts meet only inside groups of several rows, each with the text
of the row that stays, so a group of any size is a join on its hash whose many-row side the
runtime can split. Rows whose bytes differ from that text (a collision) are told apart by their
SHA-256 and form groups of their own, in which the same rule picks the row that stays.

A null text counts as empty. A row without an id stays only where no row of its group has one.
Repeated ids: the rows are members of their group like any others, and
all rows of the id that stays with the equal text are marked kept; pick one by any further key.
Columns other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage


#: How the row that stays is picked, and what stands for a missing id so that it comes last.
_RULES = {"smallest": (F.min, (1 << 63) - 1), "largest": (F.max, -(1 << 63))}


def _id(last: int) -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(last))


def exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Per row ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep``: whether the ``smallest`` or the ``largest`` id of a group stays."""
    pick, last = _RULES[keep]
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select(_id(last).alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("hash"))
    marks = cut_lineage(
        hashed.select("doc_id", "hash", F.unhex(F.sha2("text", 256)).alias("sha"))
    )
    groups = cut_lineage(
        marks.groupBy("hash").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    # The texts of groups with several rows, each compared with the one that stays. The plan is the
    # same at every size: the list of groups grows with the data and is never broadcast.
    members = cut_lineage(hashed.join(groups.select("hash", "keep_id").hint("merge"), "hash"))
    # Stored, so that both sides of the next join are plain shuffles, which the runtime can split.
    stays = cut_lineage(members.where("doc_id = keep_id").groupBy("hash").agg(F.min("text").alias("kept_text")))
    differs = cut_lineage(
        members.join(stays.hint("merge"), "hash").where(F.col("text") != F.col("kept_text")).select("hash")
    )
    plain = marks.join(groups.hint("merge"), "hash", "left").join(differs, "hash", "left_anti")
    whole = plain.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "sha",
    )
    collided = marks.join(differs, "hash", "left_semi")
    parts = collided.groupBy("hash", "sha").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    apart = collided.join(parts, ["hash", "sha"]).select("doc_id", "keep_id", "group_size", "sha")
    real = lambda c: F.nullif(F.col(c), F.lit(last)).alias(c)
    return whole.unionByName(apart).select(
        real("doc_id"),
        real("keep_id"),
        "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, with all its columns."""
    _, last = _RULES[keep]
    key = "_"
    while any(c.lower().startswith(key) for c in docs.columns):
        key += "_"
    names = [f"{key}id", f"{key}sha"]
    stays = (
        exact_duplicates(docs, keep).where("kept")
        .select(_id(last).alias(names[0]), F.col("text_sha256").alias(names[1]))
        .distinct()
    )
    own = docs.withColumns({names[0]: _id(last), names[1]: F.sha2(F.coalesce("text", F.lit("")), 256)})
    return own.join(stays, names, "left_semi").dropDuplicates(names).select(*docs.columns)
