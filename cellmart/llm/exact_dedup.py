"""Exact duplicates by digest, with the frequent digests split off: DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.llm.common import SPACE, col, fresh, stored, without

# a digest that this share of all rows has is handled by broadcast; so at most 1 / SUPPORT digests are
SUPPORT = 1 / 256


def text_digest(text: Column) -> Column:
    """SHA-256, as bytes, of the text with each run of white space as one space; NULL counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256))


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``digest``, ``keep_id``, ``group_size`` and ``kept``.

    A scan with Misra-Gries counters finds every digest that may have ``support`` of the rows, at most
    ``1 / support`` of them; an exact count verifies them. The winners of the frequent ones are broadcast and
    their rows are decided where they are scanned. Only rows of other digests are shuffled, so no
    group in the shuffle holds more than that share of the rows.

    Of equal texts the row with the smallest id stays, NULL ids last. Rows that repeat both id and
    text form one group with the others: exactly one row of a group has ``kept``. NULL and empty texts are equal.
    An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    rows = stored(docs.select(col(doc_id).alias("doc_id"), text_digest(col(text)).alias("digest")), "digests")
    named = rows.select(F.hex("digest").alias("digest"))
    # at most 1 / support digests, whatever the number of rows
    found = named.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("name"))
    candidates = found.select(F.unhex("name").alias("digest"))
    counted = (
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    total = rows.count()
    winners = stored(counted.where(F.col("group_size") >= total * support), "winners")

    frequent = rows.join(F.broadcast(winners), "digest")
    winner = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # rows that repeat the winner's id: one of them stays
    order = Window.partitionBy("digest").orderBy("doc_id")
    first = frequent.where(winner).withColumn("kept", F.row_number().over(order) == 1)
    others = frequent.where(~winner).withColumn("kept", F.lit(False))

    order = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
    )
    return rest.unionByName(first).unionByName(others).select("doc_id", "digest", "keep_id", "group_size", "kept")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """``docs`` without the rows that :func:`decide` does not keep, all columns as they were.

    Only the keys of dropped rows travel: they are broadcast if measured small.
    """
    decisions = stored(decide(docs, doc_id, text, support).where(~F.col("kept")), "dropped")
    digest, key, value = (fresh(docs, n) for n in ("_digest", "_drop_id", "_drop_digest"))
    keyed = docs.withColumn(digest, text_digest(col(text)))
    twin = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    names = [F.col("doc_id").alias(key), F.col("digest").alias(value)]
    # twins: dropped rows that have the id and the text of the row that stays
    gone, twins = decisions.where(~twin).select(*names), decisions.where(twin).select(*names).distinct()
    return without(keyed, gone, twins, [(doc_id, key), (digest, value)]).drop(digest)
