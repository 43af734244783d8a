"""Exact dedup by distributed MSD radix partitioning.

Texts are split by successive runs of bytes, the most significant first: by length and the first 32 bytes, then by the next 512, 8,192,
131,072 ... bytes. After each split a document that is alone in its group is done; a group whose bytes are used up holds
equal texts. Every byte of a text takes part in the comparison, so equality rests on no digest. The runs grow sixteenfold, so the
number of rounds is the logarithm of the longest text that has a twin so far, and only bytes not yet used travel on.
Group sizes are summed before the shuffle, and the join that hands them out may be split by AQE where one group is very large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.core import hashable
from .shared import maybe_among, text_rows, written

FIRST, SECOND, GROWTH = 32, 512, 16
END = 2**31 - 1


def _split(rows: DataFrame, by: list[str], used: int) -> DataFrame:
    """Rows whose group under ``by`` has company: their group (largest doc_id and largest tid name it), its size, the bytes left."""
    groups = rows.groupBy(*by).agg(F.count("*").alias("n2"), F.max("doc_id").alias("top2"), F.max("tid").alias("tag2")).where("n2 > 1")
    met = rows
    on = None
    for c in by:
        groups = groups.withColumnRenamed(c, f"{c}_g")
        same = F.col(c).eqNullSafe(F.col(f"{c}_g"))
        on = same if on is None else on & same
    return met.join(groups, on).select("doc_id", "tid", F.col("top2").alias("top"), F.col("tag2").alias("tag"), F.col("n2").alias("n"),
                                       F.substring("body", used + 1, END).alias("body"))


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, tid, keep_id, group_size`` of every document that has a copy (one row for each doc_id and text)."""
    rows = text_rows(docs)
    start = rows.withColumns({"size": F.octet_length("body"), "head": F.substring("body", 1, FIRST)})
    met = written(_split(start, ["size", "head"], FIRST), "radix", free=True)
    ended, step = met.where("octet_length(body) = 0"), SECOND
    while True:
        left = met.where("octet_length(body) > 0")
        if left.isEmpty():
            break
        met = written(_split(left.withColumn("head", F.substring("body", 1, step)), ["top", "tag", "head"], step), "radix", free=True)
        ended = ended.unionByName(met.where("octet_length(body) = 0"))
        step *= GROWTH
    return ended.select("doc_id", "tid", F.col("top").alias("keep_id"), F.col("n").alias("group_size")).dropDuplicates(["doc_id", "tid"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, tid, body_sha256, keep_id, group_size, kept`` for every row; only ``doc_id`` and ``text`` are read.

    Null counts as empty; empty texts are equal. Of equal texts the row with the largest doc_id stays. Rows without doc_id go when
    an equal text has one and stay otherwise (keep_id is then null). Rows that repeat doc_id and text share one verdict.
    """
    rows = text_rows(docs).select("doc_id", "tid", F.sha2("body", 256).alias("text_sha256"))
    found = copies(docs).withColumnsRenamed({"doc_id": "d", "tid": "t"})
    out = rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.tid == found.t), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", "tid", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each different text, with all its columns: of equal texts the row with the largest doc_id, of rows that repeat doc_id
    and text (or have no doc_id) the least by its columns. Columns that cannot be ordered (MAP) do not take part in that choice.

    Null counts as empty. Columns of any name stay as they are.
    """
    kept = written(exact_duplicates(docs).where("kept").select("doc_id", "tid"), "kept", few=True)
    again = kept.groupBy("doc_id", "tid").count().where("count > 1").select(F.xxhash64("doc_id", "tid").alias("_row"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_tid"), text.alias("_text"))
    rows = rows.withColumn("_row", F.xxhash64("_id", "_tid"))
    named = kept.distinct()
    here = lambda r: r.join(named, r["_id"].eqNullSafe(named["doc_id"]) & (r["_tid"] == named["tid"]), "left_semi")
    once = here(maybe_among(rows.drop("_text"), again, "_row", outside=True)).select("_doc")
    by = F.struct(*[F.col("_doc")[c] for c in hashable(docs)])
    more = here(maybe_among(rows, again, "_row")).groupBy("_id", "_text").agg(F.min_by("_doc", by).alias("_doc")).select("_doc")
    return once.unionByName(more).select("_doc.*")
