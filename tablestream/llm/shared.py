"""Helpers that the training-data operators share: intake of documents, written intermediate tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, tune

# Rows of one Arrow batch: texts can be long, so batches are kept small.
ARROW_ROWS = 1000


def session(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def body(column: str = "text") -> Column:
    """A text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def text_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``tid`` (hash of the text) and ``body``: with the two keys, rows that repeat a doc_id stay apart."""
    session(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid"),
                       body(text).alias("body"))


FEW = 8


def written(df: DataFrame, label: str, free: bool = False, few: bool = False) -> DataFrame:
    """Write to the shared folder and read again: later steps start from files, not from lost executors' shuffles.

    With ``free`` the shuffle files of the step are dropped at once (for steps that move texts). With ``few`` a narrow table (ids and
    counts) is written by one in ``FEW`` as many tasks as there are shuffle partitions: the fixed cost of a task is most of its work.
    """
    spark = df.sparkSession
    if few:
        df = df.coalesce(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // FEW))
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if free:
        release(spark)
    return back


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now instead of at some later collection of garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


FILTER_WORDS = 1 << 17


def maybe_among(rows: DataFrame, ids: DataFrame, column: str = "doc_id", outside: bool = False) -> DataFrame:
    """Rows whose ``column`` may be among ``ids`` (none that is gets lost), so that few texts enter the shuffle of the exact join;
    with ``outside`` exactly the other rows, those with a null ``column`` included.

    The ids set bits in a table of ``FILTER_WORDS`` words of 64 bits. Its size does not depend on the data, so it is broadcast; with more
    ids than bits it only filters less.
    """
    h = F.xxhash64(F.col(column), F.lit(21))
    word, bit = F.pmod(h, F.lit(FILTER_WORDS)).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 20), F.lit(64)).cast("int"))
    bits = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    among = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False)) & F.col(column).isNotNull()
    return met.where(~among if outside else among).select(*rows.columns)
