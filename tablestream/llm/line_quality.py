"""Quality rules: base measures of each text, and lines that many documents of a host share.

Lines are normalised (A-Z lower-cased, digits as 0, white space as one space) and hashed. For each (host, line) the distinct documents are
counted, copies of one text as one; a line above both limits is boilerplate of its host. ``clean`` takes these lines out of the texts, and
``judge`` rejects a document that is left with too few words, or too small a part of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import body, maybe_among, session, written

MIN_DOCS, MIN_SHARE = 20, 0.02     # a line is boilerplate in more documents than this, and in more than this share of its host's
LEFT_WORDS, LEFT_SHARE = 20, 0.3   # what a document must keep
SYMBOLS = b"#*$%&|<>"
REPEAT = 8
_PLAIN = bytes(48 if 48 <= c <= 57 else W.LOWER[c] for c in range(256))

LINES = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("host", pa.string()), ("lines", pa.list_(pa.int64()))])
LINES_DDL = "doc_id long, tid long, host string, lines array<long>"
CLEANED = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("removed_lines", pa.list_(pa.int32())), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                     ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_line_words", pa.int64())])
CLEANED_DDL = ("doc_id long, kept_text string, removed_lines array<int>, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, n_line_words long")


def _repeated(h: np.ndarray) -> int:
    """Words inside windows whose hash occurs twice or more."""
    if len(h) < 2:
        return 0
    order = np.sort(h)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(h, again))
    return int(np.diff(W.runs(at, REPEAT, len(h) + REPEAT - 1), axis=1).sum())


def _hashed(line: bytes) -> tuple[int, int]:
    """Hash of a line as it is counted, and its words."""
    w = line.translate(_PLAIN).split()
    k = xxhash.xxh3_64_intdigest(b" ".join(w))
    return k - ((k >> 63) << 64), len(w)


def _lines(batches):
    """Distinct lines of each text."""
    for rows in W.gather(batches, 1 << 20):
        out = [(doc, tid, host, list({_hashed(x)[0] for x in text.split(b"\n") if x.strip()})) for doc, tid, host, text in rows]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), LINES)], schema=LINES)


def _cut(text: bytes, gone: set[int]) -> tuple[bytes, list[int], int]:
    """A text without its lines among ``gone``, and the numbers and words of those."""
    lines, removed, words = text.split(b"\n"), [], 0
    for i, x in enumerate(lines):
        if x.strip():
            k, n = _hashed(x)
            if k in gone:
                removed.append(i)
                words += n
    away = set(removed)
    return b"\n".join([x for i, x in enumerate(lines) if i not in away]), removed, words


def _clean(batches):
    for rows in W.gather(batches, 1 << 20):
        hashed, counts = W.hash_words([r[1] for r in rows])
        rolled = W.window_hashes(hashed, REPEAT)
        out, at = [], 0
        for (doc, text, gone), n in zip(rows, counts.tolist()):
            chars = len(text.decode()) - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
            full = [x for x in text.split(b"\n") if x.strip()]
            left, removed, words = _cut(text, set(gone)) if gone else (text, [], 0)
            out.append((doc, left.decode(), removed, n, chars, sum(map(text.count, SYMBOLS)), len(full) - len(set(full)),
                        _repeated(rolled[at:at + n - REPEAT + 1]) if n > REPEAT else 0, words))
            at += n
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), CLEANED)], schema=CLEANED)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def clean(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """``doc_id, kept_text, removed_lines``, the measures of the text as it was, ``n_line_words, base_failed, kept`` for every row.

    ``kept_text`` is the text without boilerplate lines, the others as they are; ``removed_lines`` are the numbers (from 0) of lines that
    are out, ``n_line_words`` their words. Reads ``doc_id``, ``text`` and the column ``host`` (null: ''). Null and empty texts have no words,
    stay empty and fail the base rules. Rows that repeat a text (with the same id or another) count as one document for
    the line counts; every row gets its own text and verdict, rejected ones too.
    """
    session(docs.sparkSession)
    text = body()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       text.alias("body"))
    lines = written(rows.mapInArrow(_lines, LINES_DDL), "lines")
    hosts = lines.groupBy("host").agg(F.countDistinct("tid").alias("docs"))
    each = lines.select("doc_id", "tid", "host", F.explode("lines").alias("line"))
    seen = each.groupBy("host", "line").agg(F.countDistinct("tid").alias("n")).where(F.col("n") > min_docs)
    common = written(seen.join(hosts, "host").where(F.col("n") > F.col("docs") * min_share).select("host", "line"), "common-lines")
    key = F.xxhash64("doc_id", "tid", "host").alias("key")
    gone = each.join(common, ["host", "line"]).groupBy(F.col("doc_id").alias("d"), F.col("tid").alias("t"), F.col("host").alias("h")).agg(F.collect_set("line").alias("gone"))
    gone = written(gone.withColumn("key", F.xxhash64("d", "t", "h")), "lines-out")
    # only texts that hold such a line go through the join
    rows = rows.select("*", key)
    some = maybe_among(rows, gone, "key").join(gone.drop("key"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")) & (F.col("host") == F.col("h")), "left")
    rest = maybe_among(rows, gone, "key", outside=True).withColumn("gone", F.lit(None).cast("array<long>"))
    columns = ["doc_id", "body", "gone"]
    out = some.select(*columns).unionByName(rest.select(*columns)).mapInArrow(_clean, CLEANED_DDL)
    left = F.col("n_words") - F.col("n_line_words")
    depleted = (F.col("n_line_words") > 0) & ((left < LEFT_WORDS) | (left < LEFT_SHARE * F.col("n_words")))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_line_words`` for every row: ``clean`` without the texts."""
    return clean(docs, host, min_docs, min_share).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_line_words")
