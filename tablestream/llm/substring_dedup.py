"""Substring dedup by fixed-block anchors.

A window of 50 words that occurs in two documents holds, in either of them, a whole block of 25 words that starts at a
multiple of 25. So the index takes the non-overlapping 25-word blocks of every document, every rolling 25-word window of every
document probes it, and a hit is extended to the 50-word windows around it, which are compared by their own hash. What
remains after the union of equal windows are the maximal exact repeats.

Anchors and probes meet in parts of the hash space. A part gets from each batch of documents one row with packed arrays
(about six bytes a window), in which a hash stands once however often the batch holds it; so a passage that a third of all
documents share costs one entry for each batch, and no pairs are made.

Every batch sends a row to every part, so the number of rows is the product of the two. Batches and parts grow with the square
root of the input (from ``BATCH_BYTES`` on), so that a row keeps ``ROW_BYTES`` of text and rows grow in proportion to the
input. They end at ``largest``, since a task takes about 23 times that in memory (64 MB: 1.5 GB): reached near 9 TB, and from
there on rows become shorter; with 100 TB a row has about 45 bytes of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import maybe_among, text_rows, written

WINDOW, BLOCK = 50, 25
BATCH_BYTES, LARGEST_BYTES, ROW_BYTES = 8 << 20, 64 << 20, 512
DIRECTORY, LOCAL, PROBE, HIT = 0, 1, 2, 3
PARCEL = "part int, batch long, kind int, a binary, b binary, c binary"
PARCEL_ARROW = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


class Parcels:
    """Rows that wait to be sent as one Arrow batch."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, part, batch, kind, a=b"", b=b"", c=b""):
        self.rows.append((int(part), int(batch), kind, a, b, c))

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 6
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, PARCEL_ARROW)], schema=PARCEL_ARROW)


def exchange_bytes(total: int, largest: int = LARGEST_BYTES) -> int:
    """Bytes of text of one batch and of one part, for an input of ``total`` bytes."""
    return int(min(max(BATCH_BYTES, (total * ROW_BYTES) ** 0.5), largest))


def _batch_number() -> Iterator[int]:
    n = TaskContext.get().partitionId() << 32
    while True:
        yield n
        n += 1


def pack_positions(at: np.ndarray) -> bytes:
    """Rising positions as 16-bit remainders after the counts of each stretch of 65,536."""
    high = np.bincount(at >> 16) if len(at) else np.zeros(0, int)
    return W.pack([len(high)], "<u4") + W.pack(high, "<u4") + W.pack(at & 0xFFFF, "<u2")


def unpack_positions(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    high = np.frombuffer(data, "<u4", n, 4)
    return (np.repeat(np.arange(n, dtype=np.int64) << 16, high) + np.frombuffer(data, "<u2", -1, 4 + 4 * n)).astype(np.int64)


def _split(order_by: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Indices by part, in rising order within a part."""
    order = np.argsort(order_by, kind="stable")
    cut = np.searchsorted(order_by[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cut)):
        yield int(p), order[cut[p]:cut[p + 1]]


def _directory(rows: list[tuple], counts: np.ndarray) -> bytes:
    return W.pack([r[0] for r in rows], "<i8") + W.pack([r[1] for r in rows], "<i8") + W.pack(counts, "<i8")


def _read_directory(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(3, -1)


def _sign(parts: int, size: int):
    """Every rolling block hash of a batch, sent to its part once; hashes that the batch repeats are hits at once."""
    def run(batches):
        number, out = _batch_number(), Parcels()
        for rows in W.gather(batches, size):
            hashed, counts = W.hash_words([r[2] for r in rows])
            at = W.inside(counts, BLOCK)
            at = at[np.repeat(counts, counts)[at] >= WINDOW] if len(at) else at      # shorter texts hold no window
            if not len(at):
                continue
            batch = next(number)
            h = W.window_hashes(hashed, BLOCK)[at]
            first = np.repeat(np.cumsum(counts) - counts, counts)
            aligned = (at - first[at]) % BLOCK == 0
            value, where, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            anchor = np.bincount(inverse, weights=aligned, minlength=len(value)) > 0
            out.add(batch % parts, batch, DIRECTORY, _directory(rows, counts))
            again = (n > 1)[inverse]
            if again.any():
                out.add(batch % parts, batch, LOCAL, pack_positions(at[again]))
            key = (value % np.uint64(parts)).astype(np.int64)
            place = at[where]
            rank = np.argsort(place)                                 # by position, so that positions pack well
            for p, mine in _split(key[rank], parts):
                mine = rank[mine]
                out.add(p, batch, PROBE, W.pack(value[mine] >> np.uint64(32), "<u4"), pack_positions(place[mine]),
                        np.packbits(np.stack([anchor[mine], n[mine] > 1])).tobytes())
            yield out.flush()
    return run


def _pass_on(table: pa.Table, out: Parcels) -> list[tuple]:
    """Rows that only travel with their part go on; the probes come back."""
    probes = []
    for row in zip(*(c.to_pylist() for c in table.columns)):
        (probes.append if row[2] == PROBE else lambda r: out.add(*r))(row)
    return probes


def _probe(table: pa.Table) -> pa.Table:
    """Within a part of the hash space: probes that meet an anchor and are not alone."""
    out = Parcels()
    probes = _pass_on(table, out)
    if probes:
        size = [len(r[3]) // 4 for r in probes]
        value = np.frombuffer(b"".join(r[3] for r in probes), "<u4")
        flags = [np.unpackbits(np.frombuffer(r[5], np.uint8))[: 2 * n].reshape(2, n).astype(bool) for r, n in zip(probes, size)]
        anchor, many = np.concatenate(flags, axis=1)
        index = np.unique(value[anchor])
        if len(index):
            slot = np.minimum(np.searchsorted(index, value), len(index) - 1)
            met = index[slot] == value
            n = np.bincount(slot[met], weights=1 + many[met], minlength=len(index))
            hit = met & (n[slot] > 1) & ~many
            end = np.cumsum(size)
            for r, a, b in zip(probes, end - size, end):
                if hit[a:b].any():
                    out.add(r[0], r[1], HIT, pack_positions(unpack_positions(r[4])[hit[a:b]]))
    return pa.Table.from_batches([out.flush()])


def _by_document(table: pa.Table) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Of one batch: doc_id, tid, number of words and the positions found, for each document that has any."""
    rows = list(zip(*(c.to_pylist() for c in table.columns)))
    found = [unpack_positions(r[3]) for r in rows if r[2] in (LOCAL, HIT)]
    listed = [r[3] for r in rows if r[2] == DIRECTORY]
    if not found or not listed:
        return
    doc, tid, count = _read_directory(listed[0])
    at = np.unique(np.concatenate(found))
    end = np.cumsum(count)
    cut = np.searchsorted(at, np.append(0, end))
    for i in np.flatnonzero(np.diff(cut)):
        yield int(doc[i]), int(tid[i]), int(count[i]), at[cut[i]:cut[i + 1]] - (end[i] - count[i])


SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("spans", pa.binary())])
SPANS = "doc_id long, tid long, spans binary"


def _candidates(table: pa.Table) -> pa.Table:
    """Ranges of 50-word windows around the hits of each document, as pairs of first and last start."""
    out = []
    for doc, tid, n, at in _by_document(table):
        wide = W.runs(np.maximum(at - (WINDOW - BLOCK), 0), WINDOW - BLOCK + 1, n - WINDOW + 1)
        out.append((doc, tid, W.pack(wide[wide[:, 0] < wide[:, 1]], "<i8")))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SPANS_ARROW)] if out else [[], [], []], schema=SPANS_ARROW)


def _spread(spans: bytes) -> np.ndarray:
    """All positions of packed half-open ranges."""
    pairs = np.frombuffer(spans, "<i8").reshape(-1, 2)
    return np.unique(np.concatenate([np.arange(a, b) for a, b in pairs])) if len(pairs) else np.zeros(0, np.int64)


def _sign_windows(parts: int, size: int):
    """The 50-word windows that hits point to: within a batch the smallest document of each goes to the window's part."""
    def run(batches):
        number, out = _batch_number(), Parcels()
        for rows in W.gather(batches, size):
            hashed, counts = W.hash_words([r[2] for r in rows])
            batch = next(number)
            first = np.cumsum(counts) - counts
            at = np.concatenate([_spread(r[3]) + f for r, f in zip(rows, first)]).astype(np.int64)
            if not len(at):
                continue
            h = W.window_hashes(hashed, WINDOW)[at]
            doc = np.array([r[0] for r in rows], np.int64)[np.searchsorted(first + counts, at, side="right")]
            value, inverse = np.unique(h, return_inverse=True)
            least = np.full(len(value), np.iinfo(np.int64).max)
            np.minimum.at(least, inverse, doc)
            later = doc > least[inverse]
            out.add(batch % parts, batch, DIRECTORY, _directory(rows, counts))
            if later.any():
                out.add(batch % parts, batch, LOCAL, pack_positions(np.sort(at[later])))
            keep = ~later
            h, doc, at = h[keep], doc[keep], at[keep]
            key = (W.mix(h + np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)
            for p, mine in _split(key, parts):
                mine = mine[np.argsort(at[mine], kind="stable")]
                out.add(p, batch, PROBE, W.pack(h[mine], "<u8"), pack_positions(at[mine]), W.pack(doc[mine], "<i8"))
            yield out.flush()
    return run


def _first_document(table: pa.Table) -> pa.Table:
    """Within a part: windows that also start in a document with a smaller id."""
    out = Parcels()
    probes = _pass_on(table, out)
    if probes:
        size = [len(r[3]) // 8 for r in probes]
        value = np.frombuffer(b"".join(r[3] for r in probes), "<u8")
        doc = np.frombuffer(b"".join(r[5] for r in probes), "<i8")
        order = np.argsort(value, kind="stable")
        new = np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1]))
        least = np.repeat(np.minimum.reduceat(doc[order], new), np.diff(np.append(new, len(value))))
        hit = np.empty(len(value), bool)
        hit[order] = doc[order] > least
        end = np.cumsum(size)
        for r, a, b in zip(probes, end - size, end):
            if hit[a:b].any():
                out.add(r[0], r[1], HIT, pack_positions(unpack_positions(r[4])[hit[a:b]]))
    return pa.Table.from_batches([out.flush()])


def _repeats(table: pa.Table) -> pa.Table:
    out = [(doc, tid, W.pack(W.runs(at, WINDOW, n), "<i8")) for doc, tid, n, at in _by_document(table)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SPANS_ARROW)] if out else [[], [], []], schema=SPANS_ARROW)


def repeat_spans(docs: DataFrame, largest: int = LARGEST_BYTES) -> DataFrame:
    """Maximal exact repeats: ``doc_id``, ``tid`` and ``spans`` (packed pairs of first word and end) of documents that have any.

    A span is a union of 50-word windows that each also start in a document with a smaller doc_id. Rows without doc_id take no
    part. Rows that repeat a doc_id count as parts of one document. ``largest``: most bytes of text of a batch or part, whose size
    changes the memory of a task but not the result.
    """
    rows = text_rows(docs).where(F.col("doc_id").isNotNull())
    total = rows.select(F.sum(F.octet_length("body"))).first()[0] or 0
    size = exchange_bytes(total, largest)
    parts = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))
    met = rows.mapInArrow(_sign(parts, size), PARCEL).groupBy("part").applyInArrow(_probe, PARCEL)
    ranges = met.groupBy("batch").applyInArrow(_candidates, SPANS)
    # a long text or a repeated row has several rows of ranges: joined into one
    ranges = ranges.groupBy("doc_id", "tid").agg(F.array_join(F.collect_list(F.hex("spans")), "").alias("spans")).withColumn("spans", F.unhex("spans"))
    ranges = written(ranges, "ranges", free=True)
    near = maybe_among(rows, ranges).join(ranges, ["doc_id", "tid"]).select("doc_id", "tid", "body", "spans")
    same = near.mapInArrow(_sign_windows(parts, size), PARCEL).groupBy("part").applyInArrow(_first_document, PARCEL)
    spans = same.groupBy("batch").applyInArrow(_repeats, SPANS)
    return written(spans.groupBy("doc_id", "tid").agg(F.max("spans").alias("spans")), "repeats", free=True)


KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])


def _keep(batches):
    for rows in W.gather(batches, 1 << 20):
        out = []
        for doc, text, spans in rows:
            found = text.split()
            pairs = np.frombuffer(spans or b"", "<i8").reshape(-1, 2).tolist()
            kept, at = [], 0
            for a, b in pairs:
                kept += found[at:a]
                at = b
            kept += found[at:]
            out.append((doc, len(found), len(found) - len(kept), [{"first": a, "end": b} for a, b in pairs], b" ".join(kept).decode()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), KEPT_ARROW)], schema=KEPT_ARROW)


def remove_repeats(docs: DataFrame, largest: int = LARGEST_BYTES) -> DataFrame:
    """Every document without the words of its repeats: ``doc_id, n_words, n_removed, spans, kept_text``.

    ``spans`` are positions of words, end exclusive; ``kept_text`` has the kept words joined by one space. Null and empty texts
    have no words. Only ``doc_id`` and ``text`` are read, so other columns may have any names. A document without
    doc_id is returned whole; rows that repeat a doc_id are returned each, and are never repeats of one another.
    """
    spans = repeat_spans(docs, largest)
    rows = text_rows(docs)
    # texts that can have spans meet them in a join; the others pass without a shuffle
    hit = maybe_among(rows.where("doc_id is not null"), spans)
    clear = maybe_among(rows, spans, outside=True)
    joined = hit.join(spans, ["doc_id", "tid"], "left").select("doc_id", "body", "spans").unionByName(clear.select("doc_id", "body", F.lit(None).cast("binary").alias("spans")))
    return joined.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept_text string")
