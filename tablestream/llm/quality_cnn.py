"""Quality classifier: a byte-level convolutional network in numpy.

Bytes become vectors of ``EMBED`` numbers; ``FILTERS`` filters of eight bytes slide over the whole document four bytes at a time. Their
positive parts are max-pooled over overlapping chunks of 512 bytes (64 bytes shared), and the chunks' values are combined by their mean and
their maximum into one logistic output. The network is fitted with Adam on a bounded sample of labelled documents (``SAMPLE`` of each class,
of at most ``SAMPLE_BYTES`` each); it has a fixed size and travels with the tasks. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import body, session, text_rows

EMBED, FILTERS, STRIDE = 8, 24, 4
CHUNK, STEP = 128, 112                  # in strides: 512 bytes, 64 of them shared with the next chunk
SAMPLE, SAMPLE_BYTES = 900, 32 << 10    # labelled documents of each class that are fitted, and their longest text
LONG, BLOCK = 256 << 10, 512            # bytes from which a text is scored in blocks, and chunks of a block
EPOCHS, BATCH, RATE = 6, 32, 0.01
LIMIT = 0.3


def _frame(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes padded to whole strides; first and end stride of every chunk, and the document of each chunk."""
    strides = np.array([len(t) // STRIDE + 1 for t in texts])
    data = np.frombuffer(b"".join(t + bytes(STRIDE * (s + 1) - len(t)) for t, s in zip(texts, strides.tolist())), np.uint8)
    first = np.cumsum(strides + 1) - (strides + 1)
    chunks = np.maximum(1, -(-(strides - CHUNK) // STEP) + 1)
    doc = np.repeat(np.arange(len(texts)), chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = first[doc] + nth * STEP
    return data, start, np.minimum(start + CHUNK, first[doc] + strides[doc]), doc


class Network:
    """Weights by name, all float32."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {"embed": r.normal(0, 0.5, (256, EMBED)), "now": r.normal(0, 0.15, (EMBED * STRIDE, FILTERS)), "next": r.normal(0, 0.15, (EMBED * STRIDE, FILTERS)),
                  "bias": np.zeros(FILTERS), "out": r.normal(0, 0.1, 2 * FILTERS), "base": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pooled(self, data, start, end):
        x = self.p["embed"][data].reshape(-1, EMBED * STRIDE)
        z = x[:-1] @ self.p["now"] + x[1:] @ self.p["next"] + self.p["bias"]
        z = np.maximum(z, 0)
        pooled = np.maximum.reduceat(z, np.stack([start, end - (end == len(z))], axis=1).ravel(), axis=0)[::2]
        last = end == len(z)                     # reduceat cannot name the end of the array
        pooled[last] = np.maximum(pooled[last], z[-1])
        return x, z, pooled

    def _features(self, pooled, doc):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        n = np.diff(np.append(first, len(doc)))
        return np.hstack([np.add.reduceat(pooled, first, axis=0) / n[:, None], np.maximum.reduceat(pooled, first, axis=0)]), n

    def _long(self, text: bytes) -> np.ndarray:
        """Features of one text, read in blocks of whole chunks: sum and maximum of the pooled values go on from block to block."""
        strides = len(text) // STRIDE + 1
        chunks = max(1, -(-(strides - CHUNK) // STEP) + 1)
        total, largest = np.zeros(FILTERS), np.zeros(FILTERS, np.float32)
        for c in range(0, chunks, BLOCK):
            start = np.arange(min(BLOCK, chunks - c)) * STEP
            end = np.minimum(start + CHUNK, strides - c * STEP)
            first, size = c * STEP * STRIDE, (int(end[-1]) + 1) * STRIDE        # the last stride's filters read one stride on
            piece = text[first:first + size]
            pooled = self._pooled(np.frombuffer(piece + bytes(size - len(piece)), np.uint8), start, end)[2]
            total += pooled.sum(axis=0, dtype=float)
            largest = np.maximum(largest, pooled.max(axis=0))
        return np.concatenate([total / chunks, largest])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        f = np.zeros((len(texts), 2 * FILTERS), np.float32)
        short = [i for i, t in enumerate(texts) if len(t) <= LONG]
        if short:
            data, start, end, doc = _frame([texts[i] for i in short])
            f[short] = self._features(self._pooled(data, start, end)[2], doc)[0]
        for i in set(range(len(texts))).difference(short):
            f[i] = self._long(texts[i])
        return 1 / (1 + np.exp(-np.clip((f @ self.p["out"] + self.p["base"]).astype(float), -40, 40)))

    def gradients(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        data, start, end, doc = _frame(texts)
        x, z, pooled = self._pooled(data, start, end)
        f, n = self._features(pooled, doc)
        p = 1 / (1 + np.exp(-np.clip(f @ self.p["out"] + self.p["base"], -40, 40)))
        slip = ((p - y) / len(y)).astype(np.float32)
        back = slip[:, None] * self.p["out"][None, :]
        largest = (pooled == f[doc, FILTERS:]).astype(np.float32)            # chunks that share a maximum share its gradient
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        to_pooled = back[doc, :FILTERS] / n[doc, None] + back[doc, FILTERS:] * largest / np.add.reduceat(largest, first, axis=0)[doc]
        # the stride that holds each chunk's maximum gets its gradient
        g = np.zeros_like(z)
        for c, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            top = z[a:b].argmax(axis=0)
            g[a + top, np.arange(FILTERS)] += to_pooled[c] * (pooled[c] > 0)
        hit = np.flatnonzero(g.any(axis=1))
        gh = g[hit]
        gx = np.zeros_like(x)
        np.add.at(gx, hit, gh @ self.p["now"].T)
        np.add.at(gx, hit + 1, gh @ self.p["next"].T)
        touched = np.flatnonzero(gx.any(axis=1))
        embed = np.zeros_like(self.p["embed"])
        np.add.at(embed, data.reshape(-1, STRIDE)[touched].ravel(), gx[touched].reshape(-1, EMBED))
        return {"embed": embed, "now": x[hit].T @ gh, "next": x[hit + 1].T @ gh, "bias": gh.sum(axis=0), "out": f.T @ slip, "base": np.array([slip.sum()], np.float32)}

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Network:
        r, t = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for e in range(epochs):
            order = r.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                part = order[i:i + BATCH]
                t += 1
                rate = RATE * (1 - e / epochs)
                for k, g in self.gradients([texts[j] for j in part], y[part].astype(np.float32)).items():
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
        return self


def held_out(doc_id) -> Column:
    """Rows whose labels are never learned."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Fit on ``sample`` labelled documents of each class that are not held out, chosen by a hash of doc_id. Without both classes the network stays neutral."""
    session(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    order = [F.xxhash64("doc_id", F.lit(9)), "doc_id"]
    ids = known.where("y = 0").orderBy(*order).limit(sample).unionByName(known.where("y = 1").orderBy(*order).limit(sample)).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("body")).where(F.octet_length("body") <= sample_bytes)
    rows = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "y", "body")                                 # ids: 2 * sample rows
    rows = rows.orderBy(*order, "y", F.xxhash64("body")).limit(4 * sample).collect()        # more only where ids repeat
    rows = sorted(rows, key=lambda r: (r.doc_id, r.y, bytes(r.body)))
    net, y = Network(), np.array([r.y for r in rows])
    if len(set(y.tolist())) < 2:
        net.p["out"][:] = 0
        return net
    return net.fit([bytes(r.body) for r in rows], y)


def _score(net: Network):
    def run(batches):
        for rows in W.gather(batches, 256 << 10, 2000):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(net.scores([r[2] for r in rows]))],
                                             names=["doc_id", "tid", "score"])
    return run


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; only ``doc_id`` and ``text`` are read.

    Null and empty texts are scored as a text without bytes. Repeated rows and null ids are scored each by itself.
    """
    scored = text_rows(docs).mapInArrow(_score(net), "doc_id long, tid long, score double")
    return scored.select("doc_id", "tid", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def _accepted(net: Network):
    def run(batches):
        for b in batches:
            at = b.schema.names.index("_body")
            bodies, keep = b.column(at).to_pylist(), []
            size = 0
            while size < len(bodies):
                end, n = size, 0
                while end < len(bodies) and (end == size or n + len(bodies[end]) < 256 << 10):
                    n += len(bodies[end])
                    end += 1
                keep += (net.scores(bodies[size:end]) >= LIMIT).tolist()
                size = end
            yield b.drop_columns(["_body"]).filter(pa.array(keep, pa.bool_()))
    return run


def keep(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` whose text the network accepts, all columns as they are (none may be called ``_body``)."""
    session(docs.sparkSession)
    return docs.withColumn("_body", body()).mapInArrow(_accepted(net), docs.schema)
