"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of KERNEL bytes slide over the whole document; their
rectified responses are max-pooled over overlapping chunks (CHUNK bytes, half
of it apart) that cover every byte.  The mean and the maximum of the chunk
vectors, as one vector, go through a logistic layer to one probability.

The network is fitted on the driver on the whole texts of at most TRAIN_ROWS
labelled rows, 48 MB together (the documented bound of the sample); the fitted
arrays, a few hundred kB, are broadcast.

Defined edge cases: null and empty texts are scored as a run of zero bytes;
without labels of both kinds, or on an empty table, the score is 0.5; repeated
rows and repeated or null doc_ids are scored each; long texts are convolved
piece by piece, in bounded memory.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import table
from corpusloom.llm.learning import TRAIN_BYTES, split_of, training_texts

KERNEL = 5
FILTERS = 16
CHUNK = 512
TRAIN_ROWS = 3000
EPOCHS = 8
THRESHOLD = 0.3


class ByteCNN:
    """Filters as a table [KERNEL, 256, FILTERS]: the response at i is the sum of table[j, byte[i + j]]."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.RandomState(seed)
        self.table = rng.normal(0, 0.25, (KERNEL, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.weight = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    @staticmethod
    def bytes_of(text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        return np.concatenate([raw, np.zeros(KERNEL - 1 + (len(raw) == 0), np.uint8)])

    def pieces(self, raw: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first chunk, first position, responses) of runs of at most 256 chunks, which overlap by half a chunk."""
        n, half = len(raw) - KERNEL + 1, CHUNK // 2
        count = max(1, -(-(n - half) // half))
        for c in range(0, count, 256):
            lo, hi = c * half, n if c + 256 >= count else (c + 257) * half
            out = self.table[0][raw[lo:hi]]
            for j in range(1, KERNEL):
                out += self.table[j][raw[lo + j : hi + j]]
            yield c, lo, out

    def chunks(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled responses per chunk and the positions they come from; the last chunk ends with the document."""
        pooled, where, half = [], [], CHUNK // 2
        for _, lo, out in self.pieces(raw):
            for s in range(0, max(1, len(out) - half), half):
                part = out[s : s + CHUNK]
                where.append(lo + s + part.argmax(axis=0))
                pooled.append(part.max(axis=0))
        return np.maximum(np.stack(pooled) + self.bias, 0), np.stack(where)

    def features(self, raw: np.ndarray) -> np.ndarray:
        """Mean and maximum of the chunk vectors."""
        total, top, count, half = np.zeros(FILTERS, np.float64), None, 0, CHUNK // 2
        for _, _, out in self.pieces(raw):
            blocks = np.maximum.reduceat(out, np.arange(0, len(out), half), axis=0)
            pooled = np.maximum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks
            pooled = np.maximum(pooled + self.bias, 0)
            total += pooled.sum(axis=0)
            count += len(pooled)
            best = pooled.max(axis=0)
            top = best if top is None else np.maximum(top, best)
        return np.concatenate([total / count, top]).astype(np.float32)

    def score(self, raw: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(raw) @ self.weight + self.offset[0], -30, 30))))

    def fit(self, texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 5, rate: float = 0.02, batch: int = 16) -> ByteCNN:
        rng = np.random.RandomState(seed)
        data = [self.bytes_of(t) for t in texts]
        y = np.array(labels, np.float32)
        params = [self.table, self.bias, self.weight, self.offset]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for b in range(0, len(order), batch):
                grads = [np.zeros_like(p) for p in params]
                rows = order[b : b + batch]
                for i in rows:
                    raw = data[i]
                    pooled, where = self.chunks(raw)
                    top = pooled.argmax(axis=0)
                    f = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)])
                    err = (1 / (1 + np.exp(-np.clip(f @ self.weight + self.offset[0], -30, 30))) - y[i]) / len(rows)
                    grads[2] += err * f
                    grads[3] += err
                    g = np.repeat((err * self.weight[:FILTERS] / len(pooled))[None], len(pooled), axis=0)
                    g[top, np.arange(FILTERS)] += err * self.weight[FILTERS:]
                    g = g * (pooled > 0)
                    grads[1] += g.sum(axis=0)
                    lane = np.broadcast_to(np.arange(FILTERS), where.shape)
                    for j in range(KERNEL):
                        np.add.at(grads[0][j], (raw[where + j], lane), g)
                step += 1
                for k, p in enumerate(params):
                    grads[k] += 1e-4 * p
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    p -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, total: int = TRAIN_BYTES) -> ByteCNN | None:
    texts, y = training_texts(docs, labels, "quality", split_of(F.col("doc_id"), 5) != 0, rows, total)
    return ByteCNN().fit(texts, y) if len(set(y)) == 2 else None


def score_quality(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """(doc_id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for b in batches:
            scores = [net.score(net.bytes_of(t.as_py())) if net else 0.5 for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op2_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select("doc_id", (split_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_byte_cnn_quality": op2_byte_cnn_quality}
ORACLES: dict[str, str] = {}
