"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

The second form of the pairwise term costs one pass over a document's features
for each factor, however many pairs they make.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import Words, chunks
from coursewise.llm.sampling import about, crc_bucket

#: Word buckets, factors, labelled rows to learn from (about so many), passes over them.
BUCKETS, FACTORS, ROWS, EPOCHS = 1 << 11, 8, 4000, 25
STATS = 12

_KIND = np.zeros(256, np.int64)  # 0: other
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[[ord(c) for c in "#*$%&|<>"]] = 4
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_KIND[[0x20, *range(0x09, 0x0E)]] = 6
_KIND[128:] = 7


def statistics(data: np.ndarray, words: np.ndarray, lengths: np.ndarray, n_chars: int) -> np.ndarray:
    """Structure of a text: lengths, shares of byte classes, repetition; each about 0 to 1."""
    kinds = np.bincount(_KIND[data], minlength=8)[:8] / max(1, len(data))
    distinct = len(np.unique(words)) / max(1, len(words))
    lines = int((data == 10).sum()) + 1
    return np.array([*kinds[1:], distinct, np.log1p(len(words)) / 12, (lengths.mean() if len(lengths) else 0) / 20,
                     np.log1p(len(words) / lines) / 8, np.log1p(n_chars) / 14], np.float32)


def document(data: np.ndarray, words: np.ndarray, lengths: np.ndarray, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, values): the hashed words' log counts on the unit sphere, then the statistics."""
    count = np.bincount((words >> np.uint64(64 - 11)).astype(np.int64), minlength=BUCKETS)
    some = np.flatnonzero(count)
    value = np.log1p(count[some])
    value /= max(1e-9, float(np.sqrt(value @ value)))
    n_chars = len(data) if n_chars is None or n_chars < 0 else n_chars
    return (np.concatenate([some, BUCKETS + np.arange(STATS)]),
            np.concatenate([value, statistics(data, words, lengths, n_chars)]).astype(np.float32))


def features(batch, text_column: int, chars_column: int):
    """``document`` of each row of a batch, in order."""
    n_chars = batch.column(chars_column).to_pylist()
    for c in chunks(batch.column(text_column)):
        w = Words(c, lower=True)
        length = (w.end - w.start).astype(np.float32)
        for i in range(c.rows):
            a, z = w.first[i], w.first[i + 1]
            yield document(c.data[c.offsets[i]:c.offsets[i + 1]], w.hash[a:z], length[a:z], n_chars[c.row + i])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logit(self, features: np.ndarray, values: np.ndarray) -> float:
        """Linear time: one pass over the features."""
        v = self.factors[features] * values[:, None]
        s = v.sum(axis=0)
        return float(self.bias + self.linear[features] @ values + 0.5 * (s @ s - (v * v).sum()))

    def score(self, features: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(features, values), -30, 30))))


def train(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, rate: float = 0.02,
          decay: float = 1e-5, seed: int = 1) -> Machine:
    """Logistic loss by Adam over mini-batches of dense rows ``x``; the classes weigh the same in sum."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    share = y.mean() if n else 0.5
    if not n or share in (0.0, 1.0):
        return Machine(0.0 if not n else (4.0 if share else -4.0), np.zeros(d, np.float32), np.zeros((d, factors), np.float32))
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    theta = [np.zeros(1, np.float32), np.zeros(d, np.float32), rng.normal(0, 0.02, (d, factors)).astype(np.float32)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            some = order[at:at + 128]
            b = x[some]
            s = b @ theta[2]
            b2 = b * b
            logit = theta[0] + b @ theta[1] + 0.5 * ((s * s).sum(1) - b2 @ (theta[2] ** 2).sum(1))
            e = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[some]) * weight[some] / len(some)
            grads = [np.array([e.sum()], np.float32), b.T @ e,
                     b.T @ (e[:, None] * s) - theta[2] * (b2.T @ e)[:, None]]
            step += 1
            for k, g in enumerate(grads):
                g = g + decay * theta[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                theta[k] = theta[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(float(theta[0][0]), theta[1], theta[2])


def _texts(docs: DataFrame, id_col: str, text_col: str, chars_col: str) -> DataFrame:
    n_chars = F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), n_chars.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = ROWS, id_col: str = "doc_id",
        text_col: str = "text", chars_col: str = "n_chars") -> Machine:
    """Machine learnt from about ``rows`` of the labelled rows (null ids and labels aren't used)."""
    some = about(labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
                 .where("doc_id is not null and label is not null"), "doc_id", rows)

    def run(batches):
        for b in batches:
            made = list(features(b, 1, 2))
            yield pa.RecordBatch.from_arrays(
                [b.column(3), pa.array([f.tolist() for f, _ in made], pa.list_(pa.int32())),
                 pa.array([v.tolist() for _, v in made], pa.list_(pa.float32()))], ["label", "features", "values"])

    joined = _texts(docs, id_col, text_col, chars_col).join(F.broadcast(some), "doc_id")  # ``rows`` bounds it
    got = (joined.select("doc_id", "text", "n_chars", "label")
           .mapInArrow(run, "label int, features array<int>, values array<float>")
           .orderBy(F.xxhash64("values"), "label").toArrow())  # the same order on every run
    x = np.zeros((got.num_rows, BUCKETS + STATS), np.float32)
    for i, (f, v) in enumerate(zip(got.column("features"), got.column("values"), strict=True)):
        x[i, f.values.to_numpy()] = v.values.to_numpy()
    return train(x, got.column("label").to_numpy().astype(np.float32))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """(doc_id, score) of every row: how likely its label is 1.

    Null and empty texts are scored by their statistics; repeated rows get
    equal scores, null ids stay null, other columns aren't looked at.
    """
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([machine.score(f, v) for f, v in features(b, 1, 2)], pa.float64())], ["doc_id", "score"])

    return _texts(docs, id_col, text_col, chars_col).mapInArrow(run, "doc_id long, score double")


def op8_factorization_machine(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document; learnt from labels whose CRC bucket of five isn't 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = fit(docs, labels.where(crc_bucket("doc_id", 5) != 0))
    held = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    return score(docs, machine).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
