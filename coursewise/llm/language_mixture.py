"""Language identification by multilingual mixture inference.

Each language is a distribution over byte trigrams. A document is a mixture:
expectation-maximisation estimates the proportions of a set of languages from
the trigrams' likelihoods, and sets are compared by likelihood less a penalty
for each language. Sets grow in the order of the proportions of the mixture of
all languages, as long as the penalised likelihood does.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import chunks, texts
from coursewise.llm.sampling import about, crc_bucket

#: Trigram hash buckets, documents a language is learnt from (about so many), EM steps.
BUCKETS, PER_LANGUAGE, STEPS = 1 << 15, 1500, 10
#: Likelihood a further language must add: this many nats, and so many for each doubling of the trigrams.
PENALTY, PENALTY_PER_DOUBLING = 6.0, 2.0

#: ASCII letters in lower case, bytes of other scripts as they are, all else a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that starts at each byte (two fewer than bytes)."""
    b = _FOLD[data].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - 15)


def _short(data: bytes) -> np.ndarray:
    """Trigrams of a text of under three bytes: with spaces around it."""
    return trigrams(np.frombuffer(b" " + data + b" ", np.uint8))


def counts_by_language(batches):
    """Trigram counts of (lang, text) rows: one row for each language of a task."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs = b.column(0).to_pylist()
        for c in chunks(b.column(1)):
            grams = trigrams(c.data)
            for i in range(c.rows):
                own = grams[c.offsets[i]:max(c.offsets[i], c.offsets[i + 1] - 2)]
                total.setdefault(langs[c.row + i], np.zeros(BUCKETS, np.int64))
                total[langs[c.row + i]] += np.bincount(own, minlength=BUCKETS)
    for lang, n in total.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])],
                                         ["lang", "bucket", "n"])


class Model:
    """Languages and, by bucket, their trigram probabilities (add-half smoothing)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + 0.5
        self.prob = smooth / smooth.sum(axis=0)
        self.log = np.log(self.prob)

    def mixture(self, n: np.ndarray, prob: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """(proportions, log likelihood) after STEPS steps of EM from ``weights``."""
        total = n.sum()
        for _ in range(STEPS):
            weights = weights * ((n / (prob @ weights)) @ prob) / total
        return weights, float(n @ np.log(prob @ weights))

    def infer(self, grams: np.ndarray) -> dict[str, float]:
        """Proportions of the languages of the chosen set, largest first."""
        n = np.bincount(grams, minlength=BUCKETS)
        some = np.flatnonzero(n)
        n = n[some].astype(np.float64)
        prob, k = self.prob[some], len(self.langs)
        weights, _ = self.mixture(n, prob, np.full(k, 1 / k))
        order = np.argsort(-weights, kind="stable")
        best, best_at = np.ones(1), float(n @ self.log[some, order[0]])
        penalty = PENALTY + PENALTY_PER_DOUBLING * math.log2(1 + n.sum())
        for size in range(2, k + 1):
            chosen = order[:size]
            w, fit = self.mixture(n, np.ascontiguousarray(prob[:, chosen]), weights[chosen] / weights[chosen].sum())
            if fit - (size - 1) * penalty <= best_at:
                break
            best, best_at = w, fit - (size - 1) * penalty
        by = sorted(zip(best.tolist(), order.tolist(), strict=False), key=lambda x: (-x[0], x[1]))
        return {self.langs[i]: w for w, i in by}


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """Trigram model of about ``per_language`` documents of each language of ``docs`` (null text, language or id: not used)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("id is not null and text is not null and lang is not null")
    sample = None
    for lang in sorted(r.lang for r in rows.select("lang").distinct().collect()):  # a row for each language
        one = about(rows.where(F.col("lang") == lang), "id", per_language).select("lang", "text")
        sample = one if sample is None else sample.union(one)
    if sample is None:
        return Model([], np.zeros((BUCKETS, 0)))
    made = (sample.mapInArrow(counts_by_language, "lang string, bucket int, n long").groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n")).toArrow())  # BUCKETS rows a language at most
    langs = sorted(set(made.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    column = np.array([langs.index(x) for x in made.column("lang").to_pylist()], np.int64)
    counts[made.column("bucket").to_numpy(), column] = made.column("n").to_numpy()
    return Model(langs, counts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, proportions) of every row.

    ``lang_pred`` is the language with the largest proportion of the chosen
    set, ``score`` that proportion, ``proportions`` the whole set. A null text
    or one without a letter is ``und`` with score 0 (also if the model has no
    languages). Equal proportions go to the language first in order. Repeated
    rows get equal results; null ids stay null.
    """
    def run(batches):
        for b in batches:
            out: list[list] = [[], [], []]
            raw = texts(b.column(1))
            for c in chunks(b.column(1)):
                grams = trigrams(c.data)
                for i in range(c.rows):
                    text = raw[c.row + i] or b""
                    own = grams[c.offsets[i]:max(c.offsets[i], c.offsets[i + 1] - 2)]
                    found: dict[str, float] = {}
                    if model.langs and _has_letter(text):
                        found = model.infer(own if len(own) else _short(text))
                    lang, score = next(iter(found.items()), ("und", 0.0))
                    for column, v in zip(out, (lang, min(1.0, max(0.0, score)), list(found.items())), strict=True):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()),
                 pa.array(out[2], pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "proportions"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, proportions map<string,double>")


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text[:64].decode(errors="ignore"))) or any(map(str.isalpha, text.decode(errors="ignore")))


def op5_language_mixture(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt from documents whose CRC bucket of four isn't 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(crc_bucket("doc_id", 4) != 2))
    held = F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
