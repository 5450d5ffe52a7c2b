"""Benchmark decontamination by latent semantic retrieval.

1. Passages are windows of documents; the benchmark's items are passages too,
   long ones several, and weigh as much as the corpus together, so that the
   leading dimensions tell them apart. TF-IDF runs over all words of the items,
   with document frequencies counted over all passages.
2. A randomised SVD of the passage matrix A: every task adds up its passages'
   share of Y = A'(A W) for a fixed W of the items and random columns; Y and
   W'Y give the leading right singular vectors (Nystroem's form, so one pass
   over the corpus does). An item that loses much of its norm there gets a
   dimension of its own.
3. Passages and items meet in the latent space: pairs with a cosine of
   ``min_cosine`` or more are candidates, and those where the passage holds
   half of the item's weight, however much it says besides.
4. A candidate leaks when the longest common subsequence of words holds enough
   of the item, or somewhat less of it but its answer (its last words) too.

The benchmark is worked on in blocks of item passages, so what travels to the tasks is
bounded by the block, whatever the size of either side.
"""

from __future__ import annotations

import copy
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import free_names

PASSAGE, STRIDE = 64, 32
#: Item passages in a block, latent dimensions (more where a block has more passages) and the sketch's extra ones.
BLOCK, RANK, EXTRA = 200, 224, 16
#: Rows that are multiplied as one dense matrix of the words they have.
ROWS = 96
#: Least share of its norm that an item passage keeps in the latent space, and least share of it that a passage holds.
MIN_KEPT, MIN_HELD = 0.8, 0.5
MIN_COSINE, MIN_LCS, MIN_LCS_WITH_ANSWER, MIN_ANSWER, ANSWER_WORDS = 0.25, 0.8, 0.6, 0.75, 8

#: ASCII letters and digits and all bytes of other scripts stay; all else parts words.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(_FOLD).split()


class Items:
    """A block of the benchmark: item ids, their words, and the numbers of their words."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        kept = [(i, w) for i, w in ((i, normal_words(t)) for i, t in rows) if w]
        self.ids, self.words = [i for i, _ in kept], [w for _, w in kept]
        self._take([(k, p * STRIDE) for k, w in enumerate(self.words) for p in range(max(1, 1 - (PASSAGE - len(w)) // STRIDE))])

    def _take(self, places: list[tuple[int, int]]) -> None:
        """Works on the passages at ``places``, pairs of (item, first word)."""
        self.places = places
        self.bags = [self.words[k][a:a + PASSAGE] for k, a in places]
        self.number = {w: k for k, w in enumerate(sorted({w for ws in self.bags for w in ws}))}

    def parts(self, most: int) -> Iterator[Items]:
        """The same items in even parts of ``most`` passages at most; a long item may be in several."""
        n = -(-len(self.places) // most)
        for k in range(n):
            part = copy.copy(self)
            part._take(self.places[len(self.places) * k // n:len(self.places) * (k + 1) // n])
            yield part

    def matcher(self, k: int) -> tuple[dict[bytes, int], int]:
        """Bit masks of the places of each word of item ``k``, and its length."""
        masks: dict[bytes, int] = defaultdict(int)
        for p, w in enumerate(self.words[k]):
            masks[w] |= 1 << p
        return dict(masks), len(self.words[k])


def common_subsequence(masks: dict[bytes, int], length: int, words: list[bytes]) -> int:
    """Bit b of the result is clear where the longest common subsequence grows at word b of the item."""
    full = (1 << length) - 1
    v = full
    for w in words:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return v


def _numbers(words: list[bytes], number: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))


def _strides(n: int) -> int:
    return max(1, -(-n // STRIDE))


def _strided(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stride, word) of every word numbered 0 or more of some texts, and the text of each stride; strides are numbered through."""
    sizes = np.array([_strides(len(x)) for x in numbers], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    at = [np.flatnonzero(x >= 0) for x in numbers]
    stride = np.concatenate([b + a // STRIDE for b, a in zip(base, at, strict=False)] or [np.zeros(0, np.int64)])
    word = np.concatenate([x[a] for x, a in zip(numbers, at, strict=True)] or [np.zeros(0, np.int64)])
    return stride, word, np.repeat(np.arange(len(numbers)), sizes)


class Weights:
    """TF-IDF over the words of a block's items."""

    def __init__(self, number: dict[bytes, int], idf: np.ndarray):
        self.number, self.idf = number, idf

    def _counted(self, place: np.ndarray, word: np.ndarray):
        key, count = np.unique(place * len(self.idf) + word, return_counts=True)
        place, word = key // len(self.idf), key % len(self.idf)
        return key, place, word, (count * self.idf[word]).astype(np.float32)

    def items(self, items: Items):
        """(row, word, weight, size) of the block's passages, of unit length; ``size`` is what they were."""
        numbers = [_numbers(w, self.number) for w in items.bags]
        _, row, word, x = self._counted(np.repeat(np.arange(len(numbers)), [len(v) for v in numbers]), np.concatenate(numbers))
        size = np.sqrt(np.bincount(row, x * x, minlength=len(numbers)))
        return row, word, (x / size[row]).astype(np.float32), size.astype(np.float32)

    def strides(self, numbers: list[np.ndarray]):
        """(stride, word, weight, size of each passage, text of each stride).

        Passage p is stride p and the one behind it in the same text, and its
        row is the sum of their rows: so each word is projected once.
        """
        stride, word, text = _strided(numbers)
        key, stride, word, x = self._counted(stride, word)
        own = np.bincount(stride, x * x, minlength=len(text))
        size = own + _behind(own, text)
        if len(key):
            other = np.minimum(np.searchsorted(key, key + len(self.idf)), len(key) - 1)
            both = (key[other] == key + len(self.idf)) & (text[stride] == text[np.minimum(stride + 1, len(text) - 1)])
            size += np.bincount(stride[both], 2 * x[both] * x[other[both]], minlength=len(text))
        return stride, word, x, np.sqrt(size).astype(np.float32), text


def _behind(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of each stride, the value of the next one of its text, or 0."""
    out = np.zeros_like(values)
    same = np.flatnonzero(text[1:] == text[:-1])
    out[same] = values[same + 1]
    return out


def _before(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Of each stride, the value of the one before it in its text, or 0."""
    out = np.zeros_like(values)
    same = np.flatnonzero(text[1:] == text[:-1])
    out[same + 1] = values[same]
    return out


def _blocks(row: np.ndarray, word: np.ndarray, weight: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words, dense matrix of these rows and words) of some rows at a time; ``row`` ascends, and a pair comes once."""
    ends = np.searchsorted(row, np.arange(0, n + ROWS, ROWS))
    for at, a, b in zip(range(0, n, ROWS), ends, ends[1:], strict=False):
        words, column = np.unique(word[a:b], return_inverse=True)
        matrix = np.zeros((min(ROWS, n - at), len(words)), np.float32)
        matrix[row[a:b] - at, column] = weight[a:b]
        yield at, words, matrix


def _project(row: np.ndarray, word: np.ndarray, weight: np.ndarray, n: int, to: np.ndarray) -> np.ndarray:
    """Rows times ``to``; ``row`` ascends."""
    out = np.empty((n, to.shape[1]), np.float32)
    for at, words, matrix in _blocks(row, word, weight, n):
        np.matmul(matrix, to[words], out=out[at:at + ROWS])
    return out


def _batches(batch, column: int, size: int = 200):
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        yield part, [normal_words(t) for t in part.column(column).to_pylist()]


def _frequencies(number: dict[bytes, int]):
    """Number of passages (by stride) that hold each word: a row for each word of a task; word -1: all passages."""
    def run(batches):
        total, held = 0, np.zeros(len(number), np.int64)
        for b in batches:
            for _, texts in _batches(b, 0):
                xs = [_numbers(w, number) for w in texts]
                base = np.concatenate([[0], np.cumsum([_strides(len(x)) for x in xs])])
                total += int(base[-1])
                keys = [(b0 + np.flatnonzero(x >= 0) // STRIDE) * len(number) + x[x >= 0] for b0, x in zip(base, xs, strict=False)]
                held += np.bincount(np.unique(np.concatenate(keys)) % len(number), minlength=len(number))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(held[some], total))], ["word", "n"])
    return run


def _sketch(weights: Weights, test: np.ndarray):
    """A task's share of A'(A W): rows (word, vector)."""
    def run(batches):
        y = np.zeros(test.shape, np.float64)
        for b in batches:
            for _, texts in _batches(b, 0):
                stride, word, x, size, text = weights.strides([_numbers(w, weights.number) for w in texts])
                z = _project(stride, word, x, len(text), test)
                z = (z + _behind(z, text)) / np.maximum(size * size, 1e-12)[:, None]
                _add(y, stride, word, x, z + _before(z, text))
        some = np.flatnonzero(np.abs(y).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array([v.astype("<f4").tobytes() for v in y[some]], pa.binary())],
                                         ["word", "vector"])
    return run


def _add(y: np.ndarray, row: np.ndarray, word: np.ndarray, weight: np.ndarray, z: np.ndarray) -> None:
    """``y`` grows by the transposed rows times ``z``; ``row`` ascends."""
    for at, words, matrix in _blocks(row, word, weight, len(z)):
        y[words] += matrix.T @ z[at:at + ROWS]


def _summed(df: DataFrame) -> DataFrame:
    """Sums of the vectors of each word: first within 64 groups of a word's rows, then of those."""
    def run(batches):
        have: dict[tuple, np.ndarray] = {}
        for b in batches:
            for w, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                v = np.frombuffer(v, "<f4").astype(np.float64)
                have[w] = have[w] + v if w in have else v
        if have:
            yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int64()), pa.array([v.astype("<f4").tobytes() for v in have.values()], pa.binary())],
                                             ["word", "vector"])

    for by in ((F.col("word"), F.pmod(F.xxhash64("vector"), F.lit(64))), (F.col("word"),)):
        df = df.repartition(*by).mapInArrow(run, "word long, vector binary")
    return df


def latent_space(docs: DataFrame, items: Items, text_col: str) -> tuple[Weights, np.ndarray]:
    """(weights, vectors): TF-IDF of the block's words, and the leading right singular vectors of all passages.

    The test matrix holds the block's passages beside random columns, so that
    the sketch is exact on them. An item passage that still keeps less than
    MIN_KEPT of its norm gets a dimension of its own.
    """
    text = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = (text.mapInArrow(_frequencies(items.number), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
               .collect())  # a row for each word of the block
    seen = {r.word: r.n for r in counted}
    n = len(items.bags)
    total = seen.pop(-1, 0) + n
    weights = Weights(items.number, np.log1p(total / np.array([seen.get(k, 0) + 1 for k in range(len(items.number))])))
    row, word, x, _ = weights.items(items)
    own = np.zeros((len(items.number), n), np.float32)
    own[word, row] = x
    rank = max(RANK, n + RANK - BLOCK)
    some = np.random.default_rng(11).standard_normal((len(own), rank + EXTRA - n)) / math.sqrt(len(own))
    test = np.ascontiguousarray(np.hstack([own, some]), np.float32)
    y = np.zeros(test.shape)
    for r in _summed(text.mapInArrow(_sketch(weights, test), "word long, vector binary")).collect():  # a row for each word
        y[r.word] += np.frombuffer(r.vector, "<f4")
    vectors = _vectors(y + own @ (own.T @ test) * (total / n), test, rank)
    lost = own - vectors @ (vectors.T @ own)
    lost = lost[:, (lost * lost).sum(axis=0) > 1 - MIN_KEPT * MIN_KEPT]
    return weights, np.ascontiguousarray(np.hstack([vectors, np.linalg.qr(lost)[0]]), np.float32)


def _vectors(y: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of G from Y = G W: those of Y (W'Y)^-1 Y'."""
    core = test.T.astype(np.float64) @ y
    values, basis = np.linalg.eigh((core + core.T) / 2)
    good = values > values[-1] * 1e-7
    u, s, _ = np.linalg.svd(y @ (basis[:, good] / np.sqrt(values[good])), full_matrices=False)
    return np.ascontiguousarray(u[:, :rank], np.float32)


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-6)


FOUND = "doc_id long, xh long, item_id long, start int, cosine double, lcs double, answer double, leaks boolean"


def candidates(docs: DataFrame, items: Items, weights: Weights, vectors: np.ndarray, id_col: str, text_col: str,
               min_cosine: float) -> DataFrame:
    """FOUND: every passage and item that are near, with the checks of their words.

    Near is a cosine of ``min_cosine`` or more, or a passage that holds MIN_HELD
    of the item passage's length, whatever else the passage says.
    """
    row, word, x, own_size = weights.items(items)
    latent = _unit(_project(row, word, x, len(own_size), vectors))
    item_of = [k for k, _ in items.places]  # a long item has several passages
    gain = np.ascontiguousarray(vectors @ latent.T)  # of each word and item passage: the word's share of their product in the latent space
    matchers = {k: items.matcher(k) for k in set(item_of)}
    ids_of = {k: items.ids[k] for k in matchers}
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches):
        for b in batches:
            for part, texts in _batches(b, 2):
                stride, word, x, size, text = weights.strides([_numbers(w, weights.number) for w in texts])
                products = _project(stride, word, x, len(text), gain)
                products += _behind(products, text)
                size = np.maximum(size, 1e-6)[:, None]
                first = np.searchsorted(text, text)  # of each passage's text, its first passage
                ids, keys, out = part.column(0).to_pylist(), part.column(1).to_pylist(), [[] for _ in names]
                for at in range(0, len(products), 2048):
                    along = products[at:at + 2048]
                    near = along / size[at:at + 2048]
                    best: dict[tuple[int, int], float] = {}
                    for r, i in zip(*np.nonzero((near >= min_cosine) | (along >= MIN_HELD * own_size)), strict=True):
                        pair = at + int(r), item_of[i]
                        best[pair] = max(best.get(pair, -1.0), float(near[r, i]))
                    for (p, k), cosine in best.items():
                        t, start = int(text[p]), int(p - first[p]) * STRIDE
                        masks, n = matchers[k]
                        v = common_subsequence(masks, n, texts[t][max(0, start - n):start + PASSAGE + n])
                        share = (n - v.bit_count()) / n
                        tail = min(n, ANSWER_WORDS)
                        answer = (tail - (v >> (n - tail)).bit_count()) / tail
                        leaks = share >= MIN_LCS or (share >= MIN_LCS_WITH_ANSWER and answer >= MIN_ANSWER)
                        for c, value in zip(out, (ids[t], keys[t], ids_of[k], start, cosine, share, answer, leaks), strict=True):
                            c.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("xh"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, FOUND)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", min_cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """(doc_id, xh, item_id, start, cosine, lcs, answer) of the best passage of each document and item that leak.

    ``xh`` is a hash of the text, so rows that share an id stay apart;
    ``start`` is the passage's first word. Null or empty texts and items have
    no words and never leak; items with a null id keep it; equal items leak
    each on their own; repeated rows give one row. Other columns aren't looked
    at. With an empty table on either side the result is empty.
    """
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t"))
    blocks = max(1, math.ceil(rows.count() / block))
    out = None
    for k in range(blocks):
        some = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()  # a block of the query set
        for items in Items(sorted(((r.i, r.t) for r in some), key=repr)).parts(block + block // 4):
            found = candidates(docs, items, *latent_space(docs, items, text_col), id_col, text_col, min_cosine).where("leaks")
            out = found if out is None else out.union(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], FOUND)
    best = F.max(F.struct("lcs", "answer", "cosine", (-F.col("start")).alias("s")))
    return (out.groupBy("doc_id", "xh", "item_id").agg(best.alias("b"))
            .select("doc_id", "xh", "item_id", (-F.col("b.s")).cast("int").alias("start"), "b.cosine", "b.lcs", "b.answer"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item of ``benchmark``; rows with null texts stay."""
    (xh,) = free_names(docs, "_leak_xh")
    found = leaks(docs, benchmark, id_col, text_col).select(F.col("xh").alias(xh)).distinct()
    return docs.join(found, F.xxhash64(F.col(text_col).cast("string")) == F.col(xh), "left_anti")


def op4_latent_leaks(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in its words or nearly."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "start", F.round("cosine", 3).alias("cosine"), "lcs", "answer")
