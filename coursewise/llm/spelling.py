"""Spelling variants: words of a vocabulary one edit apart, and the form each variant stands for.

* Words are counted in the tasks, in bounded dictionaries, and summed.
* A blocked Bloom filter, sharded by word length, holds the vocabulary: each
  word sets four bits of one 64-bit block of its length's shard. Its size is
  ``BITS`` a word, ``filter_bytes`` at most; a larger vocabulary is dealt over
  several such filters by hash and probed in as many rounds.
* Tasks generate the edits of their words as hashes, never as strings, and probe
  the broadcast filter: each deletion against the next shorter shard, each
  replacement by a *larger* letter against the word's own. Every near pair is
  met once this way: an insertion is the other word's deletion.
* Only positives become strings and are shuffled, to an exact join with the
  vocabulary, which takes out the filter's mistakes.
* A word's form is looked up from its near pairs; forms are followed by pointer
  doubling, a written table a round.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import folded, mixed, powers, texts, written

#: Letters of a word: ASCII lower case, and U+00C0 to U+00FF as they stand.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Filter bits a word, words of 64 bits in a chunk that one task builds.
BITS, CHUNK = 16, 8192
#: Words that a task counts before it passes them on; edits worked on at a time.
HELD, STEP = 200_000, 1 << 18


# ---- vocabulary ------------------------------------------------------------

def _counts(min_chars: int, drop_one_in: int):
    """(word, n) of a task's texts; a word may come more than once."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}")

    def run(batches):
        held: dict[str, int] = {}

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                here: dict[str, int] = {}
                for w in runs.findall((text or b"").lower().decode()):
                    here[w] = here.get(w, 0) + 1
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in here.items():
                    h = zlib.crc32(w.encode(), start)
                    if drop_one_in and h % drop_one_in == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < min_chars:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield out()
        yield out()
    return run


def vocabulary(docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_one_in: int = 31,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``min_chars`` letters that occur ``min_count`` times or more.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. In one of
    ``drop_one_in`` pairs of document and word (0: in none), chosen by
    crc32 of ``<id>:<word>``, the word loses a letter. A null text has no
    words, a null id is written as nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    counted = rows.mapInArrow(_counts(min_chars, drop_one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- filter ----------------------------------------------------------------

def _matrices(words: list[str]):
    """(rows, letters): the words of each length as a matrix of code points."""
    length = np.array([len(w) for w in words], np.int64)
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        step = max(1, STEP // size)
        for part in np.split(at, range(step, len(at), step)):
            yield part, np.frombuffer("".join(words[i] for i in part).encode("latin-1"), np.uint8).reshape(len(part), size)


def _terms(letters: np.ndarray) -> np.ndarray:
    return letters.astype(np.uint64) * powers(letters.shape[1] + 1)[0][:letters.shape[1]]


class Layout:
    """Where words go: the round, and the 64-bit block of the filter, by length and hash."""

    def __init__(self, counts: dict[int, int], filter_bytes: int):
        self.counts = counts
        self.rounds = max(1, -(-sum(counts.values()) * BITS // (8 * filter_bytes)))
        self.start: dict[int, tuple[int, int]] = {}
        at = 0
        for length in sorted(counts):
            size = max(1, -(-counts[length] * BITS // (64 * self.rounds)))
            self.start[length] = at, size
            at += size
        self.blocks = at

    def place(self, poly: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(round, block, bits) of sums of terms, all of words of ``length``."""
        h = mixed(poly)
        start, size = self.start[length]
        block = start + (((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        one, six = np.uint64(1), np.uint64(63)
        bits = (one << (h & six)) | (one << ((h >> np.uint64(6)) & six)) | (one << ((h >> np.uint64(12)) & six)) | (one << ((h >> np.uint64(18)) & six))
        part = (mixed(h) % np.uint64(self.rounds)).astype(np.int64) if self.rounds > 1 else np.zeros(len(h), np.int64)
        return part, block, bits


def bloom_filter(words: DataFrame, layout: Layout, part: int) -> np.ndarray:
    """The blocks of round ``part``, built in chunks by the tasks."""
    def place(batches):
        for b in batches:
            for _, letters in _matrices(b.column(0).to_pylist()):
                of, block, bits = layout.place(_terms(letters).sum(axis=1), letters.shape[1])
                here = of == part
                yield pa.RecordBatch.from_arrays([pa.array(block[here] // CHUNK), pa.array(block[here] % CHUNK), pa.array(bits[here].view(np.int64))],
                                                 ["chunk", "at", "bits"])

    def build(key, t):
        blocks = np.zeros(CHUNK, np.uint64)
        np.bitwise_or.at(blocks, t.column("at").to_numpy(), t.column("bits").to_numpy().view(np.uint64))
        return pa.table({"chunk": [key[0].as_py()], "blocks": pa.array([blocks.tobytes()], pa.binary())})

    chunks = words.select("word").mapInArrow(place, "chunk long, at long, bits long").groupBy("chunk").applyInArrow(build, "chunk long, blocks binary")
    out = np.zeros(-(-layout.blocks // CHUNK) * CHUNK, np.uint64)
    for r in chunks.toLocalIterator():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["blocks"], np.uint64)
    return out


# ---- neighbours ------------------------------------------------------------

def _edits(letters: np.ndarray, alphabet: list[int], counts: dict[int, int]):
    """(length, row, place, letter, sum of terms) of edits that could be words; letter 0 is a deletion."""
    rows, size = letters.shape
    up, down = powers(size + 1)
    terms = _terms(letters)
    total = terms.sum(axis=1)
    if counts.get(size - 1, 0) > 0:
        before = np.cumsum(terms, axis=1) - terms
        # of equal letters in a row, deleting the first says it all
        keep = np.ones(letters.shape, bool)
        keep[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row, at = np.nonzero(keep)
        yield size - 1, row, at, 0, before[row, at] + (total[row] - before[row, at] - terms[row, at]) * down[1]
    if counts[size] > 1:
        for a in alphabet:
            row, at = np.nonzero(letters < a)
            if len(row):
                yield size, row, at, a, total[row] + (np.uint64(a) - letters[row, at].astype(np.uint64)) * up[at]


def _edited(letters: np.ndarray, at: np.ndarray, letter: int) -> list[str]:
    n, size = letters.shape
    if letter:
        out = letters.copy()
        out[np.arange(n), at] = letter
    else:
        out = letters[np.arange(size)[None, :] != at[:, None]].reshape(n, size - 1)
    width, data = out.shape[1], out.tobytes().decode("latin-1")
    return [data[i:i + width] for i in range(0, n * width, width)]


def near_pairs(words: DataFrame, filter_bytes: int = 32 << 20) -> DataFrame:
    """(word, n, near, near_n): every two words of ``words`` (word, n) one edit apart, in both orders.

    ``words`` must be a written table of distinct words of ``LETTERS``.
    """
    spark = words.sparkSession
    schema = "edit string, word string, n long"
    counts = {r["l"]: r["c"] for r in words.groupBy(F.length("word").alias("l")).agg(F.count("*").alias("c")).collect()}

    def letters_of(batches):
        seen = np.zeros(256, bool)
        for b in batches:
            for w in b.column(0).to_pylist():
                seen[np.frombuffer(w.encode("latin-1"), np.uint8)] = True
        return seen

    seen = folded(words.select("word"), letters_of, np.logical_or)
    alphabet = [] if seen is None else np.flatnonzero(seen).tolist()
    layout = Layout(counts, filter_bytes)
    found = []
    for part in range(layout.rounds if alphabet else 0):
        blocks = spark.sparkContext.broadcast(bloom_filter(words, layout, part))

        def probe(batches, blocks=blocks, part=part):
            for b in batches:
                word, n = b.column(0).to_pylist(), b.column(1)
                for rows, letters in _matrices(word):
                    for size, row, at, letter, poly in _edits(letters, alphabet, counts):
                        of, block, bits = layout.place(poly, size)
                        hit = np.flatnonzero((blocks.value[block] & bits == bits) & (of == part))
                        if len(hit):
                            row, at = row[hit], at[hit]
                            from_ = pa.array(rows[row])
                            yield pa.RecordBatch.from_arrays([pa.array(_edited(letters[row], at, letter), pa.string()),
                                                              b.column(0).take(from_), n.take(from_)], ["edit", "word", "n"])

        found.append(written(words.select("word", "n").mapInArrow(probe, schema), "spelling-edits"))
    edits = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        edits = edits.union(more)
    real = edits.join(words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    a, b = (F.struct(F.col(w).alias("word"), F.col(n).alias("n")) for w, n in (("word", "n"), ("edit", "edit_n")))
    return real.select(F.explode(F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(b.alias("a"), a.alias("b")))).alias("p")).select(
        "p.a.word", "p.a.n", F.col("p.b.word").alias("near"), F.col("p.b.n").alias("near_n"))


def variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, ratio: int = 10, drop_one_in: int = 31,
             id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = 32 << 20) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    The form is the near word of largest count (on ties the smallest in
    code-point order) if that is ``ratio`` times the word's own at least, else
    null; ``root`` is where following forms ends, the word itself without one.
    Null and empty texts have no words, repeated rows count each, other columns
    aren't looked at; an empty table gives no rows.
    """
    words = written(vocabulary(docs, min_chars, min_count, drop_one_in, id_col, text_col), "spelling-words")
    near = near_pairs(words, filter_bytes).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    joined = words.join(near, "word", "left")
    large = -F.col("best.minus")
    has = F.coalesce(large >= ratio * F.col("n"), F.lit(False))
    out = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has, F.col("best.near")).alias("form"), F.when(has, large).alias("form_n")), "spelling-forms")
    # counts rise tenfold a step, so paths are short; each round doubles what is followed
    path = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        far = path.select(F.col("word").alias("root"), F.col("root").alias("far"))
        path = written(path.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
                       "spelling-roots")
        if not path.where("moved").limit(1).count():
            break
        path = path.select("word", "root")
    return out.join(path.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Words of all documents with the form and root they are a variant of."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
