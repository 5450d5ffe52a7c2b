"""Packing of tokenised documents into sequences: dominance reduction, then best fit.

How many pieces there are of every length decides the packing, and there are
at most ``capacity`` lengths, so the plan is made from that histogram alone. It
says where the i-th piece of each length goes; the pieces find their numbers
by a distributed rank and their places from the plan, each on its own.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import written
from coursewise.llm.hilbert_shards import ranked

CAPACITY, END = 1024, 2
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


# ---- tokens ----------------------------------------------------------------

def _byte_alphabet() -> dict[int, str]:
    """Character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Remembered(dict):
    """Values that ``learn`` works out the first time a key is asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key):
        value = self[key] = self.learn(key)
        return value


class TokenIds:
    """Token ids of whole texts as little-endian unsigned 32-bit integers, with a memory of words.

    The tokenizer's pattern never matches across the place before a space that
    follows a non-space (a single space opens the next match), either side of a
    line break between non-spaces, or between a letter or digit and a mark. A
    text is the concatenation of the parts between such places, and parts
    recur, so each is encoded once while it is remembered. The memory is
    emptied when it holds ``remember`` words.
    """

    _BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
    _MARKS = ".,;:!?"

    def __init__(self, path: str, remember: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # their strings in a text are one token each, found before any pattern
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.alphabet = self.tokenizer.model, _byte_alphabet()
        self.space = self.alphabet[32]
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.parts = _Remembered(self._part)  # as they are
        self.words = _Remembered(self._word)  # behind a space; or behind a line break, which then is the first character

    def _bytes(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()

    def _merged(self, letters: str, before: str) -> bytes:
        """Ids of one match of the pattern: letters, or letters behind a space. Straight to the merges."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.alphabet)
        return self._bytes([t.id for t in self.model.tokenize(before + letters)])

    def _encoded(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, text: str) -> bytes:
        if text.isalpha():
            return self._merged(text, "")
        stem = text.rstrip(self._MARKS)
        if stem != text and stem and stem[-1].isalnum():
            return self.parts[stem] + self.parts[text[len(stem):]]
        return self._encoded(text)

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._merged(word, self.space)
        if word[0] == "\n":
            return self.parts["\n"] + self.parts[word[1:]]
        stem = word.rstrip(self._MARKS)
        if stem != word and stem and stem[-1].isalnum():
            return self.words[stem] + self.parts[word[len(stem):]]
        return self._encoded(" " + word)

    def encode(self, text: str) -> bytes:
        if len(self.words) + len(self.parts) > self.remember:
            self._forget()
        if any(t in text for t in self.added):
            return self._encoded(text)
        flat = text.replace("\n", " ")
        # only single spaces and line breaks, and none at the ends
        if flat.isprintable() and "  " not in flat and flat.strip(" ") == flat:
            first, *words = text.replace("\n", " \n").split(" ")
            return self.parts[first] + b"".join(map(self.words.__getitem__, words))
        return b"".join(map(self.parts.__getitem__, self._BEFORE_SPACE.split(text)))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' ids, closed by ``end``, cut to ``capacity``.

    Only documents longer than ``capacity`` are cut; the first of their pieces
    takes what the full ones leave.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        coder, close = TokenIds(path), int(end).to_bytes(4, "little")
        for b in batches:
            for at in range(0, b.num_rows, 200):
                rows = b.slice(at, 200)
                out: list[list] = [[], [], [], [], []]
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    ids = coder.encode(text or "") + close
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    a, k = 0, 0
                    while a < n:
                        z = first if a == 0 else a + capacity
                        for column, v in zip(out, (doc, k, a, z - a, zlib.crc32(ids[4 * a:4 * z])), strict=True):
                            column.append(v)
                        a, k = z, k + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


# ---- the plan --------------------------------------------------------------

class Plan:
    """Bins for a histogram of lengths: rows (length, first, bin, per_bin, offset) in ``segments``.

    A row says that pieces ``first``, ``first + 1``, ... of that length, up to
    the next row's first, go to bins ``bin``, ``bin + 1``, ..., ``per_bin`` to
    each, the first of each bin at ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.bins = 0
        self.segments: list[tuple[int, int, int, int, int]] = []
        self._reduce()
        self.reduced_bins = self.bins
        self._best_fit()

    def _put(self, size: int, n: int, bin_: int, per_bin: int, offset: int) -> None:
        self.segments.append((size, self.used[size], bin_, per_bin, offset))
        self.used[size] += n
        self.left[size] -= n

    def _fix(self, sizes: list[int], n: int) -> None:
        """``n`` bins that hold just these sizes."""
        offset = 0
        for s in dict.fromkeys(sizes):
            per = sizes.count(s)
            self._put(s, n * per, self.bins, per, offset)
            offset += s * per
        self.bins += n

    def _smallest(self, n: int) -> list[int]:
        """The ``n`` smallest sizes left (fewer if there aren't as many), repeats included."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.left[s], n - len(out))
            if len(out) == n:
                break
        return out

    def _reduce(self) -> None:
        """Martello and Toth's reduction, for all pieces of a length at a time.

        A bin dominates another with the same largest piece when what the other
        holds besides could be put in the place of single pieces of the first.
        For the largest piece s, with room r beside it:

        * nothing left fits into r: s alone;
        * the largest k that fits fills r, or no two pieces left fit into r: s and k;
        * no three pieces left fit, and no two that fit together exceed k: s and k.
        """
        self.sizes = sorted(s for s, n in self.left.items() if n)
        for s in reversed(list(self.sizes)):
            while self.left[s]:
                self.sizes = [x for x in self.sizes if self.left[x]]
                self.left[s] -= 1  # the others
                room, low = self.capacity - s, self._smallest(3)
                at = [x for x in self.sizes if x <= room and self.left[x]]
                self.left[s] += 1
                if not at:
                    self._fix([s], self.left[s])
                    break
                k = at[-1]
                pair = (self.left[s] // 2) if k == s else min(self.left[s], self.left[k])
                one = k == room or len(low) < 2 or sum(low[:2]) > room
                if not one and ((len(low) == 3 and sum(low) <= room) or self._best_pair(s, room) > k):
                    break
                # with fewer pieces left the test holds all the more, until one of the two lengths runs out
                self._fix([s, k], pair)

    def _best_pair(self, s: int, room: int) -> int:
        """The largest sum within ``room`` of two pieces left, one ``s`` aside."""
        self.left[s] -= 1
        have = [x for x in self.sizes if self.left[x]]
        best = 0
        for x in have:
            i = bisect_left(have, room - x + 1) - 1
            if i >= 0 and have[i] == x and self.left[x] < 2:
                i -= 1
            if i >= 0:
                best = max(best, x + have[i])
        self.left[s] += 1
        return best

    def _best_fit(self) -> None:
        """Best fit by decreasing length: each piece goes where it leaves the least room."""
        open_: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]  # by room: (first bin, bins)
        for s in sorted((s for s, n in self.left.items() if n), reverse=True):
            while n := self.left[s]:
                room = next((r for r in range(s, self.capacity + 1) if open_[r]), None)
                if room is None:
                    room = self.capacity
                    per = room // s
                    bin_, bins = self.bins, -(-n // per)
                    self.bins += bins
                else:
                    bin_, bins = open_[room].pop()
                    per = room // s  # the bin that got a piece has the least room still
                full, rest = divmod(min(n, bins * per), per)
                at = self.capacity - room
                self._put(s, full * per + rest, bin_, per, at)
                for first, many, took in ((bin_, full, per), (bin_ + full, bool(rest), rest), (bin_ + full + bool(rest), bins - full - bool(rest), 0)):
                    if many:
                        open_[room - took * s].append((first, int(many)))

    def arrays(self) -> list[np.ndarray]:
        rows = np.array(sorted(self.segments), np.int64).reshape(-1, 5)
        return [rows[:, i] for i in range(5)]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its place: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is one piece, ``end`` alone. Repeated rows and rows
    with a null id are packed like any other. Ties of length go by id and piece;
    rows equal in these too take their places in any order. Other columns of
    ``docs`` are not looked at; an empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    # written before it is ranked: ranges are found by a pass of their own, which would encode everything again
    cut = written(pieces(docs, path, capacity, end, id_col, text_col), "pieces")
    made, _ = ranked(cut, ["length", "doc_id", "piece"], "pieces-ranked")
    counts = {r.length: r["count"] for r in made.groupBy("length").count().collect()}  # capacity rows at most
    length, first, bin_, per_bin, offset = Plan(counts, capacity).arrays()
    sizes = np.array(sorted(counts), np.int64)
    before = np.concatenate([[0], np.cumsum([counts[int(s)] for s in sizes])]).astype(np.int64)
    start = before[np.searchsorted(sizes, length)] + first  # the ranks where segments begin, ascending

    def place(batches):
        for b in batches:
            rank = b.column(5).to_numpy(zero_copy_only=False)
            k = np.searchsorted(start, rank, "right") - 1
            i = rank - start[k]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(bin_[k] + i // per_bin[k]), pa.array(offset[k] + i % per_bin[k] * length[k])],
                [*b.schema.names[:5], "sequence_id", "offset"])

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return made.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, columns + ", sequence_id long, offset long")


def op3_reduced_packing(spark, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
