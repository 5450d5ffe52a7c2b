"""Removal of repeated passages with compressed FM-indexes, one per shard.

A window is ``window`` consecutive words of one document. A word goes when a
window that covers it has a word sequence that also starts in a document with
a smaller id; windows are judged on the input, not on what is left.

* Runs of ``gram`` words are the symbols. Every window has the smallest symbol
  hash it contains as its anchor, so equal windows have equal anchors.
* A context is the part of a document that the windows of one anchor occupy. One
  pass over the texts gives each context's digest and places, without its words.
  Equal contexts are one, known by the smallest id that has them; a document
  that repeats one lists the places. Only contexts of anchors that several
  documents own go on, and the words of each are then cut from one text, once.
* A shard indexes the contexts of its anchors: the symbols of each context,
  taken every ``gram`` words in ``gram`` interleaved sequences, form the text;
  an FM-index (Burrows-Wheeler transform in a wavelet tree over packed bits)
  answers backward search. The contexts then stream through the index, all
  windows at once: a window matches as long as its interval isn't empty, and
  an interval that reaches the whole window holds every document that has it.
  Windows of the smallest document of a context are reported when the interval
  holds a smaller id yet; in every other document the whole context is.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import Words, chunks, free_names, run_hashes, span_hashes, texts, written

WINDOW, GRAM = 50, 10


# ---- anchors ---------------------------------------------------------------

def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


def anchors(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Positions (in the chunk's words) of symbols that are the smallest of some window of their text."""
    width = window - gram + 1
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    symbol = run_hashes(hashes, gram)
    low = _slide(symbol, width, np.minimum)  # of the window that starts here
    valid = np.zeros(len(low), bool)
    for a, b in zip(first[:-1], first[1:], strict=True):
        valid[a:max(a, b - window + 1)] = True
    low[~valid] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero((_slide(padded, width, np.maximum) == symbol) & (symbol > 0))


# ---- contexts --------------------------------------------------------------

CONTEXT = "h long, digest long, doc_id long, xh long, starts array<int>, length int"
PLACE = ("h", "digest", "start", "length", "hot")


def _context_rows(window: int, gram: int):
    """The different contexts of each text (doc_id, xh, text), with their places."""
    names, reach = [c.split()[0] for c in CONTEXT.split(", ")], window - gram

    def run(batches):
        for b in batches:
            ids, keys = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for c in chunks(b.column(2)):
                w = Words(c)
                at = anchors(w.hash, w.first, window, gram)
                h = run_hashes(w.hash, gram)[at].view(np.int64)
                row = np.searchsorted(w.first, at, "right") - 1
                a, z = np.maximum(w.first[row], at - reach), np.minimum(w.first[row + 1], at + window)
                digest = span_hashes(w.hash, a, z).view(np.int64)
                order = np.lexsort((a, digest, h, row))
                a, z, h, digest, row = a[order], z[order], h[order], digest[order], row[order]
                new = np.ones(len(a), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1]) | (digest[1:] != digest[:-1])
                one = np.flatnonzero(new)
                starts = pa.ListArray.from_arrays(pa.array(np.append(one, len(a)).astype(np.int32)),
                                                  pa.array((a - w.first[row]).astype(np.int32)))
                of = c.row + row[one]
                yield pa.RecordBatch.from_arrays([pa.array(h[one]), pa.array(digest[one]), pa.array(ids[of]), pa.array(keys[of]), starts,
                                                  pa.array((z - a)[one].astype(np.int32))], names)
    return run


def _context_words():
    """(h, digest, owner, hot, words) of the places of each text (doc_id, xh, text, places).

    A task sends a repeated row's words once.
    """
    def run(batches):
        sent: set[tuple[int, int]] = set()
        for b in batches:
            ids, keys = (b.column(i).to_pylist() for i in (0, 1))
            for c in chunks(b.column(2)):
                w, out = Words(c), []
                first, word = w.first.tolist(), w.hash.astype("<u8")
                for i in range(c.rows):
                    row = ids[c.row + i], keys[c.row + i]
                    if row in sent:
                        continue
                    if len(sent) > 200_000:
                        sent.clear()
                    sent.add(row)
                    for p in b.column(3)[c.row + i].as_py():
                        at = first[i] + p["start"]
                        out.append((p["h"], p["digest"], row[0], p["hot"], word[at:at + p["length"]].tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                                 ["h", "digest", "owner", "hot", "words"])
    return run


def _windows(window: int):
    """(h, digest, owner, start, piece): each window of a context on its own, by a digest of its words."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                words = part.column(3).to_pylist()
                each = np.array([len(w) // 8 - window + 1 for w in words])
                row = pa.array(np.repeat(np.arange(len(words)), each))
                start = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                piece = [xxhash.xxh3_64_intdigest(w[8 * s:8 * (s + window)]) - 2**63 for w, n in zip(words, each, strict=True) for s in range(n)]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(row) for c in range(3)), pa.array(start.astype(np.int32)),
                                                  pa.array(piece, pa.int64())], ["h", "digest", "owner", "start", "piece"])
    return run


# ---- the index -------------------------------------------------------------

class WaveletTree:
    """Rank queries on a sequence of small integers, kept as one packed bit vector for each binary digit."""

    def __init__(self, sequence: np.ndarray, digits: int):
        self.levels = []
        x = sequence
        for d in range(digits - 1, -1, -1):
            bit = (x >> d) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, 8 - len(packed) % 8)).view("<u8")
            ones = np.zeros(len(packed) + 1, np.int32)
            np.cumsum(np.bitwise_count(packed), out=ones[1:])
            self.levels.append((d, packed, ones, len(x) - int(bit.sum())))
            x = np.concatenate([x[~bit], x[bit]])

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where prefixes of length ``at`` end among the occurrences of ``symbol`` at the last level."""
        for d, packed, ones, zeros in self.levels:
            one = ones[at >> 6] + np.bitwise_count(packed[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbol >> d) & 1 == 1, zeros + one, at - one)
        return at


class FMIndex:
    """Backward search over a text of small integers (0: separator)."""

    def __init__(self, text: np.ndarray, depth: int):
        self.suffixes = _suffix_order(text, depth)
        transform = text[self.suffixes - 1]
        self.tree = WaveletTree(transform, max(1, int(text.max(initial=0)).bit_length()))
        counts = np.bincount(text)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # the walk of a whole prefix of length 0 gives where each symbol's occurrences begin at the last level
        self.base = self.tree.walk(np.arange(len(counts)), np.zeros(len(counts), np.int64))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``at`` of the transform."""
        return self.tree.walk(symbol, at) - self.base[symbol]

    def search(self, patterns: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(matched, low, high) of each row of symbols: how many of its last symbols occur ``least`` times, and their interval."""
        n, m = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, len(self.suffixes), np.int64)
        matched = np.zeros(n, np.int64)
        live = np.arange(n)
        for k in range(m - 1, -1, -1):
            live = live[patterns[live, k] < len(self.base)]
            c = patterns[live, k]
            a, z = self.before[c], self.before[c + 1]
            if k < m - 1:  # of the last symbol, all occurrences
                a, z = a + self.rank(c, low[live]), a + self.rank(c, high[live])
            go = z - a >= least
            live = live[go]
            low[live], high[live] = a[go], z[go]
            matched[live] += 1
        return matched, low, high


def _suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least (prefix doubling; ties by position)."""
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    k = 1
    while k < depth:
        second = np.concatenate([rank[k:] + 1, np.zeros(min(k, len(rank)), np.int64)])
        pair = rank * (int(second.max(initial=0)) + 1) + second
        order = np.argsort(pair, kind="stable")
        step = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = step
        k *= 2
    return order


def repeated(words: list[np.ndarray], owner: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) of each window that also occurs in a context of a smaller ``owner``.

    ``words``: the word hashes of each context; the contexts are indexed, then
    streamed through the index. As each occurs there itself, a window is
    followed only as long as it occurs twice.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = [run_hashes(w, gram) for w in words]
    size = np.array([len(s) for s in symbols])
    at = np.concatenate([[0], np.cumsum(size)])
    value, code = np.unique(np.concatenate(symbols), return_inverse=True)
    code = code + 1
    # gram interleaved sequences for each context, each closed by a separator
    context = np.repeat(np.arange(len(size)), size)
    offset = np.arange(at[-1]) - at[context]
    order = np.lexsort((offset, offset % gram, context))
    ends = np.flatnonzero(np.diff(context[order] * gram + offset[order] % gram, append=-1)) + 1
    text = np.insert(code[order], ends, 0)
    holder = np.insert(owner[context[order]], ends, np.iinfo(np.int64).max)
    steps = window // gram
    index = FMIndex(text, steps + 1)
    holder = holder[index.suffixes]
    spans = (steps - 1) * gram  # a window's last symbol starts so far behind its first
    query = np.flatnonzero(offset + spans < size[context])
    hit_context, hit_start = [], []
    for q in np.array_split(query, max(1, math.ceil(len(query) / 200_000))):
        matched, low, high = index.search(code[q[:, None] + gram * np.arange(steps)], least=2)
        whole = matched == steps
        q, low, high = q[whole], low[whole], high[whole]
        intervals = np.unique(np.stack([low, high], 1), axis=0)  # equal or apart, as all have one length
        least = np.minimum.reduceat(np.append(holder, np.iinfo(np.int64).max), intervals.ravel())[::2]
        least = least[np.searchsorted(intervals[:, 0], low)]
        hit = least < owner[context[q]]
        hit_context.append(context[q[hit]])
        hit_start.append(offset[q[hit]])
    return np.concatenate(hit_context), np.concatenate(hit_start)


def _shard_spans(window: int, gram: int):
    """Per context of a shard: the spans (in words) of its smallest document that a smaller document has too."""
    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        _, once = np.unique(np.stack([t.column(c).to_numpy() for c in ("h", "digest")], 1), axis=0, return_index=True)
        t = t.take(once)  # several tasks may have sent the words of a repeated row
        owner = t.column("owner").to_numpy()
        _, of, count = np.unique(t.column("h").to_numpy(), return_inverse=True, return_counts=True)
        some = np.flatnonzero(count[of] > 1)  # the only context of an anchor has no windows in others
        words = [np.frombuffer(t.column("words")[int(i)].as_py(), "<u8") for i in some]
        context, start = repeated(words, owner[some], window, gram)
        spans = [[] for _ in owner]
        for c, s in zip(some[context].tolist(), start.tolist(), strict=True):
            have = spans[c]
            if have and s <= have[-1]["z"]:
                have[-1]["z"] = s + window
            else:
                have.append({"a": s, "z": s + window})
        found = pa.RecordBatch.from_arrays(
            [*(t.column(c).combine_chunks() for c in ("h", "digest")),
             pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())])))],
            ["h", "digest", "spans"])
        yield found.filter(pa.array([bool(s) for s in spans], pa.bool_()))
    return run


# ---- the operator ----------------------------------------------------------

def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_rows: int = 8000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, xh, spans): for each text with something to remove, spans [a, z) of words relative to places.

    ``xh`` is a hash of the text, so repeated ids with different texts stay
    apart. ``shard_rows`` sizes the shards (contexts in one index) and decides
    which anchors are split further; results don't depend on it.
    """
    if window % gram or window < 2 * gram:
        raise ValueError("window must be a multiple of gram, two grams at least")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("xh"),
                       F.col(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    made = written(rows.mapInArrow(_context_rows(window, gram), CONTEXT), "fm-contexts")
    first = F.min(F.struct("doc_id", "xh", F.col("starts")[0].alias("start"), "length")).alias("first")
    distinct = written(made.groupBy("h", "digest").agg(first, F.max("doc_id").alias("hi"))
                       .select("h", "digest", "first.*", "hi"), "fm-distinct")
    spans = _spans(rows, distinct, window, gram, shard_rows)
    found = written(distinct.select("h", "digest", F.col("doc_id").alias("owner"), "hi").join(spans, ["h", "digest"], "left")
                    .where("hi > owner or spans is not null").drop("hi"), "fm-found")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("length").alias("z")))
    out = (made.join(found, ["h", "digest"])
           .withColumn("spans", F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(F.col("spans")))
           .where("spans is not null"))
    return written(out.groupBy("doc_id", "xh").agg(F.collect_list(F.struct("starts", "spans")).alias("spans")), "fm-spans")


def _spans(rows: DataFrame, distinct: DataFrame, window: int, gram: int, shard_rows: int) -> DataFrame:
    """(h, digest, spans) of each context of ``distinct`` with spans that a smaller owner has too.

    Anchors meet whole in one shard. An anchor with more contexts than several
    shards hold is split instead: its windows are told apart by digests of
    their own, which spread, and the smallest owner of each is looked up.
    """
    several = distinct.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("top"), F.count("*").alias("contexts"))
    several = several.where("lo < top").select("h", (F.col("contexts") > 4 * shard_rows).alias("hot"))
    indexed = written(distinct.drop("hi").join(several, "h"), "fm-indexed")
    size, split = indexed.agg(F.count("*"), F.max("hot")).first()
    places = indexed.groupBy("doc_id", "xh").agg(F.collect_list(F.struct(*PLACE)).alias("places"))
    words = rows.join(places, ["doc_id", "xh"]).select("doc_id", "xh", "text", "places").mapInArrow(
        _context_words(), "h long, digest long, owner long, hot boolean, words binary")
    if split:
        words = written(words, "fm-words")
    out = words.where("not hot").select("h", "digest", "owner", "words").repartition(max(1, math.ceil(size / shard_rows)), "h").mapInArrow(
        _shard_spans(window, gram), "h long, digest long, spans array<struct<a:int,z:int>>")
    if split:
        pieces = written(words.where("hot").select("h", "digest", "owner", "words").mapInArrow(
            _windows(window), "h long, digest long, owner long, start int, piece long"), "fm-pieces")
        lowest = pieces.groupBy("piece").agg(F.min("owner").alias("lowest"))
        out = out.union(pieces.join(lowest, "piece").where("lowest < owner").groupBy("h", "digest").agg(
            F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + window).alias("z"))).alias("spans")))
    return out


def covered(n: int, found: list | None) -> np.ndarray:
    """Mask of the words in any span of any of its context's places."""
    mark = np.zeros(n + 1, np.int64)
    for f in found or ():
        starts = np.array(f["starts"], np.int64)
        for s in f["spans"]:
            np.add.at(mark, starts + s["a"], 1)
            np.add.at(mark, starts + s["z"], -1)
    return np.cumsum(mark[:-1]) > 0


def _cut(batches):
    """Adds n_words, n_removed and the kept words (null where nothing goes) to (doc_id, text, spans)."""
    for b in batches:
        n_words, n_removed, kept, sha = [], [], [], []
        for text, spans in zip(texts(b.column(1)), b.column(2).to_pylist(), strict=True):
            words = (text or b"").split()
            gone = covered(len(words), spans)
            left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if spans else b" ".join(words)
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            kept.append(left.decode() if spans else None)
            sha.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha),
             pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row.

    ``kept_text`` holds the kept words joined by one space where something was
    removed, else null; ``kept_sha256`` is of the kept words in any case. A
    null or empty text has no words. Rows with a null id keep all words and
    aren't looked for in others. Rows that share an id aren't smaller than one
    another, so copies under one id all stay. Other columns of ``docs`` are not
    looked at; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, window, gram, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("xh"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.join(spans, ["doc_id", "xh"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                    text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated passages taken out of the texts, all columns and rows kept.

    A text that loses words becomes its kept words joined by one space (empty
    if none is left) and ``chars_col``, where it exists, its new length; all
    other texts stay as they are.
    """
    spans = repeated_spans(docs, window, gram, id_col=id_col, text_col=text_col)
    id_, xh, gone, left = free_names(docs, "_gone_id", "_gone_xh", "_gone", "_left")
    spans = spans.select(F.col("doc_id").alias(id_), F.col("xh").alias(xh), F.col("spans").alias(gone))
    text = F.col(text_col).cast("string")
    joined = docs.join(spans, (F.col(id_col).cast("long") == F.col(id_)) & (F.xxhash64(text) == F.col(xh)), "left")

    @F.arrow_udf("string")
    def kept(text: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, f in zip(texts(text), found.to_pylist(), strict=True):
            if not f:
                out.append(None)
                continue
            words = (t or b"").split()
            cut = covered(len(words), f)
            out.append(b" ".join(w for w, g in zip(words, cut.tolist(), strict=True) if not g).decode())
        return pa.array(out, pa.string())

    joined = joined.withColumn(left, kept(text, F.col(gone)))
    new = {text_col: F.coalesce(F.col(left), text)}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col(left).isNotNull(), F.length(left)).otherwise(F.col(chars_col)).cast(docs.schema[chars_col].dataType)
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def op7_fm_dedup(spark, sf_dir: str) -> DataFrame:
    """What repeated passages of 50 words leave of every document."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")
