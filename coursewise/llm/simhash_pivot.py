"""SimHash near-duplicates found through pivot distance tables.

A text's fingerprint has bit i set when more than half of its shingle hashes
have it set. Texts link when their fingerprints differ in at most ``max_bits``
bits; a component is what links reach.

Search, over *distinct* fingerprints only (copies share one):

* The reference fingerprints of a block of bits are zero outside it and a
  growing run of ones inside. Two neighbouring ones differ in a single bit, so
  the differences between neighbouring distances of a fingerprint *are* its
  bits there (distance up: bit clear, distance down: bit set). Two
  fingerprints whose distance profiles agree over a block agree in its bits.
* The 64 bits make ``max_bits + 2`` blocks. A pair within ``max_bits`` differs
  in at most ``max_bits`` blocks, so its profiles agree over two of them at
  least: the pair meets under the key of that pair of blocks. Nothing is lost.
* Under a key, a pair is discarded when the largest difference between the
  two rows of distances to the reference fingerprints ``PIVOTS`` is over
  ``max_bits`` (triangle inequality), and survivors are verified by their
  exact distance. Pairs already connected are skipped, and only a spanning
  forest leaves the task, so a dense group never becomes all its pairs.
* A key with more than ``max_group`` fingerprints is split: the bits outside
  its two blocks make new blocks, and the same argument holds among them.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import components, free_names, texts, written

#: Reference fingerprints of the pair filter: fixed pseudo-random 64-bit values.
PIVOTS = np.array([xxhash.xxh64_intdigest(bytes([i]), 7) for i in range(16)], np.uint64)


def fingerprint(data: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text (ASCII letters lower-cased); 0 for a text without words."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = list(accumulate(map(len, words), lambda a, n: a + n + 1))  # ends of the words
    starts = [0, *(e + 1 for e in stops[:-1])]
    n = max(1, len(words) - shingle + 1)
    ends = stops[shingle - 1:] or stops[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n], ends, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, xh, fp): a hash and the fingerprint of every text as signed longs."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in texts(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp)], ["doc_id", "xh", "fp"])

    text = F.col(text_col).cast("string")
    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("xh"), text.alias("text"))
    return one.mapInArrow(run, "doc_id long, xh long, fp long")


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    """``bits`` in ``n`` runs of nearly equal length."""
    return [b.tolist() for b in np.array_split(np.array(bits), n)]


def _profile(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """What a block's row of distances says, packed: bit t set where the distance falls from reference t to t + 1."""
    out = np.zeros(len(fp), np.uint64)
    for t, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(t)
    return out


def _keys(max_bits: int, path: tuple[int, ...]) -> list[tuple[list[int], int]]:
    """The (bits, index) of the keys that refine ``path``, the indexes chosen so far."""
    bits = list(range(64))
    for k in path:
        kept = _pairs(bits, max_bits)[k]
        bits = [b for b in bits if b not in kept]
    return [(kept, k) for k, kept in enumerate(_pairs(bits, max_bits))]


def _pairs(bits: list[int], max_bits: int) -> list[list[int]]:
    blocks = _blocks(bits, max_bits + 2)
    return [blocks[i] + blocks[j] for i, j in combinations(range(len(blocks)), 2)]


def _connect(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among fingerprints of equal key.

    Rows must be sorted by key. Step k compares row i with row i + k of the
    same key, all keys at once.
    """
    n = len(fp)
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    label = np.arange(n)
    live = np.arange(n - 1)
    k = 1
    while len(live):
        live = live[live + k < n]
        live = live[key[live] == key[live + k]]
        i = live[label[live] != label[live + k]]
        if len(i):
            near = np.abs(table[i] - table[i + k]).max(axis=1) <= max_bits
            i = i[near]
            i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= max_bits]
            while len(i):  # each round joins at least one pair of labels
                a, b = label[i], label[i + k]
                hi, lo = np.maximum(a, b), np.minimum(a, b)
                parent = np.arange(n)
                np.minimum.at(parent, hi, lo)
                while True:
                    up = parent[parent]
                    if np.array_equal(up, parent):
                        break
                    parent = up
                label = parent[label]
                i = i[label[i] != label[i + k]]
        k += 1
    child = np.flatnonzero(label != np.arange(n))
    return fp[child], fp[label[child]]


def links(fps: DataFrame, max_bits: int = 4, max_group: int = 4096, levels: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect every pair within ``max_bits``.

    ``fps`` has one long column ``fp`` without repeats. ``max_group`` only
    decides where a key is split further; at the last level groups of any size
    are worked on, so the result doesn't depend on it.
    """
    def deal(path: tuple[int, ...]):
        keys = _keys(max_bits, path)

        def run(batches):
            for b in batches:
                fp = b.column(0).to_numpy(zero_copy_only=False)
                old = b.column(1).to_numpy(zero_copy_only=False)
                for bits, k in keys:
                    key = _profile(fp.view(np.uint64), bits).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(fp), pa.array(old), pa.array(np.full(len(fp), k, np.int32)), pa.array(key)],
                        ["fp", "old", "k", "key"])
        return run

    def connect(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        fp = t.column("fp").to_numpy().view(np.uint64)
        group = t.column("group").to_numpy()
        order = np.lexsort((fp, group))
        a, b = _connect(group[order], fp[order], max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spark = fps.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    work = {(): fps.select("fp", F.lit(0).cast("long").alias("old"))}
    for level in range(levels):
        deeper: dict[tuple[int, ...], DataFrame] = {}
        for path, rows in work.items():
            # the old group's number, which pair of blocks, their bits; groups that a hash joins only add pairs to test
            dealt = rows.mapInArrow(deal(path), "fp long, old long, k int, key long").select(
                "fp", "k", F.xxhash64("old", "k", "key").alias("group"))
            dealt = written(dealt, f"simhash-keys-{level}")
            count = dealt.groupBy("group").agg(F.count("*").alias("n"))
            ready = dealt.join(count.where("n > 1" if level == levels - 1 else f"n > 1 and n <= {max_group}"), "group")
            edges = edges.union(ready.select("fp", "group").repartition("group").mapInArrow(connect, "a long, b long"))
            if level < levels - 1:
                hot = count.where(f"n > {max_group}").select("group")
                if hot.limit(1).count():
                    split = written(dealt.join(hot, "group"), f"simhash-hot-{level}")
                    for k in range(len(_keys(max_bits, path))):
                        deeper[(*path, k)] = split.where(F.col("k") == k).select("fp", F.col("group").alias("old"))
        work = deeper
        if not work:
            break
    return edges


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, xh, fp, component, component_id) of every row.

    ``component`` names the component, ``component_id`` is the smallest doc_id
    reachable through links, the row's own included; ``xh`` is a hash of the text. A null or empty text has fingerprint zero and links like any
    other; repeated rows get equal rows; a null id counts in no minimum (a
    component of null ids only has component_id null). Other columns of
    ``docs`` are not looked at. An empty table gives an empty result.
    """
    fps = written(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-fp")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    found = components(links(distinct.select("fp"), max_bits), "simhash")
    of = distinct.join(found, distinct.fp == found.v, "left").select(
        "fp", "rep", F.coalesce("label", "fp").alias("label"))
    low = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = of.join(low, "label").select("fp", F.col("label").alias("component"), "component_id")
    return fps.join(of, "fp").select("doc_id", "xh", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each component: that with the smallest id stays.

    Rows with a null id stay only where no other row of theirs has an id; of
    rows with equal ids that with the smallest text hash, of equal rows one.
    """
    of = written(simhash_components(docs, shingle, max_bits, id_col=id_col, text_col=text_col), "simhash-components")
    id_, xh = free_names(docs, "_stay_id", "_stay_xh")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "xh")).alias("s")
    stay = of.groupBy("component").agg(first).select(F.col("s.doc_id").alias(id_), F.col("s.xh").alias(xh))
    key = [F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))]
    kept = docs.join(stay, key[0].eqNullSafe(F.col(id_)) & (key[1] == F.col(xh)), "left_semi")
    again = of.groupBy("doc_id", "xh").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates([id_col, text_col]) if again else kept


def op6_simhash_pivot(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
