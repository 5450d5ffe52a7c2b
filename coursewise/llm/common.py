"""Helpers shared by the corpus operators: written tables, text buffers, components.

Words are maximal runs of bytes other than space and \\t..\\r throughout; that
is what ``bytes.split()`` gives on UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.session import scratch_path

#: Bytes of text that one vectorised step works on (a longer text is a step of its own).
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage: what follows re-reads the files when an executor is
    lost. The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until they are no columns of ``df`` (in any case) nor one another."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def texts(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


class Chunk:
    """Some consecutive texts of a batch as one byte array.

    ``data`` holds the bytes, ``offsets`` the start of each text (and the end
    of the last); nulls are empty texts.
    """

    def __init__(self, row: int, data: np.ndarray, offsets: np.ndarray):
        self.row, self.data, self.offsets = row, data, offsets
        self.rows = len(offsets) - 1


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column, in order, in chunks of about ``size`` bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield Chunk(at, raw[off[at]:off[to]], off[at:to + 1] - off[at])
        at = to


#: States that meet in one task of a fold.
FAN = 16


def folded(rows: DataFrame, start, join, fan: int = FAN) -> np.ndarray | None:
    """One array from all rows: ``start(batches)`` of each task, joined in pairs by ``join``.

    States meet in rounds of groups of ``fan`` tasks, in the tasks' order, so
    no task and not the driver holds more than ``fan`` of them. A task without
    rows takes no part, nor does one whose state is None; None if none does.
    """
    def state(part: int, x: np.ndarray) -> pa.RecordBatch:
        shape = pa.array([list(x.shape)], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([x.dtype.str]), shape,
                                           pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], ["part", "kind", "shape", "state"])

    def array(t, i: int) -> np.ndarray:
        return np.frombuffer(t.column("state")[i].as_py(), t.column("kind")[i].as_py()).reshape(t.column("shape")[i].as_py())

    def first(batches):
        filled = (b for b in batches if b.num_rows)
        head = next(filled, None)
        if head is not None:
            x = start(chain([head], filled))
            if x is not None:
                yield state(TaskContext.get().partitionId(), x)

    def meet(key, t):
        order = np.argsort(t.column("part").to_numpy())
        x = array(t, int(order[0]))
        for i in order[1:]:
            x = join(x, array(t, int(i)))
        return pa.Table.from_batches([state(key[0].as_py(), x)])

    schema = "part long, kind string, shape array<long>, state binary"
    states, parts = rows.mapInArrow(first, schema), max(2, rows.rdd.getNumPartitions())
    while parts > 1:
        states = states.groupBy(F.floor(F.col("part") / fan).alias("group")).applyInArrow(meet, schema)
        parts = -(-parts // fan)
    t = states.toArrow()
    return array(t, 0) if t.num_rows else None


_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class Powers:
    """r**i and r**-i modulo 2**64 for i < n, kept for the largest n so far; travels to workers empty."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __reduce__(self):
        return Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up, down = np.full(size, _R), np.full(size, _R_INV)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


powers = Powers()


class Words:
    """Words of a chunk: byte bounds, 64-bit hashes, and each text's first word.

    ``first[i] .. first[i + 1]`` are the words of the chunk's text ``i``.
    """

    def __init__(self, chunk: Chunk, lower: bool = False):
        b = chunk.data
        if lower:
            b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
        solid = ~_SPACE[b]
        n = len(b)
        edge = np.zeros(n + 1, bool)
        edge[chunk.offsets] = True
        starts = solid.copy()
        starts[1:] &= ~solid[:-1] | edge[1:n]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, chunk.offsets)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        poly = (total[self.end] - total[self.start]) * down[self.start]
        self.hash = mixed(poly ^ ((self.end - self.start).astype(np.uint64) << np.uint64(56)))


def run_hashes(word_hash: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive word hashes (one text's words)."""
    n = len(word_hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(word_hash) + 1)
    total = np.zeros(len(word_hash) + 1, np.uint64)
    np.cumsum(word_hash * up[:len(word_hash)], out=total[1:])
    return mixed((total[length:] - total[:n]) * down[:n])


def span_hashes(word_hash: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Hash of the consecutive word hashes a .. z (without z) of each span."""
    up, down = powers(len(word_hash) + 1)
    total = np.zeros(len(word_hash) + 1, np.uint64)
    np.cumsum(word_hash * up[:len(word_hash)], out=total[1:])
    return mixed(((total[z] - total[a]) * down[a]) ^ ((z - a).astype(np.uint64) << np.uint64(56)))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as rows (v, label).

    Alternating large-star and small-star rounds: every round is two joins on
    per-vertex minima, so no component is ever gathered in one place, and a
    table written per round cuts the lineage. ``label`` is the smallest vertex
    of the component. Vertices without an edge do not appear.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), f"{name}-edges")
    while True:
        # large star: every larger neighbour of u points to u's smallest neighbour
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: u and its smaller neighbours point to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(near.union(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}-edges")
        # done when each vertex has one parent and no parent has a parent
        parents = edges.select(F.col("b").alias("a")).distinct()
        open_ = edges.join(parents, "a", "left_semi").limit(1).count() or (
            edges.groupBy("a").count().where("count > 1").limit(1).count())
        if not open_:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).union(
                parents.select(F.col("a").alias("v"), F.col("a").alias("label")))
