"""Sharding along a Hilbert curve over quantised metadata.

Rows get a cell in a grid of metadata dimensions, are ordered by the cell's
index on the Hilbert curve, and the order is cut into runs. Neighbours on the
curve are neighbours in every dimension, so a run spans a narrow range of each
and the statistics of its files prune reads on any of them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursewise.llm.common import free_names, written

#: Bytes a row counts besides its text.
ROW_BYTES = 16


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of the cells ``axes`` (rows, dimensions), each coordinate below ``2 ** bits``.

    From the highest bit down: where an axis has the bit set, the lower bits of
    the first axis are inverted, elsewhere they are exchanged with that axis's.
    The Gray code of what results, read across the axes, is the index.
    """
    x = axes.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            is_set = (x[i] >> b) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def size_cell(size: np.ndarray, bits: int) -> np.ndarray:
    """Logarithmic cell of a size: four cells an octave, the last holds all larger sizes."""
    octave = np.frexp(np.maximum(size, 1).astype(np.float64))[1].astype(np.int64) - 1
    quarter = np.where(octave >= 2, size >> np.maximum(octave - 2, 0), size << np.maximum(2 - octave, 0)) & 3
    return np.minimum(4 * octave + quarter, (1 << bits) - 1)


def label_cell(labels: pa.Array, bits: int) -> np.ndarray:
    """Cell of a label by its hash; null has cell 0."""
    coded = labels.dictionary_encode()
    codes = np.array([0 if v is None else zlib.crc32(v.encode()) >> (32 - bits) for v in coded.dictionary.to_pylist()] + [0])
    return codes[coded.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)]


def ranked(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with ``rank``, the row's place (from 0) in the order of columns ``order``, and the row count.

    Range partitions are sorted on their own and written; the counts of the
    partitions, one row each, give where every partition begins. No task sees
    more than a partition.
    """
    here = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = here.groupBy(part).count()
    before = sizes.select("_part", F.coalesce(F.sum("count").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    total = here.count()
    out = here.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row for each partition
    return out.withColumn("rank", F.col("_before") + place).drop("_part", "_at", "_before"), total


def hilbert_shards(docs: DataFrame, shards: int = 40, bits: int = 7, id_col: str = "doc_id",
                   text_col: str = "text", label_cols: tuple[str, ...] = ("lang", "source"), row_col: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, hilbert, shard, slot) of every row, and as ``row`` its ``row_col`` (a long) where one is named.

    Dimensions: size of the text, the place of the id in the range of all ids,
    and the hash of each label column. Rows are ordered by Hilbert index, equal
    texts of a cell together, then by id; shards take runs of that order whose
    counts differ by one at most. ``size`` is the text's UTF-8 bytes (null:
    none) plus 16. A null text has CRC null, a null id or label cell 0;
    repeated rows take neighbouring slots in any order. An empty table gives an
    empty result, and with fewer rows than shards the last shards are empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + ROW_BYTES)
                       .cast("long").alias("size"),
                       F.crc32(F.col(text_col).cast("string")).alias("text_crc32"),
                       (F.col(row_col).cast("long") if row_col else F.lit(0).cast("long")).alias("row"),
                       *[F.col(c).cast("string").alias(f"_l{i}") for i, c in enumerate(label_cols)])
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, span = low or 0, max(1, (high or 0) - (low or 0) + 1)
    side = 1 << bits

    def run(batches):
        for b in batches:
            ids = b.column(0).fill_null(low).to_numpy(zero_copy_only=False).astype(np.int64)
            place = ((ids - low).astype(np.float64) * (side / span)).astype(np.int64)
            axes = [size_cell(b.column(1).to_numpy(zero_copy_only=False), bits), np.minimum(place, side - 1),
                    *(label_cell(b.column(4 + i), bits) for i in range(len(label_cols)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(hilbert_index(np.stack(axes, 1), bits))],
                                             ["doc_id", "size", "text_crc32", "row", "hilbert"])

    cells = rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, row long, hilbert long")
    out, total = ranked(cells, ["hilbert", "text_crc32", "doc_id"], "hilbert")
    each, more = divmod(total, shards)
    edge = more * (each + 1)  # the first ``more`` shards have a row more
    r = F.col("rank")
    shard = F.when(r < edge, F.floor(r / (each + 1))).otherwise(more + F.floor((r - edge) / max(1, each)))
    start = F.when(r < edge, F.col("shard") * (each + 1)).otherwise(edge + (F.col("shard") - more) * each)
    return (out.withColumn("shard", shard.cast("int")).withColumn("slot", (r - start).cast("long"))
            .select("doc_id", "size", "text_crc32", "hilbert", "shard", "slot", *(["row"] if row_col else [])))


def write_shards(docs: DataFrame, path: str, **options) -> list[str]:
    """Writes every row of ``docs`` into one folder for each shard, in curve order.

    Rows are numbered in a written copy and joined with their places by that
    number, so null and repeated ids keep each their row. Readers that filter
    on the shard or on any of the ordered columns skip the files and row groups
    whose statistics rule the filter out. Returns the names of the columns that
    hold shard, slot and index (``shard``, ``slot``, ``hilbert`` unless ``docs``
    has columns of these names). ``options`` are those of ``hilbert_shards``.
    """
    row, at, *names = free_names(docs, "_row", "_at", "shard", "slot", "hilbert")
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    placed = hilbert_shards(kept, row_col=row, **options).select(
        F.col("row").alias(at), *[F.col(c).alias(n) for c, n in zip(("shard", "slot", "hilbert"), names, strict=True)])
    (kept.join(placed, F.col(row) == F.col(at)).drop(row, at).repartitionByRange(*names[:2]).sortWithinPartitions(*names[:2])
     .write.partitionBy(names[0]).parquet(path))
    return names


def op9_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law ``rows``."""
    out = hilbert_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")
