import itertools
import zlib

import numpy as np
import pyarrow.parquet as pq
from coursewise.llm import hilbert_shards as H
from pyspark.sql import functions as F

from .corpora import awkward, documents, none


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        index = H.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rows = awkward()
    got = H.hilbert_shards(documents(spark, rows), shards=7).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for i, t in rows), key=repr)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in in_order] == sorted(r.hilbert for r in got)


def test_few_rows_and_none(spark):
    few = H.hilbert_shards(documents(spark, awkward()[:3]), shards=5).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert H.hilbert_shards(none(spark)).count() == 0


def test_files_prune(spark, tmp_path):
    """The statistics of the files rule many of them out for a value of any dimension."""
    docs = documents(spark, [(i, "x" * 2 ** (i * 5 % 13)) for i in range(2000)])
    H.write_shards(docs, str(tmp_path / "s"), shards=64)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 2000 and back.select("shard").distinct().count() == 64
    bounds = {"doc_id": [], "n_chars": []}
    for f in sorted((tmp_path / "s").rglob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                if col.path_in_schema in bounds:
                    bounds[col.path_in_schema].append((col.statistics.min, col.statistics.max))
    for name, values in (("doc_id", range(0, 2000, 100)), ("n_chars", [2 ** k for k in range(13)])):
        hit = [sum(a <= v <= z for a, z in bounds[name]) / len(bounds[name]) for v in values]
        assert sum(hit) / len(hit) < 0.6, (name, hit)


def test_written_rows_are_the_rows(spark, tmp_path):
    rows = awkward() + [(None, "again"), (None, "again"), (3, "other")]
    docs = documents(spark, rows).withColumn("shard", F.lit("mine")).withColumn("Slot", F.col("doc_id") * 2)
    names = H.write_shards(docs, str(tmp_path / "s"), shards=5)
    assert not {n.lower() for n in names} & {c.lower() for c in docs.columns}
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select(docs.columns).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
