import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from coursewise.llm import fm_dedup as D
from coursewise.llm.common import Words, chunks
from pyspark.sql import functions as F

from .corpora import awkward, documents, none, prose, words


def brute(rows, window):
    smallest = {}
    for i, t in rows:
        if i is not None:
            w = words(t)
            for s in range(len(w) - window + 1):
                k = tuple(w[s:s + window])
                smallest[k] = min(i, smallest.get(k, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and smallest[tuple(w[s:s + window])] < i:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if any(gone) else None))
    return out


@pytest.mark.parametrize(("window", "gram", "seed"), [(50, 10, 5), (20, 5, 6)])
def test_matches_window_by_window(spark, window, gram, seed):
    rows = awkward(seed)
    got = D.remove_repeats(documents(spark, rows), window, gram).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, window), key=repr)


def test_split_anchors_give_the_same(spark, monkeypatch):
    rows = awkward(8, 60)
    docs = documents(spark, rows)
    a = D.repeated_spans(docs, 20, 5, shard_rows=1)
    b = D.repeated_spans(docs, 20, 5)
    cover = lambda df: {(r.doc_id, r.xh): D.covered(5000, [x.asDict(True) for x in r.spans]).tolist() for r in df.collect()}
    assert cover(a) == cover(b) and cover(a)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 6, 400)
    index = D.FMIndex(np.append(text, 0), 5)
    for m in (1, 2, 4):
        patterns = rng.integers(1, 7, (200, m))
        matched, low, high = index.search(patterns)
        for p, k, a, z in zip(patterns, matched, low, high):
            places = [i for i in range(401 - m) if (text[i:i + m] == p).all()]
            if places:
                assert k == m and sorted(index.suffixes[a:z][index.suffixes[a:z] + m <= 400]) == places
            else:
                assert k < m


def test_words_with_half_a_hash_in_common_stay_apart(spark):
    pair = ("k31378", "k3c564")
    h = [int(Words(next(chunks(pa.array([w])))).hash[0]) for w in pair]
    assert h[0] != h[1] and h[0] >> 32 == h[1] >> 32
    rest = prose(random.Random(4), 49)
    for place in ("{} " + rest, rest + " {}"):
        rows = [(i, place.format(w)) for i, w in enumerate((*pair, "zzz"), 1)]
        got = D.remove_repeats(documents(spark, rows)).collect()
        assert sorted(map(tuple, got)) == sorted(brute(rows, 50)) and not any(r.n_removed for r in got)


def test_documents_keep_columns_and_rows(spark):
    rows = awkward()
    docs = documents(spark, rows)
    for name in ("_gone_id", "_gone_xh", "_GONE", "_left"):
        docs = docs.withColumn(name, F.lit(name))
    out = D.without_repeats(docs)
    assert out.schema.names == docs.schema.names
    want = sorted(((i, kept if gone else t) for (i, t), (_, _, gone, _, kept) in zip(rows, brute(rows, 50))), key=repr)
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == want
    assert all(r.n_chars == len(r.text or "") for r in got)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    assert sorted(map(tuple, out.select(others).collect()), key=repr) == sorted(map(tuple, docs.select(others).collect()), key=repr)


def test_empty(spark):
    assert D.remove_repeats(none(spark)).count() == 0
    assert D.without_repeats(none(spark)).count() == 0


def test_a_row_repeated_over_tasks_and_a_hot_anchor(spark):
    passage = [f"p{i}" for i in range(24)]
    rows = [(i, " ".join([f"a{i}-{k}" for k in range(25)] + passage + [f"z{i}-{k}" for k in range(25)])) for i in range(40)]
    rows += [rows[7]] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = sorted((i, brute_removed(rows, i, t, 20)) for i, t in rows)
    for shard_rows in (8000, 2):
        spans = D.repeated_spans(docs, 20, 5, shard_rows=shard_rows)
        got = {(r.doc_id, r.xh): r.spans for r in spans.collect()}
        keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("xh")).collect()
        found = sorted((r.doc_id, int(D.covered(len(r.text.split()), got.get((r.doc_id, r.xh))).sum())) for r in keyed)
        assert found == want


def brute_removed(rows, doc_id, text, window):
    w, smaller = words(text), set()
    for i, t in rows:
        if i < doc_id:
            o = words(t)
            smaller |= {tuple(o[s:s + window]) for s in range(len(o) - window + 1)}
    gone = {k for s in range(len(w) - window + 1) if tuple(w[s:s + window]) in smaller for k in range(s, s + window)}
    return len(gone)
