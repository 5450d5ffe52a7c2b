import random
from collections import Counter

import corpus_pipeline
import numpy as np
from coursewise.llm import latent_leaks as L
from coursewise.llm.catalog import ORACLES, QUERIES
from pyspark.sql import functions as F

from .corpora import awkward, documents, none, prose, words
from .test_divergence import english
from .test_simhash import brute_fingerprint


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def by_hand(rows, items):
    """(doc_id, item) pairs over the whole texts: share of the item in its longest common subsequence with some part."""
    found = set()
    for i, text in rows:
        w = L.normal_words(text)
        for k, t in items:
            v = L.normal_words(t)
            best = 0
            for a in range(0, len(w), 4):
                part = w[a:a + 2 * len(v) + 8]
                row = [0] * (len(v) + 1)
                for x in part:
                    before = 0
                    for j, y in enumerate(v):
                        before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
                best = max(best, row[-1])
            if v and best >= L.MIN_LCS * len(v):
                found.add((i, k))
    return found


def planted(seed=9):
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.randint(15, 55))) for k in range(12)] + [(50, None), (51, "")]
    rows = [(i, prose(rng, rng.randint(5, 250))) for i in range(60)]
    for k in range(12):
        words = items[k][1].split()
        if k % 3 == 1:  # a paraphrase: some words changed
            for p in rng.sample(range(len(words)), len(words) // 8):
                words[p] = prose(rng, 1)
        if k % 3 == 2:
            words = [w.upper() + "," for w in words]
        rows.append((100 + k, f"{prose(rng, rng.randint(0, 120))} {' '.join(words)} {prose(rng, rng.randint(0, 120))}"))
    return rows + [(None, rows[-1][1]), (500, None), (501, ""), (100, rows[60][1])], items


def test_planted_items_are_found(spark):
    rows, items = planted()
    got = {(r.doc_id, r.item_id) for r in L.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    want = by_hand(rows, items)
    assert want <= got and {(100 + k, k) for k in range(12)} <= got
    assert {i for i, _ in got} <= {100 + k for k in range(12)} | {None}


def test_blocks_of_items_give_the_same(spark):
    rows, items = planted(10)
    docs, bench = documents(spark, rows), benchmark(spark, items)
    key = lambda df: sorted(((r.doc_id, r.item_id, r.lcs) for r in df.collect()), key=repr)
    assert key(L.leaks(docs, bench, block=4)) == key(L.leaks(docs, bench))


def zipf(rng, n, vocabulary=4000):
    """Words of which few are common and most are rare."""
    return [f"w{int(vocabulary ** rng.random())}" for _ in range(n)]


def test_copies_of_short_items_beside_long_ones(spark):
    rng = random.Random(21)
    items = [(k, " ".join(zipf(rng, 400 if k < 40 else rng.randint(15, 40), 10**6))) for k in range(200)]
    rows = [(1000 + i, " ".join(zipf(rng, 150))) for i in range(150)]
    rows += [(k, " ".join(zipf(rng, 40) + t.split() + zipf(rng, 40))) for k, t in items]
    got = {(r.doc_id, r.item_id) for r in L.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got >= {(k, k) for k in range(200)}


def test_paraphrases_without_the_rarest_words(spark):
    rng = random.Random(22)
    items = [(k, " ".join(zipf(rng, 40))) for k in range(60)]
    rows = [(1000 + i, " ".join(zipf(rng, 150))) for i in range(200)]
    often = Counter(w for _, t in rows for w in t.split())
    for k, t in items:
        w = t.split()
        for p in sorted(range(40), key=lambda p: often[w[p]])[:8]:
            w[p] = f"other{rng.random()}"
        rows.append((k, " ".join(zipf(rng, 40) + w + zipf(rng, 40))))
    got = {(r.doc_id, r.item_id) for r in L.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got >= {(k, k) for k in range(60)}


def test_every_item_keeps_its_norm(spark):
    rng = random.Random(23)
    items = L.Items([(k, " ".join(zipf(rng, 700 if k < 5 else 12))) for k in range(80)] + [(90, "one"), (91, None)])
    assert sum(len(x.places) for x in items.parts(60)) == len(items.places) and all(len(x.places) <= 60 for x in items.parts(60))
    docs = documents(spark, [(i, " ".join(zipf(rng, 200))) for i in range(100)])
    for part in items.parts(60):
        weights, vectors = L.latent_space(docs, part, "text")
        row, word, x, size = weights.items(part)
        kept = (L._project(row, word, x, len(size), vectors) ** 2).sum(axis=1) ** 0.5
        assert (kept > L.MIN_KEPT - 0.01).all()


def test_rows_are_multiplied_in_small_dense_blocks():
    rng = np.random.default_rng(4)
    for n in (1, L.ROWS, 2 * L.ROWS + 7):
        full = rng.random((n, 300), np.float32) * (rng.random((n, 300)) < 0.05)
        full[n // 2] = 0  # a row without words
        row, word = np.nonzero(full)
        weight = full[row, word]
        for at, words, matrix in L._blocks(row, word, weight, n):
            assert matrix.shape == (min(L.ROWS, n - at), len(words)) and (full[at:at + L.ROWS, words] == matrix).all()
        to, y = rng.random((300, 9), np.float32), np.ones((300, 9))
        z = L._project(row, word, weight, n, to)
        L._add(y, row, word, weight, z)
        assert np.allclose(z, full @ to, rtol=1e-4) and np.allclose(y, 1 + full.T @ z, rtol=1e-4)


def test_empty_sides(spark):
    rows, items = planted()
    assert L.leaks(none(spark), benchmark(spark, items)).count() == 0
    assert L.leaks(documents(spark, rows), benchmark(spark, items).limit(0)).count() == 0
    docs = documents(spark, rows).withColumn("_leak_xh", F.lit(1))
    kept = L.without_leaks(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([i for i, _ in rows if i is not None and (i < 100 or i >= 500)], key=repr)


def test_subsequence_matches_the_table():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(1, 12))] for _ in range(2))
        items = L.Items([(1, b" ".join(a).decode())])
        masks, n = items.matcher(0)
        row = [0] * (n + 1)
        for w in b:
            before = 0
            for j, y in enumerate(a):
                before, row[j + 1] = row[j + 1], before + 1 if w == y else max(row[j], row[j + 1])
        assert n - L.common_subsequence(masks, n, b).bit_count() == row[-1]


def test_stages_one_by_one(spark, tmp_path):
    rng = random.Random(4)
    shared, item = english(rng, 70), english(rng, 40)
    rows = [(i, english(rng, rng.randint(80, 160))) for i in range(30)]
    rows += [(40, rows[3][1]), (41, rows[4][1] + " more"), (42, "bad " * 200), (43, f"{english(rng, 60)} {shared}"),
             (44, f"{english(rng, 80)} {shared} {english(rng, 20)}"), (45, f"{english(rng, 90)} {item} {english(rng, 30)}"),
             (46, " ".join(f"{w}%%%***" for w in english(rng, 90).split())), (47, None)]
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    benchmark(spark, [(1, item)]).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "best-fit packing"]
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        seen.append(docs.collect())
        if k < 4:
            assert docs.columns == documents(spark, []).columns
    ids = [{r.doc_id for r in s} for s in seen]
    assert ids[0] == set(range(30)) | {40, 41, 43, 44, 45}
    close = lambda a, b: (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() <= 4
    text = dict(rows)
    assert ids[1] == {i for i in ids[0] if not any(j < i and close(text[i], text[j]) for j in ids[0])} and 40 not in ids[1]
    assert ids[2] == ids[1]
    after = {r.doc_id: r for r in seen[2]}
    assert shared.split()[20] not in after[44].text.split() or len(after[44].text.split()) == 100
    assert after[43].text == text[43] and after[44].n_chars == len(after[44].text)
    assert ids[3] == ids[2] - {45}
    assert ids[4] == ids[3]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(out) == key(seen[4])


def test_stages_take_empty_tables(spark, tmp_path):
    benchmark(spark, [(1, "some words of an item that no document holds")]).write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none(spark), str(tmp_path)).count() == 0


def test_stages_take_awkward_rows(spark, tmp_path):
    """Each stage on nulls, empty texts, repeated rows and ids, and columns named like its own."""
    rows = awkward()
    benchmark(spark, [(1, "some words of an item that no document holds"), (2, None)]).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, rows)
    for name in ("_quality", "_stay_id", "_gone", "_left", "_leak_xh"):
        docs = docs.withColumn(name, F.lit(name))
    whole = {(r.doc_id, r.text): r for r in docs.collect()}
    quality, near, repeats, leaks, packing = (stage(spark, docs, str(tmp_path)) for _, stage in corpus_pipeline.STAGES)
    assert all(x.columns == docs.columns for x in (quality, near, repeats, leaks))
    for part in (quality, near, leaks):  # rows as they were
        assert all(whole[r.doc_id, r.text] == r for r in part.collect())
    assert all(len(words(r.text)) >= 50 for r in quality.collect())
    left = near.collect()
    assert len({(r.doc_id, r.text) for r in left}) == len(left) < len(rows)
    assert leaks.count() == len(rows) == repeats.count()
    gone = {r.doc_id for r in repeats.collect() if r.text != dict(rows).get(r.doc_id)}
    assert gone and all(r["_left"] == "_left" and r["_kept"] == 1 for r in repeats.collect())
    length = {}
    for r in packing.collect():
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert set(length) == {i for i, _ in rows} and length[100] == length[101] == 1


def test_every_operator_has_a_query():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
