import re

import pytest
import xxhash
from coursewise.llm import simhash_pivot as S
from pyspark.sql import functions as F

from .corpora import awkward, documents, none, words


def brute_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for (i, _), x in zip(rows, label):
        low.setdefault(x, []).append(i)
    low = {x: min((i for i in ids if i is not None), default=None) for x, ids in low.items()}
    return [(i, fp, low[x]) for (i, _), fp, x in zip(rows, fps, label)]


@pytest.mark.parametrize("seed", [5, 6])
def test_components_match_all_pairs(spark, seed):
    rows = awkward(seed)
    got = S.simhash_components(documents(spark, rows)).select("doc_id", "fp", "component_id").collect()
    want = [(i, fp if fp < 1 << 63 else fp - (1 << 64), c) for i, fp, c in brute_components(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_links_survive_splitting_of_large_keys(spark):
    import random
    rng = random.Random(1)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        fps |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(60)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    results = []
    for limit in (8, 4096):
        edges = S.links(df, max_group=limit).collect()
        label = {f: f for f in fps}
        for e in edges:
            a, b = (x % (1 << 64) for x in (e.a, e.b))
            assert (a ^ b).bit_count() <= 4 or label[a] is not None
            x, y = label[a], label[b]
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
        results.append(label)
    want = {f: f for f in fps}
    for i, f in enumerate(fps):
        for g in fps[:i]:
            if (f ^ g).bit_count() <= 4:
                x, y = want[f], want[g]
                want = {k: min(x, y) if v in (x, y) else v for k, v in want.items()}
    assert results[0] == results[1] == want


def test_one_of_each(spark):
    rows = awkward()
    comp = brute_components(rows)
    clash = documents(spark, rows).withColumn("_stay_id", F.lit(1)).withColumn("_STAY_xh", F.lit("x"))
    left = S.one_of_each(clash)
    assert left.columns == clash.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert len(got) == len(set(got))
    fps = [brute_fingerprint(t) for _, t in got]
    # one left of every component: no two of the rest link, and each component keeps its smallest id
    assert not any((a ^ b).bit_count() <= 4 for i, a in enumerate(fps) for b in fps[:i])
    assert {c for _, _, c in comp if c is not None} <= {i for i, _ in got} | {None}


def test_empty(spark):
    assert S.simhash_components(none(spark)).count() == 0
    assert S.one_of_each(none(spark)).count() == 0


