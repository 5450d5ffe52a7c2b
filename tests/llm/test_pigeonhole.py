"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from coursewise.llm import pigeonhole_join as J

from .corpora import awkward, documents, none, prose, words


def shingles(text):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(seed, n, sizes, copies, edits):
    """Texts with copies that differ in words here and there, so that similarities lie around the bound."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        base = prose(rng, rng.choice(sizes)).split()
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // edits))):
                i = rng.randrange(len(w))
                how = rng.random()
                if how < 0.4:
                    w[i] = prose(rng, 1)
                elif how < 0.7 and len(w) > 1:
                    del w[i]
                else:
                    w.insert(i, prose(rng, 1))
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,n,sizes,copies,edits", [
    (1, 40, (4, 5, 6, 8, 9, 10, 12, 14, 17), 6, 9), (2, 25, (25, 40, 60, 90, 130), 8, 25), (3, 6, (300, 700), 12, 40)])
def test_all_links_are_found(spark, seed, n, sizes, copies, edits):
    rows = near_copies(seed, n, sizes, copies, edits)
    assert result(J.jaccard_components(documents(spark, rows).repartition(3))) == expected(rows)


def test_enumeration_alone_and_hot_signatures(spark, monkeypatch):
    rows = near_copies(4, 12, (9, 20, 50, 100), 10, 20)
    rows += [(2000 + i, rows[3][1]) for i in range(30)]
    monkeypatch.setattr(J, "ENTRIES", 32)  # many parts; subsets seen more than 16 times are hot
    monkeypatch.setattr(J, "BLOCK", 4)
    assert result(J.jaccard_components(documents(spark, rows), stars=0)) == expected(rows)
    assert result(J.jaccard_components(documents(spark, rows), stars=2)) == expected(rows)


def test_awkward_rows_and_no_rows(spark):
    rows = awkward()
    assert result(J.jaccard_components(documents(spark, rows).repartition(4))) == expected(rows)
    assert result(J.jaccard_components(none(spark))) == []
    few = [(1, None), (2, "a b"), (3, "A  b"), (4, "a c"), (5, "")]
    assert result(J.jaccard_components(documents(spark, few))) == expected(few)


def test_every_partner_is_met():
    """Random pairs of sets at the bound share a signature in roles that fit, whatever the costs."""
    rng = np.random.default_rng(6)
    bands = J.Bands(80)
    for _ in range(3000):
        a = int(rng.choice([5, 6, 8, 9, 11, 13, 14, 19, 20, 27, 40, 64, 90, 200]))
        r = np.unique(rng.integers(0, 1 << 63, a).astype(np.uint64))
        b = int(rng.integers(-(-4 * a // 5), a + 1))
        common = -(-4 * (a + b) // 9)
        if common > b:
            continue
        s = np.unique(np.concatenate([r[rng.permutation(a)[:common]], rng.integers(0, 1 << 63, b - common).astype(np.uint64)]))
        assert 100 * common >= 80 * (a + b - common)
        cost = lambda w: rng.integers(0, 50, len(w)).astype(float)
        one, two = J.entries(r, bands, cost), J.entries(s, bands, cost)
        roles = {}
        for e in two.tolist():
            roles[e >> 4] = roles.get(e >> 4, 0) | e & 15
        assert any((x & 12 and roles.get(x >> 4, 0) & 1) or (x & 8 and roles.get(x >> 4, 0) & 2) for x in one.tolist())


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 100, 129, 700):
        for _ in range(50):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.8], rng.integers(0, 1 << 63, int(rng.integers(0, n + 1))).astype(np.uint64)]))
            if len(y):
                assert J.least_difference(J.odd_sketch(x), J.odd_sketch(y)) <= len(np.setxor1d(x, y))


def test_allocation_spends_where_few_partners_are():
    cost = np.array([50.0, 0, 7, 1e15])
    less = np.array([3.0, 2, 9, 1])
    assert J.allocate(cost, less, 2).tolist() == [0, 2, 0, 0]
    assert J.allocate(cost, less, 3).tolist() == [0, 2, 1, 0]
    assert J.allocate(cost, less, 4).tolist() == [0, 2, 2, 0]
    assert J.allocate(cost, less[:2], 4).tolist() == [1, 2, 1, 0]
    assert J.allocate(cost, less[:0], 3).tolist() == [1, 1, 1, 0]
    assert J.allocate(cost, less[:0], 4).tolist() == [1, 1, 1, 1]
