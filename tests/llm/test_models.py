"""Language mixture, factorisation machine and token counts."""

import itertools
import math
import random

import numpy as np
import public_tokenizers
from coursewise.llm import factorization as FM
from coursewise.llm import language_mixture as L
from coursewise.llm import trie_tokens as T

from .corpora import awkward, documents, none, words

SF = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    got = L.op5_language_mixture(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_mixtures_are_told_apart():
    rng = np.random.default_rng(1)
    counts = rng.gamma(0.05, 1, (L.BUCKETS, 3)) * 1000
    model = L.Model(["a", "b", "c"], counts)
    for share in (0.0, 0.3, 0.5):
        grams = np.concatenate([rng.choice(L.BUCKETS, int(3000 * (1 - share)), p=model.prob[:, 0]),
                                rng.choice(L.BUCKETS, int(3000 * share), p=model.prob[:, 2])])
        found = model.infer(grams)
        assert set(found) == ({"a", "c"} if share else {"a"})
        assert abs(found["a"] - (1 - share)) < 0.05


def test_odd_texts(spark):
    model = L.fit(documents(spark, [(i, t) for i, t in awkward() if i is not None and i < 40]))
    assert model.langs == ["en"]
    docs = documents(spark, [(1, None), (2, ""), (3, "12 34 !?"), (4, "a"), (5, "é"), (None, "the then"), (4, "a"), (6, "語")])
    got = sorted((r.doc_id or 0, r.lang_pred) for r in L.identify(docs, model).collect())
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "en"), (6, "en")]
    assert L.identify(none(spark), model).count() == 0
    nothing = L.fit(none(spark))
    assert nothing.langs == [] and {r.lang_pred for r in L.identify(docs, nothing).collect()} == {"und"}


def test_interactions_by_all_pairs():
    rng = np.random.default_rng(4)
    m = FM.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    f, v = rng.choice(50, 12, replace=False), rng.normal(size=12)
    pairs = sum(float(m.factors[f[i]] @ m.factors[f[j]]) * v[i] * v[j] for i, j in itertools.combinations(range(12), 2))
    assert math.isclose(m.logit(f, v), 0.3 + float(m.linear[f] @ v) + pairs, rel_tol=1e-9)


def test_interactions_are_learnt():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, (1500, 2)).astype(np.float32) * 2 - 1
    y = (x[:, 0] * x[:, 1] > 0).astype(np.float32)  # no linear rule tells these apart
    m = FM.train(x, y, factors=4, epochs=40)
    right = [(m.score(np.arange(2), row) >= 0.5) == bool(t) for row, t in zip(x[:200], y)]
    assert np.mean(right) == 1


def test_quality_held_out(spark):
    got = FM.op8_factorization_machine(spark, SF).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    good = [r.score for r in held if truth[r.doc_id] == 1]
    bad = [r.score for r in held if truth[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_odd_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    machine = FM.fit(docs, labels)
    got = FM.score(docs, machine).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    assert FM.score(none(spark), machine).count() == 0
    empty = FM.fit(none(spark), labels.limit(0))
    assert {round(r.score, 6) for r in FM.score(docs, empty).collect()} == {0.5}


def brute_tokens(word, model):
    best, count = [0.0], [0]
    for d in range(1, len(word) + 1):
        some = [(best[a] + model.logp[word[a:d]], -a, count[a] + 1) for a in range(d) if word[a:d] in model.logp]
        if some:
            s, _, n = max(some)
        else:
            width = len(word[d - 1].encode())
            s, n = best[d - 1] + width * model.byte, count[d - 1] + width
        best.append(s)
        count.append(n)
    return count[-1], best[-1]


def test_token_counts_word_by_word(spark):
    model = T.Unigram(public_tokenizers.path("piece_bpe_32k.model"))
    rows = awkward()
    got = T.token_counts(documents(spark, rows), max_nodes=100).collect()
    want = []
    for i, text in rows:
        each = [brute_tokens(T.MARK + w, model) for w in words(text)]
        want.append((i, len(each), sum(n for n, _ in each), round(math.fsum(s for _, s in each), 6)))
    assert sorted(((r.doc_id, r.n_pretokens, r.n_tokens, round(r.score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert T.token_counts(none(spark)).count() == 0


def test_trie_shares_prefixes():
    model = T.Unigram(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    some = ["".join(rng.choice("abet") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    trie = T.Trie(model)
    ends = {w: trie.insert(w) for w in some}
    assert {w: (trie.count[n], trie.best[n]) for w, n in ends.items()} == {w: brute_tokens(w, model) for w in some}
    assert len(trie) == 1 + len({w[:d] for w in some for d in range(1, len(w) + 1)})  # a node for each prefix
    assert {w: trie.insert(w) for w in some} == ends
