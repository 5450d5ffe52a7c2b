"""Spelling variants against plain loops over all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from coursewise.llm import spelling as S
from coursewise.llm.common import written

from .corpora import awkward, documents, none


def counted(rows, min_chars=7, min_count=2):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_chars and n >= min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    n = counted(rows)
    out = []
    form = {}
    for w in n:
        by = sorted((-n[v], v) for v in n if near(w, v))
        form[w] = by[0][1] if by and -by[0][0] >= 10 * n[w] else None
        out.append([w, form[w], None, n[w], len(by), n[form[w]] if form[w] else None])
    for r in out:
        root = r[0]
        while form[root]:
            root = form[root]
        r[2] = root
    return sorted(map(tuple, out), key=repr)


def corpus(seed=3):
    """Texts with typos at several depths, in words of many letters and lengths."""
    rng = random.Random(seed)
    letters = "abcdeilnorstéüß÷×ÀÉ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 13))) for _ in range(40)]
    words += [w + "s" for w in words[:10]] + [w[1:] for w in words[10:20]] + ["aaaaaaaa", "aaaaaaa", "aaaaaab", "x" * 300, "x" * 299]

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]))

    rows = []
    for i in range(120):
        out = []
        for _ in range(rng.randint(1, 200)):
            w = words[min(int(rng.expovariate(0.15)), len(words) - 1)]
            while rng.random() < 0.06:
                w = typo(w)
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice((" ", ", ", "1", "\n", "ā")).join(out)))
    rows.append((300, "chainabc " * 900 + "chainabd " * 60 + "chainaed " * 4))  # a path of two steps
    return rows + [(None, "abcdeil abcdeil abcdeil"), (9, rows[9][1]), (9, rows[9][1]), (200, None), (201, ""), (202, "...")]


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.parametrize("filter_bytes", [32 << 20, 200])  # 200: several rounds
def test_variants(spark, filter_bytes):
    rows = corpus()
    want = expected(rows)
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want) and any(r[4] > 3 for r in want)
    assert result(S.variants(documents(spark, rows).repartition(5), filter_bytes=filter_bytes)) == want


def test_awkward_rows_and_no_rows(spark):
    rows = awkward()
    assert result(S.variants(documents(spark, rows))) == expected(rows)
    assert result(S.variants(none(spark))) == []
    assert result(S.variants(documents(spark, [(1, None), (2, "a b c")]))) == []


def test_small_dictionaries_count_the_same(spark, monkeypatch):
    rows = corpus(8)
    monkeypatch.setattr(S, "HELD", 5)
    batches = S._counts(7, 31)
    table = documents(spark, rows).select("doc_id", "text").toArrow()
    got = Counter()
    for b in batches(iter(table.to_batches())):
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            got[w] += n
    assert {w: n for w, n in got.items() if n >= 2} == counted(rows)


def test_rounds_cover_every_word_once(spark):
    words = [("".join(random.Random(i).choices("abcdefgh", k=7 + i % 4)), 2) for i in range(500)]
    words = sorted(set(words))
    df = written(spark.createDataFrame(words, "word string, n long"), "test-words")
    counts = Counter(len(w) for w, _ in words)
    layout = S.Layout(dict(counts), 300)
    assert layout.rounds > 1
    filters = [S.bloom_filter(df, layout, p) for p in range(layout.rounds)]
    parts = Counter()
    for w, _ in words:
        letters = np.frombuffer(w.encode("latin-1"), np.uint8)[None, :]
        part, block, bits = layout.place(S._terms(letters).sum(axis=1), len(w))
        assert filters[part[0]][block[0]] & bits[0] == bits[0]
        parts[int(part[0])] += 1
    assert sorted(parts) == list(range(layout.rounds))
