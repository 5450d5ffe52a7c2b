import math
import random
import re
from collections import Counter

from coursewise.llm import divergence as D

from .corpora import awkward, documents, none, words


def counts(text):
    text = text or ""
    w = words(text)
    three = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if three[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def english(rng, n):
    common = [w for w in D.COMMON_WORDS["en"]]
    out = []
    for _ in range(n):
        out.append(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))))
    return " ".join(x.capitalize() + "" if i % 12 == 0 else x + ("." if i % 12 == 11 else "") for i, x in enumerate(out))


def corpus():
    rng = random.Random(3)
    rows = [(i, english(rng, rng.randint(60, 200))) for i in range(60)]
    junk = [(200, " ".join(f"{w}%%%***" for w in english(rng, 90).split())), (201, english(rng, 120).upper() + "!!"),
            (202, " | ".join(w * 2 for w in english(rng, 150).split() if len(w) > 3)), (203, "12345 67890 " * 3 + " ".join(str(k * k) for k in range(80)))]
    return rows, junk


def test_base_counts(spark):
    rows = awkward() + [(300, "a b\nA b\na b\n\n \na b"), (301, "x y z x y z x"), (302, "# * | <a> é%")]
    out, name = D.quality_rules(documents(spark, rows), ["doc_id", "text"])
    for r in out.collect():
        q = r[name]
        want = counts(r.text)
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (q.base_failed and q.kept)


def test_junk_goes_and_prose_stays(spark):
    rows, junk = corpus()
    out, name = D.quality_rules(documents(spark, rows + junk), ["doc_id"])
    kept = {r.doc_id for r in out.collect() if r[name].kept}
    assert kept == {i for i, _ in rows}


def test_distance_by_hand(spark):
    p, q = [3, 0, 7, 0], [0.25, 0.25, 0.5, 0.0]
    x = [v / 10 for v in p]
    kl = lambda a, b: sum(s * math.log2(s / t) for s, t in zip(a, b) if s)
    m = [(a + b) / 2 for a, b in zip(x, q)]
    want = (kl(x, m) + kl(q, m)) / 2
    df = spark.createDataFrame([(p,), ([0, 0, 0, 0],)], "h array<bigint>")
    got = [r.d for r in df.select(D.distance(df.h, q).alias("d")).collect()]
    assert math.isclose(got[0], want, rel_tol=1e-12) and got[1] == 1.0


def salad(rng, n, letters="abcdefghijklmnopqrstuvwxyz"):
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return " ".join(x.capitalize() if i % 12 == 0 else x + "." if i % 12 == 11 else x for i, x in enumerate(out))


def test_characters_of_any_language_are_judged(spark):
    rows, junk = corpus()
    rng = random.Random(8)
    prose = [(300, salad(rng, 300, "abcdefghiopqrstuvwz")), (301, " ".join("一二三四五六七八九十" * 3 + "。" for _ in range(60)) + "一丁七万三上下不与世" * 90)]
    docs = documents(spark, rows + junk + prose).selectExpr(
        "doc_id", "text", "CASE WHEN doc_id IN (200, 203, 300, 301) THEN 'xx' ELSE 'en' END AS lang", "1 AS _quality_x")
    out, name = D.quality_rules(docs, ["doc_id"])
    got = {r.doc_id: r[name] for r in out.collect()}
    assert not any(got[i].kept for i in (200, 202, 203)) and got[300].kept
    assert got[301].kept or got[301].base_failed


def test_word_salad_of_ordinary_characters_goes(spark):
    rows, _ = corpus()
    rng = random.Random(4)
    docs = [(i, t, "en") for i, t in rows] + [(400, salad(rng, 500), "en"), (401, salad(rng, 500), None), (402, salad(rng, 80), "en"),
                                             (403, english(rng, 500), "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    out, name = D.quality_rules(df, ["doc_id"])
    got = {r.doc_id: r[name] for r in out.collect()}
    assert not got[400].kept and got[400].char_distance < D.CHARS_BOTH  # its words alone
    assert got[401].kept and got[402].kept and got[403].kept  # unknown language, too short, prose
    assert all(got[i].kept for i, _ in rows)


def test_empty_and_all_failed(spark):
    assert D.quality_rules(none(spark), ["doc_id"])[0].count() == 0
    out, name = D.quality_rules(documents(spark, [(1, "too short")]), ["doc_id"])
    assert [r[name].kept for r in out.collect()] == [False]


def test_no_python_in_the_plan(spark):
    out, _ = D.quality_rules(documents(spark, corpus()[0]), ["doc_id"])
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
