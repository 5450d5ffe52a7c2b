"""Quality rules: base counts, and divergence of a document's histograms from language references.

Built from column functions only. A document gets two histograms: characters by
class, and words by common word of its script's languages (one bin holds all
other words). Each is compared with the references of the languages by the
Jensen-Shannon distance (square root of the divergence, base 2); the smallest
counts. References are the sums over the corpus's documents of a language, made
twice: the second time only documents near the first references count, so junk
doesn't bend them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import written

#: Common words of each language with references.
COMMON_WORDS = {
    "de": ("auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu"),
    "en": ("and", "are", "as", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with"),
    "es": ("con", "de", "del", "el", "en", "la", "las", "los", "no", "para", "por", "que", "se", "su", "un", "una", "y"),
    "fr": ("dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une"),
}
BINS = sorted({w for words in COMMON_WORDS.values() for w in words})
#: Ends of words that don't count when a common word is looked up.
MARKS = ".,;:!?"


def variants() -> list[str]:
    """Forms in which a common word is looked up: as it is or capitalised, alone or before a mark."""
    return sorted({v + m for w in BINS for v in (w, w.capitalize()) for m in ("", ".", ",")})


SPACES = r"[\x20\x09-\x0D]"

#: Distances (not squared) over which a document is rejected, and guards.
CHARS_ALONE = 0.28  # of the character classes, alone
CHARS_BOTH, WORDS_BOTH = 0.17, 0.17  # of characters and words, together
CHARS_FOREIGN = 0.38  # of the characters of a language without references
WORDS_ALONE, MIN_WORDS_ALONE = 0.30, 200  # of the words alone, where the language's words are known
NEAR_CHARS, NEAR_WORDS = 0.14, 0.25  # documents that make the second references
MIN_CHARS, MIN_WORDS = 200, 60
#: Share of the word divergence that chance alone gives: this over the number of words.
CHANCE = 4.0


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows found twice or more in the text.

    Equal windows are neighbours once (hash, place) pairs are sorted; the
    places of windows with an equal neighbour, in order, cover three words
    each, less where the next begins earlier.
    """
    n = F.size(words)
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(3)) - 3),
                                        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def places(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["i"])))

    def cover(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
                           F.lit(0), lambda a, x: a + x)

    return F.coalesce(_let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(places(h), cover))
                           .otherwise(0)), F.lit(0)).cast("long")


def features(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with struct ``out``: the base counts and the histograms ``chars`` and ``words``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    w, t = F.col(f"{out}_w"), F.col(f"{out}_t")
    split = docs.withColumn(f"{out}_t", text).withColumn(f"{out}_w", F.array_remove(F.split(t, f"{SPACES}+"), ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.withColumns({
        f"{out}_c": F.length(F.array_join(w, "")).cast("long"),
        f"{out}_d": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        f"{out}_r": _repeat_words(w),
        f"{out}_s": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        f"{out}_u": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        f"{out}_n": F.regexp_count(t, F.lit(r"[0-9]")).cast("long"),
        f"{out}_p": F.regexp_count(t, F.lit(r"[.,;:!?'\"()-]")).cast("long"),
        f"{out}_h": F.transform(F.filter(w, lambda x: x.isin(variants())), lambda x: F.lower(F.rtrim(x, F.lit(MARKS)))),
    })
    c, d, r, s, u, n, p, h = (F.col(f"{out}_{x}") for x in "cdrsunph")
    n_words = F.size(w).cast("long")
    known = F.transform(F.array(*[F.lit(b) for b in BINS]), lambda b: (F.size(h) - F.size(F.array_remove(h, b))).cast("long"))
    return counted.withColumn(out, F.struct(
        n_words.alias("n_words"), c.alias("word_chars"), s.alias("n_symbols"), d.alias("n_dup_lines"), r.alias("n_repeat_words"),
        F.array(c - u - n - s - p, u, n, s, p, F.length(t) - c).alias("chars"),
        F.concat(known, F.array(n_words - F.size(h))).alias("words"),
    )).drop(*[f"{out}_{x}" for x in "twcdrsunph"])


def distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon divergence (base 2) of a histogram from a reference distribution; 1 for an empty histogram."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).cast("double")

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def sums(n: Column) -> Column:
        return F.aggregate(F.zip_with(counts, F.array(*[F.lit(float(q)) for q in reference]), lambda a, q: _let(
            F.struct((a / n).alias("p"), q.alias("q")),
            lambda v: part(v["p"], (v["p"] + v["q"]) / 2) + part(v["q"], (v["p"] + v["q"]) / 2))),
            F.lit(0.0), lambda a, x: a + x) / 2

    return _let(total, lambda n: F.when(n > 0, sums(n)).otherwise(F.lit(1.0)))


def references(made: DataFrame, out: str, lang_col: str, only: Column) -> dict[str, tuple[list[float], list[float]]]:
    """By language of COMMON_WORDS, the distributions of its documents that meet ``only``: that many rows at most."""
    sizes = {"chars": 6, "words": len(BINS) + 1}
    sums = (made.where(only & F.col(lang_col).isin(list(COMMON_WORDS))).groupBy(F.col(lang_col).alias("lang"))
            .agg(*[F.sum(F.col(out)[k][i]).alias(f"{k}{i}") for k, n in sizes.items() for i in range(n)]).collect())
    got = {}
    for row in sums:
        totals = {k: [row[f"{k}{i}"] for i in range(n)] for k, n in sizes.items()}
        if all(sum(v) for v in totals.values()):
            got[row.lang] = tuple([x / sum(v) for x in v] for v in totals.values())
    return dict(sorted(got.items()))


def _nearest(out: str, refs: dict) -> tuple[Column, Column]:
    def least(k: int, name: str) -> Column:
        all_ = [distance(F.col(out)[name], r[k]) for r in refs.values()]
        return F.sqrt(F.greatest(F.least(*all_) if len(all_) > 1 else all_[0], F.lit(0.0)))

    if not refs:
        return F.lit(0.0), F.lit(0.0)
    return least(0, "chars"), least(1, "words")


def quality_rules(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, str]:
    """(rows, name): columns ``carry`` of every row and a struct ``name`` with the counts and the verdict.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept. ``kept`` is false for a
    row that fails the base rule or whose histograms diverge. Guards: the
    characters of a text of under MIN_CHARS and the words of one of under
    MIN_WORDS aren't judged, and what chance gives over few words is taken off.
    Words alone reject a document (ordinary characters, but not the language's
    words) from MIN_WORDS_ALONE words on. A document of a language without
    references is judged by its characters only, with a wider bound, as
    scripts differ. A null text is empty (and fails the base rule); a null
    language is judged by the nearest references, but not by words alone.
    Repeated rows get equal results. ``name``
    is chosen to be none of the columns of ``docs``. The features are written
    once, as the references need all documents before the first verdict.
    """
    name = "_quality"
    while any(c.lower().startswith(name) for c in docs.columns):
        name = "_" + name
    lang = f"{name}_lang"
    made = features(docs.withColumn(lang, F.col(lang_col).cast("string")), text_col, name).select(*carry, lang, name)
    made = written(made, "quality")
    q = F.col(name)
    base = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    refs = references(made, name, lang, ~base)
    chars, words = _nearest(name, refs)
    refs = references(made, name, lang, ~base & (chars < NEAR_CHARS) & (words < NEAR_WORDS)) or refs
    chars, words = _nearest(name, refs)
    scored = made.withColumns({f"{name}_c": chars, f"{name}_w": words})
    c, w = F.col(f"{name}_c"), F.col(f"{name}_w")
    n = F.greatest(q["n_words"], F.lit(1))
    known = F.coalesce(F.col(lang).isin(list(refs)), F.lit(False))
    words_differ = lambda bound: w * w - CHANCE / n > bound * bound
    diverges = F.when(known | F.col(lang).isNull(),
                      (c > CHARS_ALONE) | ((n >= MIN_WORDS) & (c > CHARS_BOTH) & words_differ(WORDS_BOTH))
                      | (known & (n >= MIN_WORDS_ALONE) & words_differ(WORDS_ALONE))).otherwise(c > CHARS_FOREIGN)
    long_enough = q["n_words"] + q["word_chars"] >= MIN_CHARS
    verdict = F.struct(*[q[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       base.alias("base_failed"), c.alias("char_distance"), w.alias("word_distance"),
                       (~base & ~(long_enough & diverges)).alias("kept"))
    return scored.select(*[F.col(x) for x in carry], verdict.alias(name)), name


def op2_distribution_divergence(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows, name = quality_rules(docs, ["doc_id"])
    return rows.select("doc_id", *[F.col(name)[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])
