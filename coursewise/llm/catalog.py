"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from coursewise.llm import divergence as D
from coursewise.llm.divergence import op2_distribution_divergence
from coursewise.llm.factorization import op8_factorization_machine
from coursewise.llm.fm_dedup import op7_fm_dedup
from coursewise.llm.hilbert_shards import op9_hilbert_shards
from coursewise.llm.language_mixture import op5_language_mixture
from coursewise.llm.latent_leaks import op4_latent_leaks
from coursewise.llm.packing import op3_reduced_packing
from coursewise.llm.pigeonhole_join import op11_jaccard_join
from coursewise.llm.simhash_pivot import op6_simhash_pivot
from coursewise.llm.spelling import op12_spelling_variants
from coursewise.llm.trie_tokens import op10_trie_token_counts
from coursewise.llm.warc import op1_warc_salvage
from coursewise.llm.whitening import op13_embedding_whitening

QUERIES = {f.__name__: f for f in (
    op1_warc_salvage, op2_distribution_divergence, op3_reduced_packing, op4_latent_leaks, op5_language_mixture,
    op6_simhash_pivot, op7_fm_dedup, op8_factorization_machine, op9_hilbert_shards, op10_trie_token_counts,
    op11_jaccard_join, op12_spelling_variants, op13_embedding_whitening)}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op1_warc_salvage"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS lowest FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN lowest < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN lowest < page_id THEN lowest END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)"""

ORACLES["op7_fm_dedup"] = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS lowest FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (k) WHERE lowest < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _divergence_sql() -> str:
    """The rule of ``divergence`` in long form: a row for each document, language and histogram bin."""
    langs = ", ".join(f"'{x}'" for x in D.COMMON_WORDS)

    def distances(name: str, refs: str) -> str:
        part = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({x} + {y}) / 2)) ELSE 0 END"
        return f"""
{name} AS (SELECT r, sqrt(greatest(min(d) FILTER (kind = 'chars'), 0)) AS c, sqrt(greatest(min(d) FILTER (kind = 'words'), 0)) AS w
  FROM (SELECT h.r, h.kind, q.lang, CASE WHEN any_value(h.total) > 0
               THEN sum({part('h.v / h.total', 'q.p')} + {part('q.p', 'h.v / h.total')}) / 2 ELSE 1 END AS d
        FROM hist h JOIN {refs} q ON h.kind = q.kind AND h.j = q.j GROUP BY ALL) GROUP BY r)"""

    def references(name: str, only: str) -> str:
        return f"""
{name} AS (SELECT lang, kind, j, s / sum(s) OVER (PARTITION BY lang, kind) AS p
  FROM (SELECT f.lang, h.kind, h.j, CAST(sum(h.v) AS DOUBLE) AS s
        FROM hist h JOIN f USING (r) {only} AND f.lang IN ({langs}) GROUP BY ALL))"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
three AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
          FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM d)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM three) WHERE c > 1)
        GROUP BY r),
f AS (SELECT d.r, doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             len(regexp_extract_all(t, '\\p{{Lu}}')) AS u, len(regexp_extract_all(t, '[0-9]')) AS g,
             len(regexp_extract_all(t, '[.,;:!?''"()-]')) AS p, length(t) AS n_chars,
             list_transform(list_filter(ws, lambda x: list_contains({_list(D.variants())}, x)), lambda x: lower(rtrim(x, '{D.MARKS}'))) AS known
      FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d) d
      LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
lists AS (SELECT r, 'chars' AS kind, [word_chars - u - g - n_symbols - p, u, g, n_symbols, p, n_chars - word_chars] AS l FROM f
          UNION ALL SELECT r, 'words', list_append(list_transform({_list(D.BINS)}, lambda x: len(list_filter(known, lambda y: y = x))),
                                                   n_words - len(known)) FROM f),
hist AS (SELECT r, kind, CAST(unnest(l) AS DOUBLE) AS v, generate_subscripts(l, 1) AS j, CAST(list_sum(l) AS DOUBLE) AS total FROM lists),
{references('ref1', 'JOIN b USING (r) WHERE NOT b.base_failed')},
{distances('dist1', 'ref1')},
{references('ref2', f'JOIN b USING (r) JOIN dist1 USING (r) WHERE NOT b.base_failed AND dist1.c < {D.NEAR_CHARS} AND dist1.w < {D.NEAR_WORDS}')},
{distances('dist2', 'ref2')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(n_words + word_chars >= {D.MIN_CHARS} AND CASE
         WHEN lang IS NULL OR lang IN (SELECT lang FROM ref2) THEN c > {D.CHARS_ALONE}
           OR (n_words >= {D.MIN_WORDS} AND c > {D.CHARS_BOTH} AND w * w - {D.CHANCE} / greatest(n_words, 1) > {D.WORDS_BOTH} * {D.WORDS_BOTH})
           OR (lang IS NOT NULL AND n_words >= {D.MIN_WORDS_ALONE} AND w * w - {D.CHANCE} / n_words > {D.WORDS_ALONE} * {D.WORDS_ALONE})
         ELSE c > {D.CHARS_FOREIGN} END, false) AS kept
FROM b LEFT JOIN dist2 USING (r)"""


ORACLES["op2_distribution_divergence"] = _divergence_sql()
