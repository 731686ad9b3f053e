"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from corpusloom.llm.decontaminate import op8_edit_matches
from corpusloom.llm.language_model import op2_deleted_interpolation
from corpusloom.llm.line_dedup import op10_prefix_doubling
from corpusloom.llm.ngram_join import op5_partenum, op5_partenum_links
from corpusloom.llm.pieces import op3_merge_dropout
from corpusloom.llm.quality import op9_host_rules
from corpusloom.llm.reshard import op6_min_cost_flow
from corpusloom.llm.secrets import op1_blob_ledger
from corpusloom.llm.token_files import op7_elias_fano
from corpusloom.llm.warc import op4_splittable_warc

QUERIES = {
    "op1_blob_ledger": op1_blob_ledger,
    "op2_deleted_interpolation": op2_deleted_interpolation,
    "op3_merge_dropout": op3_merge_dropout,
    "op4_splittable_warc": op4_splittable_warc,
    "op5_partenum": op5_partenum,
    "op5_partenum_links": op5_partenum_links,
    "op6_min_cost_flow": op6_min_cost_flow,
    "op7_elias_fano": op7_elias_fano,
    "op8_edit_matches": op8_edit_matches,
    "op9_host_rules": op9_host_rules,
    "op10_prefix_doubling": op10_prefix_doubling,
}

ORACLE_SQL = {
    "op4_splittable_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM m""",
    "op5_partenum": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT a AS doc_id, a AS reached FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a),
        c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id),
        t AS (SELECT doc_id, string_agg(shingle, '|' ORDER BY shingle) AS whole FROM s GROUP BY doc_id),
        q AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS class_id FROM t)
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, coalesce(q.class_id, d.doc_id) AS class_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id""",
    "op9_host_rules": r"""
        WITH w AS (SELECT doc_id, source AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        g AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
        f AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
        r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM f, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id),
        l AS (SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        m AS (SELECT w.doc_id, host, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
              CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(l.lines, 0) AS BIGINT) AS n_lines
              FROM w LEFT JOIN l ON l.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id),
        x AS (SELECT *, unnest([{'rule': 'few_words', 'failed': n_words < 20}, {'rule': 'repeats', 'failed': 100 * n_repeat_words > 30 * n_words},
              {'rule': 'symbols', 'failed': 10 * n_symbols > n_words}, {'rule': 'dup_lines', 'failed': 10 * n_dup_lines > 3 * n_lines}]) AS u FROM m),
        h AS (SELECT host, u.rule AS rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE u.failed) AS DOUBLE) AS f FROM x GROUP BY 1, 2),
        p AS (SELECT rule, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square, count(*) / sum(n) AS share FROM h GROUP BY rule),
        s AS (SELECT rule, mean, greatest(1, least(1e6, mean * (1 - mean) / greatest(square - mean * mean - mean * (1 - mean) * share, 1e-9) - 1)) AS strength FROM p),
        t AS (SELECT host, n, mean, strength, (f + mean * strength) / (n + strength) AS rate FROM h JOIN s USING (rule)),
        v AS (SELECT host, bool_and(rate - 3 * sqrt(rate * (1 - rate) / (n + strength + 1)) <= greatest(2 * mean, 0.2)) AS ok FROM t GROUP BY host),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, NOT base_failed AND ok AS kept
        FROM b JOIN v ON b.host IS NOT DISTINCT FROM v.host""",
}
