"""The corpus operators applied to their whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import align, decontamination, exact, fim, html, licenses, lines, mixing, pieces, pii, sharding, simhash, toxicity
from tickloom.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_by_document(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.pieces_report(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, unnest(range(len(a))) AS no, unnest(a) AS raw
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), occ AS (
    SELECT doc_id, no, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM l
), d AS (
    SELECT line, length(line) AS n, row_number() OVER (ORDER BY min((doc_id, no))) AS rk, min((doc_id, no)) AS first_at
    FROM occ WHERE line <> '' GROUP BY line
), halves AS (
    SELECT rk, line, m, unnest(['head', 'tail']) AS side, unnest([left(line, m // 2), right(line, m // 2)]) AS half
    FROM (SELECT rk, line, unnest([n, n - 1]) AS m FROM d WHERE n >= 20)
), near AS (
    SELECT DISTINCT b.line
    FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.half = b.half AND a.rk < b.rk
    WHERE levenshtein(a.line, b.line) = 1
), gone AS (
    SELECT o.doc_id, o.no, near.line IS NOT NULL AS is_near
    FROM occ o JOIN d USING (line) LEFT JOIN near USING (line)
    WHERE near.line IS NOT NULL OR (o.doc_id, o.no) <> d.first_at
)
SELECT x.doc_id, CAST(len(string_split(coalesce(x.text, ''), chr(10))) AS BIGINT) AS n_lines,
       count(*) FILTER (WHERE NOT g.is_near) AS n_exact,
       count(*) FILTER (WHERE g.is_near) AS n_near,
       coalesce(string_agg(CAST(g.no AS VARCHAR), ',' ORDER BY g.no), '') AS dropped
FROM documents x LEFT JOIN gone g ON x.doc_id = g.doc_id
GROUP BY x.doc_id, x.text
"""

ORACLES["op2_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

ORACLES["op7_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS seeded
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM s
), c AS (
    SELECT *, CAST(CASE source_rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight,
           CAST(source_size AS DOUBLE) * 2.0 AS cap,
           CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total
    FROM w
), levels AS (
    SELECT *, cap / weight AS ratio,
           (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_size, source_rank
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, source_size, source_rank
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_at
    FROM c
), level AS (
    SELECT arg_min(level_at, (ratio, source_size, source_rank)) AS level FROM levels WHERE level_at <= ratio
), goals AS (
    SELECT source, source_size, CASE WHEN ratio >= level THEN level * weight ELSE cap END AS target
    FROM levels, level
), rests AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goals
), runs AS (
    SELECT d.doc_id, d.size, r.source_size, r.target, r.epochs,
           CAST(floor(r.target + 0.5) AS BIGINT) - r.epochs * r.source_size
           - coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.seeded, d.doc_id, d.size
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS left_over
    FROM d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, left_over)) AS BIGINT) AS taken
FROM runs
"""

ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
    FROM documents
), draws AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM d
), forms AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
), parts AS (
    SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
           array_to_string(units[b + 1:], '') AS s
    FROM forms
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
