"""Registered queries of the training-data operators, and their DuckDB statements where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import (
    conversation_repair, decontaminate, language_crf, license_scan, line_spread, mixing, ngram_join, packing,
    paragraph_dedup, periodic_runs, quality_rules, substring_dedup, toxicity_fm,
)
from pulsekit.llm.storage import read_table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, read_table(spark, sf_dir, "documents"))


def op2_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.score_toxicity(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(spark, read_table(spark, sf_dir, "documents"))


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.dedup_paragraphs(spark, read_table(spark, sf_dir, "documents"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.line_report(spark, read_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(read_table(spark, sf_dir, "documents")).withColumn(
        "licences", F.array_join("licences", ";"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.find_runs(
        read_table(spark, sf_dir, "documents"), periodic_runs.planted_loop))


def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), conversations.select("conv_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_array_dedup, op2_toxicity_fm, op3_ngram_jaccard_join, op4_benchmark_decontamination,
        op5_language_crf, op6_paragraph_dedup, op7_line_spread, op8_license_scan, op9_quality_rules,
        op10_temperature_mixing, op11_periodic_runs, op12_cost_packing, op13_conversation_repair)
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SIMILARITY = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), t AS (
  SELECT text, any_value(w) AS w, min(doc_id) AS rep, count(*) AS weight FROM d WHERE len(w) > 0 GROUP BY text
), g AS (
  SELECT DISTINCT rep, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS gram FROM t
), n AS (SELECT rep, count(*) AS size FROM g GROUP BY rep
), p AS (
  SELECT a.rep AS x, b.rep AS y, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.rep <> b.rep GROUP BY ALL
), link AS (
  SELECT x, y FROM p JOIN n u ON u.rep = x JOIN n v ON v.rep = y
  WHERE 10 * common >= 8 * (u.size + v.size - common)
), reach AS (
  SELECT rep AS x, rep AS y FROM t UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), class AS (SELECT x AS rep, min(y) AS class_id FROM reach GROUP BY x
), links AS (
  SELECT t.rep, t.weight - 1 + coalesce(sum(o.weight), 0) AS n_links
  FROM t LEFT JOIN link ON link.x = t.rep LEFT JOIN t o ON o.rep = link.y GROUP BY t.rep, t.weight
)
SELECT d.doc_id, coalesce(class.class_id, d.doc_id) AS class_id, CAST(coalesce(links.n_links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN t ON t.text = d.text LEFT JOIN class ON class.rep = t.rep LEFT JOIN links ON links.rep = t.rep
"""

_BARE = "trim({0}, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"

_LINE_SPREAD = f"""
WITH lines AS (
  SELECT {_BARE.format('u')} AS line, site FROM (
    SELECT unnest(string_split(text, chr(10))) AS u, coalesce(source, chr(0) || 'null') AS site
    FROM documents WHERE text IS NOT NULL)
), spread AS (
  SELECT line FROM lines WHERE length(line) > 0 GROUP BY line HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}
), found AS (SELECT coalesce(list(line), []) AS gone FROM spread
), cut AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length({_BARE.format('x')}) > 0) AS ls, gone,
    array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(gone, {_BARE.format('x')})),
                    chr(10)) AS kept
  FROM documents, found
)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines,
  coalesce(len(list_filter(ls, lambda x: list_contains(gone, {_BARE.format('x')}))), 0) AS n_removed,
  coalesce(length(kept), 0) AS kept_chars, md5(kept) AS kept_md5
FROM cut
"""

_BIGRAMS = ("list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))")

_LICENCES = f"""
WITH template AS (
  SELECT name, {_BIGRAMS.format('w')} AS grams FROM (
    SELECT name, regexp_extract_all(lower(body), '[a-z0-9]+') AS w FROM (VALUES
      {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in license_scan.TEMPLATES.items())}) AS v(name, body))
), unit AS (
  SELECT r, regexp_extract_all(lower(u), '[a-z0-9]+') AS w FROM (
    SELECT r, unnest(list_prepend(text, string_split(text, chr(10)))) AS u
    FROM (SELECT row_number() OVER () AS r, text FROM documents) WHERE text IS NOT NULL)
), grams AS (SELECT r, {_BIGRAMS.format('w')} AS g FROM unit WHERE len(w) BETWEEN 2 AND 100000
), hit AS (
  SELECT r, name, max(2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams))) AS dice
  FROM grams, template
  WHERE len(g) BETWEEN len(grams) * {license_scan.THRESHOLD} / (2 - {license_scan.THRESHOLD}) - 1e-9
    AND len(grams) * (2 - {license_scan.THRESHOLD}) / {license_scan.THRESHOLD} + 1e-9
  GROUP BY ALL HAVING dice >= {license_scan.THRESHOLD} - 1e-12
), best AS (
  SELECT r, count(*) AS n, list_sort(list(name)) AS licences, list(name ORDER BY dice DESC, name)[1] AS top,
    max(dice) AS dice FROM hit GROUP BY r
)
SELECT doc_id, coalesce(n, 0) AS n_licences, coalesce(array_to_string(licences, ';'), '') AS licences, top AS best_licence,
  round(coalesce(dice, 0), 6) AS best_dice
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) d LEFT JOIN best USING (r)
"""

_MIX_ROUND = """
  SELECT i + 1, CASE WHEN {test} THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {test} THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, list_transform(ps, lambda x: x / list_sum(ps)) AS q FROM (
    SELECT i, lo, hi, list_transform(tl, lambda x: pow(x / total, (lo + hi) / 2)) AS ps FROM {state}, one)), one
  WHERE i < {rounds}
"""

_MIXING = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, chr(0) || 'null') AS source,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(text)) AS mark FROM documents
), docs AS (
  SELECT *, CAST(CAST('0x' || substr(mark, 1, 8) AS BIGINT) % {mixing.N_BLOCKS} AS INTEGER) AS block
  FROM d WHERE n_tokens > 0
), totals AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY source
), one AS (
  SELECT list(CAST(tokens AS DOUBLE) ORDER BY source) AS tl, CAST(sum(tokens) AS DOUBLE) AS total,
    {mixing.TARGET_ENTROPY} * ln(count(*)) AS goal FROM totals
), e AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  {_MIX_ROUND.format(test="-list_sum(list_transform(q, lambda x: x * ln(x))) >= goal", state="e", rounds=mixing.ROUNDS)}
), r AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  {_MIX_ROUND.format(test=f"list_max(list_transform(range(1, len(q) + 1), lambda k: q[k] * total / tl[k])) > {mixing.MAX_REPEATS}",
                     state="r", rounds=mixing.ROUNDS)}
), limits AS (
  SELECT -list_sum(list_transform(tl, lambda x: x / total * ln(x / total))) >= goal AS yes,
    total / len(tl) / list_min(tl) <= {mixing.MAX_REPEATS} AS gentle FROM one
), exponent AS (
  SELECT round(greatest(CASE WHEN yes THEN 1.0 ELSE (SELECT lo FROM e WHERE i = {mixing.ROUNDS}) END,
                        CASE WHEN gentle THEN 0.0 ELSE (SELECT hi FROM r WHERE i = {mixing.ROUNDS}) END), 9) AS x
  FROM limits
), weights AS (
  SELECT source, tokens, CAST(floor(round(pow(tokens / total, x) / sum(pow(tokens / total, x)) OVER (), 9) * total)
    AS BIGINT) AS target FROM totals, one, exponent
), epochs AS (
  SELECT source, tokens, target, unnest(range(1, CAST(ceil(target / tokens) AS BIGINT) + 1)) AS epoch FROM weights
), blocks AS (SELECT source, block, CAST(sum(n_tokens) AS BIGINT) AS bt FROM docs GROUP BY ALL
), plan AS (
  SELECT source, block, epoch, bt, target - (epoch - 1) * tokens AS room,
    row_number() OVER visit AS block_rank,
    sum(bt) OVER (visit ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after
  FROM epochs JOIN blocks USING (source)
  WINDOW visit AS (PARTITION BY source, epoch ORDER BY md5(source || '|' || epoch || '|' || block), block)
), drawn AS (
  SELECT docs.*, epoch, block_rank, after <= room AS whole, room - (after - bt) AS space
  FROM docs JOIN plan USING (source, block) WHERE after - bt < room
), part AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY mark RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS used FROM drawn WHERE NOT whole
)
SELECT doc_id, source, epoch, block, block_rank, n_tokens FROM drawn WHERE whole
UNION ALL SELECT doc_id, source, epoch, block, block_rank, n_tokens FROM part WHERE used <= space
"""

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": _SIMILARITY,
    "op7_line_spread": _LINE_SPREAD,
    "op8_license_scan": _LICENCES,
    "op10_temperature_mixing": _MIXING,
}
