"""The operators of this subpackage as registered queries, and their SQL twins where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.llm.decontaminate import NUMBER_WORDS, UNITS, leaks
from rillcast.llm.fill_middle import fill_in_middle, restored
from rillcast.llm.hard_negatives import hard_negatives
from rillcast.llm.line_dedup import dedup_lines
from rillcast.llm.piece_bpe import piece_digests
from rillcast.llm.pseudonyms import pseudonymise
from rillcast.llm.quality_rules import STOP_WORDS, quality_rules
from rillcast.llm.simhash import fingerprint_text, simhash_groups
from rillcast.llm.substring_dedup import dedup_passages
from rillcast.llm.text_columns import spaced_words
from rillcast.llm.token_counts import token_counts
from rillcast.llm.token_planes import read_planes, write_planes
from rillcast.llm.url_templates import Rule, judge_urls
from rillcast.llm.warc_packages import read_packages, write_packages

WORD_MODEL = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The key of the registered query; real runs bring their own.
SAMPLE_KEY = b"registered query, not a secret"


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymise(table(spark, sf_dir, "documents"), SAMPLE_KEY)
    return found.select("doc_id", F.size("private").cast("long").alias("n_found"), "text")


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_planes(write_planes(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_MODEL)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), name="q").select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "q.kept"
    )


QUALITY_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
c AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len([x FOR x IN w IF list_contains([{", ".join(f"'{v}'" for s in STOP_WORDS for v in dict.fromkeys((s, s.capitalize(), s.upper())))}], x)]) AS n_stop,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines, w
  FROM s),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM c WHERE len(w) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n FROM p),
r AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS at FROM g WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_stop, len(lines) AS n_lines
  FROM c LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR n_symbols > 0.1 * n_words OR (n_words >= 40 AND n_stop < 0.02 * n_words) OR (n_lines >= 5 AND n_dup_lines > 0.4 * n_lines)) AS kept
FROM m
"""


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_MODEL))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op7_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_packages(write_packages(table(spark, sf_dir, "pages")), payloads=False).drop("url", "payload")


# Five hexadecimal digits of the digest are four base-32 digits.
PAGES_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, upper(sha1(payload)) AS h FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS keep FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM k
"""

RULES = (
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"), Rule("block", "net/fr/"),
)


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # A page's path names the document that it shows; that document's label is the page's.
    shown = pages.select("page_id", F.regexp_extract("url", r"://[^/?#]*/[^?#]*?([0-9]+)", 1).try_cast("long").alias("doc_id"))
    labels = shown.join(table(spark, sf_dir, "labels").selectExpr("doc_id", "toxic AS bad"), "doc_id")
    return judge_urls(pages, labels, RULES).drop("template", "purity")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")


def _canonical_sql(name: str, key: str, table_name: str) -> str:
    """Canonical words, then windows of five with two literal words or more, of a table's texts."""
    numbers, units = (", ".join(f"'{v}'" for v in words) for words in (NUMBER_WORDS, UNITS))
    window = ", ".join(f"lead({{c}}, {k}) OVER w" for k in range(5))
    return f"""{name}_raw AS (
  SELECT {key}, generate_subscripts(l, 1) AS i, unnest(l) AS raw
  FROM (SELECT {key}, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS l FROM {table_name} WHERE text IS NOT NULL)),
{name}_bare AS (
  SELECT *, regexp_replace(raw, '^[^\\p{{L}}\\p{{N}}%]+|[^\\p{{L}}\\p{{N}}%]+$', '', 'g') AS bare,
    lag(regexp_matches(raw, '[.!?:;][^\\p{{L}}\\p{{N}}]*$')) OVER (PARTITION BY {key} ORDER BY i) AS after_end FROM {name}_raw),
{name}_word AS (
  SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY i) - 1 AS place, lower(bare) AS low,
    regexp_matches(lower(bare), '^[+-]?\\p{{N}}[\\p{{N}}.,:/-]*%?$') OR lower(bare) IN ({numbers}) AS is_number,
    regexp_matches(bare, '^\\p{{Lu}}\\p{{Ll}}') AND NOT coalesce(after_end, true) AS is_name FROM {name}_bare WHERE bare <> ''),
{name}_kind AS (
  SELECT {key}, place, low, CASE WHEN is_number THEN '<number>'
      WHEN low IN ({units}) AND lag(is_number) OVER (PARTITION BY {key} ORDER BY place) THEN '<unit>'
      WHEN is_name AND place > 0 THEN '<name>' END AS slot FROM {name}_word),
{name}_win AS (
  SELECT * FROM (SELECT {key}, place, [{window.format(c="coalesce(slot, low)")}] AS canon, [{window.format(c="slot")}] AS slots, [{window.format(c="low")}] AS lows
    FROM {name}_kind WINDOW w AS (PARTITION BY {key} ORDER BY place))
  WHERE canon[5] IS NOT NULL AND len([x FOR x IN slots IF x IS NULL]) >= 2)"""


LEAKS_SQL = f"""
WITH {_canonical_sql("d", "doc_id", "documents")},
{_canonical_sql("b", "item_id", "benchmark")},
met AS (
  SELECT d.doc_id, b.item_id, b.place AS item_place, d.place - b.place AS shift, d.lows AS others, b.lows AS vals, b.slots
  FROM d_win d JOIN b_win b USING (canon)),
found AS (SELECT doc_id, item_id, count(DISTINCT item_place) AS n_found FROM met GROUP BY ALL),
totals AS (SELECT item_id, count(DISTINCT place) AS n_windows FROM b_win GROUP BY ALL),
pairs AS (
  SELECT DISTINCT doc_id, item_id, shift, vals[k] AS val, others[k] AS other FROM met, range(1, 6) t(k) WHERE slots[k] IS NOT NULL),
by_value AS (SELECT doc_id, item_id, shift, val, count(*) AS n, bool_or(val <> other) AS differs FROM pairs GROUP BY ALL),
by_item AS (SELECT doc_id, item_id, avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END) AS agreement, bool_or(differs) AS changed FROM by_value GROUP BY ALL)
SELECT doc_id::BIGINT AS doc_id, item_id::BIGINT AS item_id, n_windows, n_found, n_found / n_windows AS share,
  coalesce(agreement, 1.0)::DOUBLE AS agreement, coalesce(changed, false) AS changed
FROM found JOIN totals USING (item_id) LEFT JOIN by_item USING (doc_id, item_id)
WHERE n_found / n_windows >= 0.8 AND coalesce(agreement, 1.0) >= 0.8
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "lines.*", F.sha2("text", 256).alias("text_sha256"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}
    return made.withColumns(digests).drop("output")


FILL_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS l,
    [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS d FROM t),
c AS (
  SELECT *, len(l) AS n, least(d[1] % (len(l) + 1), d[2] % (len(l) + 1)) AS a, greatest(d[1] % (len(l) + 1), d[2] % (len(l) + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR d[3] % 100 >= 50 THEN 'plain' WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_passages(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "passages.*", F.sha2(F.array_join(spaced_words(F.col("text")), " "), 256).alias("kept_sha256"))


PASSAGES_SQL = """
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM t),
k AS (
  SELECT doc_id, i, CASE WHEN lead(i, 12) OVER d IS NOT NULL THEN string_agg(word, ' ') OVER (d ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS win
  FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM k WHERE win IS NOT NULL),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM f, range(13) r(o) WHERE first < doc_id),
c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept FROM p ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN c USING (doc_id)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


QUERIES = {
    "op1_pseudonyms": op1_pseudonyms,
    "op2_token_planes": op2_token_planes,
    "op3_quality_rules": op3_quality_rules,
    "op4_piece_bpe": op4_piece_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_simhash": op6_simhash,
    "op7_warc_packages": op7_warc_packages,
    "op8_url_templates": op8_url_templates,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    "op11_fill_middle": op11_fill_middle,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op3_quality_rules": QUALITY_SQL,
    "op7_warc_packages": PAGES_SQL,
    "op9_decontaminate": LEAKS_SQL,
    "op11_fill_middle": FILL_SQL,
    "op12_substring_dedup": PASSAGES_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
