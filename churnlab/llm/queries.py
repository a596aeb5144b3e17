"""One query for each operator, on its whole table; DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm.common import sha256_hex
from churnlab.sources.tables import read_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, as a DuckDB expression.
_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.line_dedup import line_dedup

    out = line_dedup(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", sha256_hex("kept_text").alias("kept_sha256"))


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, s[i] AS line, trim(translate(s[i], '{_UPPER}', '{_LOWER}'), {_WS}) AS key
  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
often AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.doc_id, l.i, l.line, o.key IS NOT NULL AS gone FROM lines l LEFT JOIN often o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.warc import warc_round_trip

    return warc_round_trip(read_table(spark, sf_dir, "pages"), min_revisit=1000)


OP2_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM q
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.suffix_dedup import suffix_dedup

    out = suffix_dedup(read_table(spark, sf_dir, "documents"), width=100)
    return out.select("doc_id", F.col("n_bytes").cast("long").alias("n_bytes"), "n_removed",
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from churnlab.llm.packing import best_fit_packing

    return best_fit_packing(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            capacity=1024, end_id=2)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.exact_dedup import exact_dedup

    return exact_dedup(read_table(spark, sf_dir, "documents"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from churnlab.llm.sp_lattice import sp_encode

    docs = read_table(spark, sf_dir, "documents")
    return sp_encode(docs, public_tokenizers.path("piece_bpe_32k.model"), columns=("n_ids", "ids_crc32", "decoded_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.quality_rules import quality_rules

    return quality_rules(read_table(spark, sf_dir, "documents"), max_lost=0.5).drop("kept_text")


def _op7_sql() -> str:
    from churnlab.llm.quality_rules import PHRASES

    word, symbol = r"[^\x20\x09-\x0D]+", "[#*$%&|<>]"
    phrases = " OR ".join(f"contains(translate(line, '{_UPPER}', '{_LOWER}'), '{p}')" for p in PHRASES)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
raw AS (SELECT doc_id, i, s[i] AS line, len(regexp_extract_all(s[i], '{word}')) AS n
        FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
              FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM d))),
judged AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup,
             10 * len(regexp_extract_all(line, '{symbol}')) > strlen(line)
             OR 10 * len(regexp_extract_all(line, '[!?]{{2}}([\x20\x09-\x0D]|$)')) > 3 * n
             OR len(regexp_extract_all(line, ' (\||\x{{BB}}) ')) >= 3 OR {phrases} AS fails
           FROM raw WHERE n > 0),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dup) AS n_dup_lines,
            count(*) FILTER (WHERE fails) AS n_failed_lines, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost_words
          FROM judged GROUP BY doc_id),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS times
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows WHERE times > 1)
            GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '{symbol}')) AS n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_failed_lines, 0) AS n_failed_lines,
         coalesce(l.lost_words, 0)::BIGINT AS lost_words
  FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost_words <= n_words AS kept
FROM counted
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.simhash import simhash_components

    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.quality_gbt import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=4, held_out=2, threshold=0.7)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.toxicity import toxicity_scores

    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5, held_out=0, threshold=0.5)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.fim import fill_in_middle, restored_text

    out = fill_in_middle(read_table(spark, sf_dir, "documents"), seed=1, plain_from=90, spm_below=20)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256_hex("output").alias("output_sha256"),
                      F.sha2(F.encode(restored_text(), "UTF-8"), 256).alias("restored_sha256"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
draws AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
            ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
cuts AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (SELECT *, t[1:a] AS pre, t[a + 1:b] AS mid, t[b + 1:] AS suf FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
                        WHEN 'spm' THEN concat('<S>', suf, '<P>', pre, '<M>', mid) ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlab.llm.divergence import source_divergence

    return source_divergence(read_table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
grps AS (SELECT DISTINCT lang, source FROM d),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)::HUGEINT AS q
           FROM grps g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
           LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
           LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from churnlab.llm.token_rans import token_round_trip

    return token_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_packing": op4_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash": op8_simhash,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_token_files": op13_token_files,
}
ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op2_warc": OP2_SQL, "op5_exact_dedup": OP5_SQL, "op7_quality_rules": _op7_sql(),
                          "op11_fill_in_middle": OP11_SQL, "op12_source_divergence": OP12_SQL}
