"""The registered queries of the operators here, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, dialogue, lattice, mixing, neardup, phrases, pii, quality, repair, rules, sharding, toxicity, url_filter
from .common import Scratch, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id", "source"])
    return m.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_words").alias("source_size"),
                    F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"), "source", F.col("mix_shard").alias("shard"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(list(url_filter.RULES), "key string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), listed)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids", F.size("spans").cast("long").alias("n_spans"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    j = rules.judge(docs, table(spark, sf_dir, "labels"), columns=["doc_id", "lang"])
    return j.select("doc_id", *[F.col(f"r_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op10_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = repair.write_shards(Scratch(spark), table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return repair.read_shards(files)


def op9_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "slot", "shard")


def op11_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return lattice.score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_toxicity, op3_url_cascade, op4_quality, op5_decontaminate, op6_personal_data, op7_quality_rules,
                                   op8_near_duplicates, op9_shard_lookup, op10_repair_ids, op11_lattice_score, op12_collocations, op13_repair_conversations)}
ORACLES = {
    "op12_collocations": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM t),
u AS (SELECT lang, id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM w),
i AS (SELECT lang, w, lead(w) OVER p AS x, lead(w, 2) OVER p AS y FROM u WINDOW p AS (PARTITION BY id ORDER BY i)),
f AS (SELECT lang, w AS p, 1 AS k, count(*) AS a FROM i GROUP BY ALL
      UNION ALL SELECT lang, w || ' ' || x, 2, count(*) FROM i WHERE x IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, w || ' ' || x || ' ' || y, 3, count(*) FROM i WHERE y IS NOT NULL GROUP BY ALL),
g AS MATERIALIZED (SELECT lang, p, k, a, string_split(p, ' ') AS s, lang || chr(10) || p AS key FROM f WHERE a >= 10),
h AS MATERIALIZED (SELECT lang, p, k, a, 1 AS c, lang || chr(10) || s[1] AS pl, lang || chr(10) || array_to_string(s[2:], ' ') AS pr FROM g WHERE k > 1
      UNION ALL SELECT lang, p, k, a, 2, lang || chr(10) || s[1] || ' ' || s[2], lang || chr(10) || s[3] FROM g WHERE k = 3),
cuts AS MATERIALIZED (SELECT h.lang, h.p, h.k, h.a, h.c, x.a AS l, y.a AS r, (1000000::HUGEINT * h.a * h.a) // (x.a::HUGEINT * y.a) AS score
    FROM h JOIN g x ON x.key = h.pl JOIN g y ON y.key = h.pr),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inner_of AS (SELECT lang || chr(10) || array_to_string(s[1:2], ' ') AS key, a FROM g WHERE k = 3
      UNION ALL SELECT lang || chr(10) || array_to_string(s[2:3], ' '), a FROM g WHERE k = 3),
longer AS (SELECT key, max(a) AS m FROM inner_of GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
kept AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.p)) AS rank, b.p AS phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer o ON o.key = b.lang || chr(10) || b.p WHERE o.m IS NULL OR b.k = 3 OR 100 * o.m < 50 * b.a)
SELECT kept.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang WHERE rank <= 2000""",
    "op3_url_cascade": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*(/?[^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM m""",
}
