"""The numbered queries, and SQL for those that SQL can express."""

from pyspark.sql import functions as F

from review_lens.llm import (
    audit,
    counts,
    importance,
    language,
    personal,
    quality,
    sharding,
    simhash,
    suffixes,
    toxicity,
    transducer,
    urls,
    weighting,
)
from review_lens.llm.common import fold, table

QUERIES = {}
ORACLES = {}


def registered(run):
    QUERIES[run.__name__] = run
    return run


@registered
def op10_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits("fingerprint").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@registered
def op2_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = suffixes.leaks(docs, items, keep=["doc_id"])
    hit, ids = suffixes.leaked_words("leaks"), suffixes.leaked_items("leaks")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@registered
def op7_sharding(spark, sf_dir):
    found = sharding.sharded(table(spark, sf_dir, "documents", "doc_id", "text"), 24)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@registered
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    scorer = language.fit(docs.where(~held_out))
    found = language.identified(docs, scorer, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@registered
def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = personal.with_spans(docs, personal.fit(docs), keep=["doc_id"])
    counts = [personal.count_of("base_spans", kind).alias(f"n_{kind}") for kind in personal.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal.listed("base_spans"), 256).alias("base_sha256"),
        personal.listed("all_spans").alias("spans"),
    )


@registered
def op8_sentencepiece(spark, sf_dir):
    found = transducer.encoded(table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_ids"), "round_trip")


@registered
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = fold("doc_id", 4) == 2
    model = toxicity.fit(docs.where(~held_out), labels)
    found = toxicity.scored(docs, model, keep=["doc_id"])
    score = F.col("toxicity")
    return found.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted")
    )


#: The rules of the URL query: verdict, host and path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@registered
def op1_url_filters(spark, sf_dir):
    found = urls.judged(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return found.withColumnRenamed("id", "page_id")


@registered
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    chain = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judged(docs, chain, keep=["doc_id"])


@registered
def op6_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold("doc_id", 5) == 1
    found = weighting.scored(docs, docs.where(~held_out)).withColumnRenamed("id", "doc_id")
    measures = [name for name in found.columns if name != "doc_id"]
    return found.select("doc_id", held_out.alias("held_out"), *measures)


@registered
def op11_filter_interaction_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return audit.audit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@registered
def op12_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return counts.token_counts(docs, limit=512, keep=["doc_id"])


@registered
def op13_target_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = importance.resampled(docs, table(spark, sf_dir, "benchmark", "text"))
    return found.withColumnRenamed("id", "doc_id")


_WORDS = r"""list_filter(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

ORACLES["op2_benchmark_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
tests AS (
  SELECT DISTINCT item, size, array_to_string(words[k:k + size - 1], ' ') AS gram
  FROM (SELECT item, words, least(10, len(words)) AS size,
               unnest(range(1, len(words) - least(10, len(words)) + 2)) AS k FROM items WHERE len(words) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
places AS (
  SELECT doc_id, size, k, array_to_string(words[k:k + size - 1], ' ') AS gram
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k
        FROM docs, (SELECT DISTINCT size FROM tests) WHERE len(words) >= size)),
found AS (SELECT doc_id, k, p.size, item FROM places p JOIN tests t ON p.gram = t.gram AND p.size = t.size),
hit AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS w FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

ORACLES["op11_filter_interaction_audit"] = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         len(words) < 200 AS "A", 100 * len(list_distinct(words)) < 50 * len(words) AS "B",
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS "C",
         regexp_matches(text, '[#$%&*|]') AS "D", coalesce(s.doc_id > first_id, false) AS "E"
  FROM split s LEFT JOIN marks m ON s.doc_id = m.doc_id),
failed AS (
  SELECT part, good, toxic, count(*) AS n,
         concat(CASE WHEN "A" THEN 'A' ELSE '' END, CASE WHEN "B" THEN 'B' ELSE '' END, CASE WHEN "C" THEN 'C' ELSE '' END,
                CASE WHEN "D" THEN 'D' ELSE '' END, CASE WHEN "E" THEN 'E' ELSE '' END) AS failed
  FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || letter FROM orders JOIN letters ON NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step) WHERE length(filter_order) = 5),
told AS (
  SELECT f.part, s.filter_order, s.step, s.letter, f.good, f.toxic, f.n, f.failed,
         contains(f.failed, s.letter) AS hit,
         length(translate(f.failed, s.earlier, '')) < length(f.failed) AS gone
  FROM failed f, steps s),
counted AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failed = letter), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND toxic), 0) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
