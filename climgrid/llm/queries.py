"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from climgrid.llm import (
    language, media, mixing, near_dedup, negatives, packing, phrases, quality_rules, quality_score, substrings,
    token_files, url_filter, warc,
)
from climgrid.storage import work_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a public tokenizer lies; executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality_rules")
def op1(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_minhash_near_dedup")
def op2(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_hilbert_packing")
def op3(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), with_ids=False, added=True)


@query("op4_substring_dedup")
def op4(spark, sf_dir):
    return substrings.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op5_cube_mixing")
def op5(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies", "source")


@query("op6_centroid_language")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    test = language.held_out(4, 2)
    found = language.identify(docs, language.fit(docs.where(~test)), reject=False)
    return found.select("doc_id", test.alias("held_out"), "lang_pred", "score", "rejected")


@query("op7_qda_quality")
def op7(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    test = language.held_out(5, 0)
    scored = quality_score.score(docs, quality_score.fit(docs, labels.where(~test)))
    return scored.select("doc_id", test.alias("held_out"), "score", F.col("predicted"))


@query("op8_dictionary_warc")
def op8(spark, sf_dir):
    folder = work_folder(spark, "warc")
    files = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(files, folder).drop("url", "payload")


@query("op9_arrow_tokens")
def op9(spark, sf_dir):
    folder = work_folder(spark, "token-ids")
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"), added=True)
    return token_files.read_tokens(files, folder)


@query("op10_png_media")
def op10(spark, sf_dir):
    stored = media.media_features(media.store_media(table(spark, sf_dir, "documents")))
    return stored.withColumn("feature", F.lower(F.hex("hash"))).drop("hash")


_SCORED = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
"""


@query(
    "op11_kronecker_negatives",
    _SCORED
    + """,
near AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM near JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10""",
)
def op11(spark, sf_dir):
    off = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, off).drop("positive_rank")


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query("op12_url_language_models")
def op12(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


@query(
    "op13_trie_phrases",
    """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
one AS (SELECT lang, unnest(w) AS phrase FROM words),
two AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM words),
three AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase FROM words),
f AS MATERIALIZED (SELECT lang, phrase, count(*) AS f FROM (FROM one UNION ALL FROM two UNION ALL FROM three) GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE f >= 10 AND contains(phrase, ' ')),
cuts AS MATERIALIZED (
  SELECT *, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c)),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
    CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score, w
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[:2], ' ') AS phrase, a FROM c WHERE len(w) = 3
    UNION ALL SELECT lang, array_to_string(w[2:], ' ') AS phrase, a FROM c WHERE len(w) = 3) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE NOT contains(phrase, ' ') GROUP BY ALL)
SELECT lang, row_number() OVER z AS rank, phrase, lowest.a AS a, l, r, n, score
FROM lowest JOIN total USING (lang) LEFT JOIN longer g USING (lang, phrase)
WHERE g.a IS NULL OR 100 * g.a < 50 * lowest.a
WINDOW z AS (PARTITION BY lang ORDER BY score DESC, lowest.a DESC, phrase)
QUALIFY rank <= 2000""",
)
def op13(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("k")
