"""The registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    exact,
    language,
    minhash,
    mixing,
    pieces,
    pii,
    quality,
    search,
    simhash,
    substrings,
    tokens,
    warc,
    whitening,
)
from ebbtide.llm.shared import table
from ebbtide.session import scratch_path


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


EXACT_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS norm
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM rows WINDOW w AS (PARTITION BY norm ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256
FROM ranked
"""

def held_out() -> Column:
    """Whether a document is kept from training; one without an id is not."""
    kept = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return F.coalesce(kept, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language.train(docs.where(~held_out()))
    found = language.identify(docs, network)
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


WARC_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html,
         octet_length(encode(coalesce(html, ''))) AS payload_bytes
  FROM pages
), held AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM rows
), marked AS (
  SELECT *, payload_bytes >= 1000 AND page_id <> holder AS revisit FROM held
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN holder END AS refers_to
FROM marked
"""


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "row.source", "copy"
    )


MIXING_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(octet_length(encode(coalesce(text, '')))) AS bytes
  FROM documents GROUP BY source HAVING bytes > 0
), rates AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE
         * (SELECT sum(bytes) FROM sizes)::DOUBLE / bytes::DOUBLE AS rate
  FROM sizes
), terms AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
  FROM terms WHERE k < ceil(rate + 10 * sqrt(rate) + 30)
), drawn AS (
  SELECT doc_id, source,
         ('0x' || substr(md5(doc_id || ':17:count'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
           AS chance
  FROM documents
), counted AS (
  SELECT doc_id, d.source, count(*) AS times
  FROM drawn d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.total <= d.chance
  GROUP BY doc_id, d.source
)
SELECT doc_id, source, unnest(range(1, times + 1))::INTEGER AS copy FROM counted
"""


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"))
    return encoded.withColumnRenamed("id", "doc_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.lower(F.hex("kept_sha")).alias("kept_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumnRenamed("id", "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("id", "doc_id")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.withColumnRenamed("id", "doc_id")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), held AS (
  SELECT row, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM held
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY item_id, term
), counted AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, doc_id, n, term
), weighed AS (
  SELECT term,
         floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term, big_n
), scored AS (
  SELECT item_id, row, doc_id,
         sum(times * w * ((1000000000 * tf)
             // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM counted JOIN asked USING (term) JOIN weighed USING (term), totals
  GROUP BY item_id, row, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "one")
    return rows.select("id", "n", "deviation", "identity_error", one).select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        F.col("one.whitened").alias("whitened"),
        F.col("one.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {
    "op1_language_id": (op1_language_id, None),
    "op3_pii": (op3_pii, None),
    "op4_mixing": (op4_mixing, MIXING_SQL),
    "op5_sentencepiece": (op5_sentencepiece, None),
    "op6_substring_dedup": (op6_substring_dedup, None),
    "op7_token_counts": (op7_token_counts, None),
    "op9_quality_rules": (op9_quality_rules, None),
    "op2_warc": (op2_warc, WARC_SQL),
    "op8_simhash_near_dedup": (op8_simhash_near_dedup, None),
    "op10_exact_dedup": (op10_exact_dedup, EXACT_SQL),
    "op11_minhash_near_dedup": (op11_minhash_near_dedup, None),
    "op12_lexical_search": (op12_lexical_search, SEARCH_SQL),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}
