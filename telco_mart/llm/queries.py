"""Registered queries of this subpackage, with DuckDB SQL where SQL can state
them. Each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, exact_dedup, fingerprints, license_scan, lm, mixing, quality, secret_scan, simhash_dedup, url_filter, warc, whitening
from .common import hex64, scratch, table, written

#: Rank file of the byte-level BPE.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Tokenizers that the alignment compares.
BYTE_TOKENIZER, PIECE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SEED = 7
#: Copies of a document on average in mixing_large_rates.
LARGE = 20


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, packed=True, keep_text=False, decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` has no url: source stands for the host and lang for the
    path, so the path level is the languages inside each source."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = warc.write(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return warc.read(spark, folders, payloads=False).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f["version"] == 1)
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"), secret_scan.spans_text(F.col("findings")).alias("spans"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fit_and_score(table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also n_within_3 for the ids divisible by 20: how many other documents
    have a fingerprint within 3 bits."""
    docs = fingerprints.with_next(table(spark, sf_dir, "documents"))
    asked = F.coalesce(F.col("id") % 20 == 0, F.lit(False))
    fps = docs.groupBy("fp").agg(F.count("*").alias("n"), F.max(asked).alias("asked"))
    near = written(fingerprints.search(fps, radius=3), "near")  # joined as a plain table, whose large partitions Spark can split
    return docs.join(near, "fp", "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", hex64(F.col("fp")).alias("fingerprint"), hex64(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.when(asked, F.col("n_near") - 1).alias("n_within_3"),
    )


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.source_rates(docs, temperature=0.5), seed=SEED)
    return mixed.withColumn("rate", F.round("rate", 9))  # sums of doubles depend on their order


def mixing_large_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture at LARGE times the size, where every mean is a sum of parts."""
    docs = table(spark, sf_dir, "documents")
    rates = mixing.source_rates(docs, temperature=0.5, total=LARGE * docs.count())
    return mixing.mix(docs, rates, seed=SEED).withColumn("rate", F.round("rate", 9))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))
    return found.withColumn("score", F.round("score", 9))  # sums of doubles depend on their order


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also n_shared: shared-group links."""
    aligned = align.align(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"), "n_shared")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (op1_simhash_near_dedup, op2_byte_bpe, op3_url_filter, op4_exact_dedup, op5_quality_classifier, op6_warc, op7_secret_scan, op8_lm_scoring, op9_document_fingerprints, op10_source_mixing, mixing_large_rates,
              op11_license_scan, op12_cross_tokenizer_alignment, op13_embedding_whitening)
}



def mixing_sql(times: int) -> str:
    """Poisson numbers by the distribution function of each source's mean, cut
    into parts of at most 16, looked up at one uniform number a part."""
    uniform = lambda text: f"('0x' || substr(md5({text}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"
    columns = ", ".join(f"coalesce(d.{c}::VARCHAR, 'null')" for c in ("doc_id", "text", "lang", "source", "n_chars"))
    return f"""
        WITH n AS (SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
             s AS (SELECT sum(n) * {times} AS all_n, sum(w) AS all_w FROM n),
             r AS (SELECT source, w / all_w * all_n / n AS rate, greatest(ceil(rate / 16), 1)::BIGINT AS parts, rate / parts AS mean FROM n, s),
             f AS (SELECT source, i, sum(exp(-mean) * pow(mean, i) / gamma(i + 1)) OVER (PARTITION BY source ORDER BY i) AS upto FROM r, range(0, 81) g(i)),
             d AS (SELECT d.*, r.rate, r.parts, md5(concat_ws(chr(31), {columns})) AS digest, row_number() OVER (PARTITION BY {columns}) AS number
                   FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
             u AS (SELECT digest, number, source, part, CASE WHEN part = 1 THEN {uniform(f"'{SEED}:' || digest || ':' || number")}
                          ELSE {uniform(f"'{SEED}-part:' || digest || ':' || number || ':' || part")} END AS u
                   FROM d, LATERAL (SELECT unnest(range(1, parts + 1)) AS part) x),
             k AS (SELECT digest, number, count(f.i) AS copies FROM u LEFT JOIN f ON u.source IS NOT DISTINCT FROM f.source AND f.upto <= u.u GROUP BY digest, number)
        SELECT d.* EXCLUDE (digest, number, parts) REPLACE (round(d.rate, 9) AS rate), k.copies, x.copy,
               ('0x' || substr(md5('{SEED}-order:' || d.digest || ':' || d.number || ':' || x.copy), 1, 13))::BIGINT AS shuffle_key
        FROM d JOIN k ON d.digest = k.digest AND d.number = k.number, LATERAL (SELECT unnest(range(1, copies + 1)) AS copy) x"""


def license_sql() -> str:
    """Every place of every template by brute force: all words joined to all
    template words, summed by (document, template, start)."""
    rows = []
    for t, template in enumerate(license_scan.TEMPLATES):
        words = license_scan.split_words(template.text)
        must = license_scan.mandatory_positions(template, words)
        rows += [f"({t}, {i}, '{w}', {int(i in must)}, '{template.label}', {template.base})" for i, w in enumerate(words)]
    return f"""
        WITH t(t, q, word, must, label, base) AS (VALUES {", ".join(rows)}),
             w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{license_scan.WORD}') AS words FROM documents),
             p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM w),
             f AS (SELECT word, count(DISTINCT doc_id) AS df FROM p GROUP BY word),
             x AS (SELECT t.*, ln(1 + (SELECT count(*) FROM documents) / (1 + coalesce(df, 0))) + 0.01 AS weight FROM t LEFT JOIN f USING (word)),
             a AS (SELECT t, label, base, count(*) AS length, sum(weight) AS total, sum(must) AS musts FROM x GROUP BY ALL),
             h AS (SELECT doc_id, t, pos - q AS start, sum(weight) AS got, sum(must) AS found FROM p JOIN x USING (word) GROUP BY ALL),
             s AS (SELECT doc_id, start, label, base, least(got / total, 1) AS score FROM h JOIN a USING (t) JOIN w USING (doc_id)
                   WHERE got / total >= {license_scan.THRESHOLD} AND found = musts AND start >= 0 AND start + length <= len(words))
        SELECT w.doc_id, len(w.words)::BIGINT AS n_words, count(*) FILTER (s.base) AS n_base, (min(start) FILTER (s.base))::BIGINT AS first_word, (max(start) FILTER (s.base))::BIGINT AS last_word,
               array_to_string(list_sort(list_distinct(coalesce(list(label) FILTER (s.base), []))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(coalesce(list(label) FILTER (label IS NOT NULL), []))), ',') AS labels,
               round(coalesce(max(score), 0), 9)::DOUBLE AS score
        FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id, w.words"""


SQL = {
    "op11_license_scan": license_sql(),
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
             g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.h AS text_sha256
        FROM t JOIN g ON t.h = g.h""",
    "op6_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
             f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
        SELECT p.page_id, p.n AS payload_bytes, p.h AS payload_digest,
               CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f ON p.h = f.h AND p.n >= 100""",
    "op10_source_mixing": mixing_sql(1),
    "mixing_large_rates": mixing_sql(LARGE),
}
