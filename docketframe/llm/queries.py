"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketframe.llm import exact_dedup, html_extract, language_id, licenses, mixing, near_dedup, packing, periodic_runs, quality_rules, ranked_search, rule_ensemble, secrets, sharding
from docketframe.llm.common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"), shingle_words=2, percent=80).drop("component")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(documents, exact_dedup.by_landing(2))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.with_repeated_ends(read_table(spark, sf_dir, "documents")))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_classifier": op13_quality_classifier,
}

CHECKS = {
    "op9_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM (
            SELECT doc_id, coalesce(text, '') AS t,
                   max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
            FROM documents)""",
    "op11_ranked_search": r"""
        WITH words AS (
            SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
        counted AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        sizes AS (SELECT row, sum(tf) AS n FROM counted GROUP BY row),
        totals AS (SELECT count(*) AS docs, sum(n) AS all_words FROM sizes),
        lengths AS (SELECT row, 75 + CAST((25 * n * docs) // all_words AS BIGINT) AS m FROM sizes, totals),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, totals GROUP BY term, docs),
        asked AS (
            SELECT item_id, term, count(*) AS often
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL),
        scored AS (
            SELECT item_id, doc_id, row, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (row)
            GROUP BY item_id, doc_id, row)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
        WHERE rank <= 20""",
}
