"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.llm import (decontamination, license_scan, merkle_audit, near_dedup, packing,
                           personal_data, prefix_trie, quality_rules, secret_scan,
                           substring_dedup, token_alignment, url_templates, wavelet_files)
from pontualis.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the trusted target, all documents the raw corpus."""
    docs = read(spark, sf_dir, "documents")
    trusted = read(spark, sf_dir, "labels").where("quality = 1")
    ratio = quality_rules.fit_ratio(docs, trusted)
    return (quality_rules.quality_rules(docs, ratio)
            .select("doc_id", "_out.*").withColumn("llr", F.round("llr", 6))
            .withColumn("fair_llr", F.round("fair_llr", 6)))


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.size("_out.hits").cast("bigint")
    return found.select(
        "doc_id", "_out.n_words", n_hit.alias("n_hit"),
        F.size("_out.items").cast("bigint").alias("n_items"),
        decontamination.items_digest(F.col("_out.items")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op2_decontamination"] = rf"""
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    item_words AS (
        SELECT CAST(item_id AS VARCHAR) AS item,
            regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (SELECT item, w, least(len(w), 10) AS size,
                  unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
              FROM item_words WHERE len(w) > 0)),
    doc_windows AS (
        SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
              FROM doc_words, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
    found AS (
        SELECT doc_id, i, size, item FROM doc_windows JOIN item_windows USING (size, words)),
    hit AS (
        SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM found) GROUP BY 1),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@_query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(read(spark, sf_dir, "documents"))


ORACLE_SQL["op3_near_dedup"] = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
              FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 75 * (x.n + y.n - c)),
    reach(doc_id, c) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT CASE WHEN l.a = r.doc_id THEN l.b ELSE l.a END, r.c
        FROM reach r JOIN links l ON r.doc_id IN (l.a, l.b)),
    component AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM component LEFT JOIN sizes USING (doc_id)"""


@_query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    base, spans = F.col("_out.base"), F.col("_out.spans")
    counts = [secret_scan.count_kind(base, k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(spans).alias("spans"))


@_query
def op4_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet_files.stored(read(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(read(spark, sf_dir, "pages"))


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.items_of(read(spark, sf_dir, "documents")))


@_query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_repeats(read(spark, sf_dir, "documents"))


@_query
def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replica that is audited has faults at known page ids."""
    return merkle_audit.audited(read(spark, sf_dir, "pages"))


@_query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(read(spark, sf_dir, "documents"))
    base, spans = F.col("_out.base"), F.col("_out.spans")
    counts = [personal_data.count_kind(base, k).alias(f"n_{k}") for k in personal_data.BASE_KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
                        personal_data.listed(spans).alias("spans"))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


# A checksum step takes in a byte or, for -1, shifts by one bit.
ORACLE_SQL["op11_prefix_trie"] = """
    WITH stored AS (
        SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                                  ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    heads AS (
        SELECT c, turns, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(
                list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s:
                    [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END),
            CAST(4294967295 AS BIGINT)) % 9 AS BIGINT) AS h
        FROM stored),
    built AS (
        SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
        FROM heads a LEFT JOIN stored b ON b.c = a.c - a.c % 5),
    members AS (
        SELECT c, d, turns[1:d] AS path, d = len(turns) AS ends
        FROM (SELECT c, turns, unnest(generate_series(0, len(turns))) AS d FROM built)),
    nodes AS (
        SELECT path, d, min(c) AS conv_id, count(*) AS n_convs,
            coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids,
            CASE WHEN d = 0 THEN 0 ELSE strlen(path[d].t) END AS bytes
        FROM members GROUP BY path, d),
    children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    counted AS (
        SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    below AS (
        SELECT path[1:e] AS path, sum((n_convs - 1) * bytes) AS saved,
            count(*) FILTER (n_children = 0) AS leaves
        FROM (SELECT *, unnest(generate_series(0, d)) AS e FROM counted) GROUP BY 1)
    SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs,
        CAST(x.n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
        CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ids) AS ends_sha256
    FROM counted x JOIN below USING (path)
        LEFT JOIN nodes up ON x.d > 0 AND up.path = x.path[1:x.d - 1]"""


@_query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "_out.*").withColumn("score", F.round("score", 6))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))
