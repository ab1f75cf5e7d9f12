"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .common import table
from .decontaminate import contamination
from .html import main_text
from .licenses import license_scan
from .manifest import manifest_digests
from .neardup_vectors import near_duplicates
from .ngram_join import jaccard_classes
from .packing import packing_digests
from .phrases import phrase_digests
from .quality import quality
from .runs import run_digests, with_planted_runs
from .suffix_dedup import repeat_digests
from .urls import host, judge, path

#: Folder of the public vocabulary files.
VOCABULARIES = "/opt/tokenizers"


def captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with a fetch time, and a dated list of their hosts and sections: lists that grow with the table."""
    day = lambda n: F.timestamp_add("DAY", n.cast("int"), F.lit("2024-01-01").cast("timestamp"))
    captures = pages.select("page_id", "url", day(F.col("page_id") * 17 % 365).alias("fetched"))
    named = pages.select(host(F.col("url")).alias("host"), F.element_at(F.split(path(F.col("url")), "/"), 2).alias("section"), "page_id")
    hosts = named.where("host != ''").groupBy("host").agg(F.min("page_id").alias("m")).where("m % 3 != 0")
    sections = named.where("host != '' AND section != ''").groupBy("host", "section").agg(F.min("page_id").alias("m")).where("m % 5 < 2")
    begun = F.col("m") * 37 % 300
    entry = lambda frame, name, pattern, action, when: frame.select(
        F.lit(name).alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), day(when).alias("dated")
    )
    section = F.concat_ws("/", "host", "section")
    entries = (
        entry(hosts, "hosts", F.col("host"), "add", begun)
        .union(entry(hosts.where("m % 2 = 0"), "hosts", F.col("host"), "remove", begun + 45))
        .union(entry(hosts.where("m % 4 = 0"), "hosts", F.col("host"), "add", begun + 60))
        .union(entry(sections, "sections", section, "add", F.col("m") * 11 % 365))
        .union(entry(sections, "sections", section, "remove", F.col("m") * 11 % 365 + 90))
    )
    return captures, entries


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    captures, entries = captures_and_entries(table(spark, folder, "pages").select("page_id", "url"))
    return judge(captures, entries).select("page_id", "url", "blocked", "n_entries", "list", "pattern")


OP1_SQL = """
WITH p AS (
  SELECT page_id, url, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
         DATE '2024-01-01' + CAST(page_id * 17 % 365 AS INT) AS fetched FROM pages),
hosts AS (SELECT host, min(page_id) AS m FROM p WHERE host <> '' GROUP BY host HAVING min(page_id) % 3 <> 0),
sections AS (
  SELECT host || '/' || split_part(path, '/', 2) AS pattern, min(page_id) AS m FROM p
  WHERE host <> '' AND split_part(path, '/', 2) <> '' GROUP BY 1 HAVING min(page_id) % 5 < 2),
listed AS (
  SELECT 'hosts' AS list, host AS pattern, CAST(m * 37 % 300 AS INT) AS since,
         CASE WHEN m % 2 = 0 THEN CAST(m * 37 % 300 + 45 AS INT) END AS until FROM hosts
  UNION ALL SELECT 'hosts', host, CAST(m * 37 % 300 + 60 AS INT), NULL FROM hosts WHERE m % 4 = 0
  UNION ALL SELECT 'sections', pattern, CAST(m * 11 % 365 AS INT), CAST(m * 11 % 365 + 90 AS INT) FROM sections),
hits AS (
  SELECT page_id, list, pattern, row_number() OVER (PARTITION BY page_id ORDER BY list, -length(pattern), pattern, since) AS k,
         count(*) OVER (PARTITION BY page_id) AS n
  FROM p JOIN listed ON (host = pattern OR ends_with(host, '.' || pattern) OR starts_with(host || path || '/', pattern || '/') AND list = 'sections')
  WHERE fetched >= DATE '2024-01-01' + since AND (until IS NULL OR fetched < DATE '2024-01-01' + until))
SELECT p.page_id, url, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, list, pattern
FROM p LEFT JOIN hits ON p.page_id = hits.page_id AND k = 1
"""


def op2_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_digests(table(spark, folder, "documents"), 35)


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents"), 4, 85)


def op5_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digests(table(spark, folder, "documents"), 50)


def op6_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents"), f"{VOCABULARIES}/word_bpe_49k.json")


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(with_planted_runs(table(spark, folder, "documents")))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_digests(table(spark, folder, "documents"))


def manifest_sql(levels: int = 7, tops: int = 3) -> str:
    """The manifest level by level: enough for ``8 ** levels`` rows of a language and ``8 ** tops`` languages."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    # CRC-32 over the decimal id: each byte is added, then eight bits are shifted out
    bits = "flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, x: {step}), 4294967295)"
    parts = [
        f"d AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS fold FROM documents)",
        "p0 AS (SELECT doc_id, lang, leaf, fold, '' AS proof, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS node, count(*) OVER (PARTITION BY lang) AS n FROM d)",
        "n0 AS (SELECT lang, node, leaf AS h, n FROM p0)",
    ]

    def climb(tree: str, level: int, keys: str, same: str) -> None:
        alone = f"n <= {8**level}"
        parts.append(f"{tree}{level + 1} AS (SELECT {keys} node // 8 AS node, CASE WHEN {alone} THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY node)) END AS h, n, list(h ORDER BY node) AS run FROM {tree}{level} GROUP BY {keys} node // 8, n)")
        at = "p.node % 8 + 1"
        beside = f"array_to_string(list_filter(r.run, lambda x, i: i != {at}), '')"
        up = f"sha256(array_to_string(list_transform(r.run, lambda x, i: CASE WHEN i = {at} THEN p.fold ELSE x END), ''))"
        path, following = ("p", "p") if tree == "n" else ("q", "q")
        more = ", p.subroot" if tree == "t" else ""
        parts.append(f"{following}{level + 1} AS (SELECT p.doc_id, p.lang, p.leaf, CASE WHEN p.{alone} THEN p.fold ELSE {up} END AS fold, CASE WHEN p.{alone} THEN p.proof ELSE p.proof || {beside} END AS proof, p.node // 8 AS node, p.n{more} FROM {path}{level} AS p JOIN {tree}{level + 1} AS r ON {same} r.node = p.node // 8)")

    for level in range(levels):
        climb("n", level, "lang,", "p.lang IS NOT DISTINCT FROM r.lang AND")
    parts.append(f"t0 AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS node, count(*) OVER () AS n FROM n{levels})")
    parts.append(f"q0 AS (SELECT p.doc_id, p.lang, p.leaf, p.fold, p.proof, t.node, t.n, t.h AS subroot FROM p{levels} AS p JOIN t0 AS t ON p.lang IS NOT DISTINCT FROM t.lang)")
    for level in range(tops):
        climb("t", level, "", "")
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, "
        f"fold = t.h AS verified FROM q{tops}, t{tops} AS t"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_phrases": op2_phrases,
    "op3_licenses": op3_licenses,
    "op4_jaccard": op4_jaccard,
    "op5_suffixes": op5_suffixes,
    "op6_contamination": op6_contamination,
    "op7_quality": op7_quality,
    "op8_vectors": op8_vectors,
    "op9_main_text": op9_main_text,
    "op10_bpe": op10_bpe,
    "op11_packing": op11_packing,
    "op12_runs": op12_runs,
    "op13_manifest": op13_manifest,
}

ORACLES: dict[str, str] = {"op1_url_filter": OP1_SQL, "op13_manifest": manifest_sql()}
