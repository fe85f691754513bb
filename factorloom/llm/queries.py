"""Queries of the text problems, and SQL to compare them with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factorloom.functions.common import read_table
from factorloom.llm.canonical import canonical_text, look_alike_classes, look_alike_pairs
from factorloom.llm.leakage import leaked_items
from factorloom.llm.mixing import mix_sources


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a run of 12 words of an item, or tiles of 5 words and more over half of it, in any order."""
    return leaked_items(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"), shortest_tile=5, least_run=12, least_coverage=0.5)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The longest tile is the longest match, so a tile of 12 words is what the case asks for."""
    return p7_leaks(spark, d).filter("longest_tile >= 12").select("doc_id", "item_id").distinct()


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[1]


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    """Per source what the mixture must keep: its records, its share but for one record's tokens, and its cap."""
    docs = read_table(spark, d, "documents")
    copies, shares = mix_sources(docs, read_table(spark, d, "mix_targets"))
    used = copies.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("sum"), F.max("copies").alias("most"), F.max("tokens").alias("largest"), F.count_distinct("doc_id").alias("ids"), F.count("*").alias("rows"))
    total = copies.agg(F.sum(F.col("tokens") * F.col("copies")).alias("total"))
    out = shares.join(used, "source", "left").withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one")
    # each source may miss its size by one record, so a share by the largest record's part of the whole, twice
    near = F.abs(F.coalesce(F.col("sum"), F.lit(0)) / F.col("total") - F.col("reachable_share")) <= 2 * F.max("largest").over(Window.partitionBy("one")) / F.col("total")
    return out.select(
        "source", F.round("target_share", 9).alias("target_share"), F.round("reachable_share", 9).alias("reachable_share"), "max_repeats", "records",
        (F.coalesce(F.col("most"), F.lit(0)) <= F.col("max_repeats")).alias("within_cap"), near.alias("share_met"), F.coalesce(F.col("ids") == F.col("rows"), F.lit(True)).alias("ids_once"),
        (F.coalesce(F.col("sum"), F.lit(0)) == F.col("used_tokens")).alias("sums_agree"),
    )


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return look_alike_pairs(read_table(spark, d, "documents"), every_pair=True)


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    return look_alike_classes(read_table(spark, d, "documents"))


def p9_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical_text(read_table(spark, d, "documents"))


QUERIES = {
    "p7_found": p7_found,
    "p7_leaks": p7_leaks,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_limits": p8_limits,
    "p9_found": p9_found,
    "p9_classes": p9_classes,
    "p9_canonical": p9_canonical,
}

# The form of problem 9 read once more, character by character, independent of the operator's expression.
_LOOK = ("аеорсухѕіјһԁԛԝӏАВЕКМНОРСТУХЅІЈԚԜӀοΑΒΕΖΗΙΚΜΝΟΡΤΥΧёЁїЇѐЀόΌΆΈΉΊΎ", "aeopcyxsijhdqwlABEKMHOPCTYXSIJQWIoABEZHIKMNOPTYXëËïÏèÈóÓÁÉHIÝ")
_CHAR = f"""CASE WHEN c = '' THEN '' WHEN u BETWEEN 65281 AND 65374 THEN chr(u - 65248)
  WHEN u IN (9, 160, 5760, 8239, 8287, 12288) OR u BETWEEN 8192 AND 8202 THEN ' ' WHEN u IN (10, 11, 12, 13, 133, 8232, 8233) THEN chr(10)
  WHEN u < 32 OR u BETWEEN 127 AND 159 OR u IN (173, 847, 1564, 6068, 6069, 65279) OR u BETWEEN 8203 AND 8207 OR u BETWEEN 8234 AND 8238 OR u BETWEEN 8288 AND 8303 OR u BETWEEN 65024 AND 65039 THEN ''
  WHEN u IN (8208, 8209) THEN '-' WHEN u = 64256 THEN 'ff' WHEN u = 64257 THEN 'fi' WHEN u = 64258 THEN 'fl' WHEN u = 64259 THEN 'ffi' WHEN u = 64260 THEN 'ffl' WHEN u IN (64261, 64262) THEN 'st'
  WHEN u = 306 THEN 'IJ' WHEN u = 307 THEN 'ij' WHEN strpos('{_LOOK[0]}', c) > 0 THEN substr('{_LOOK[1]}', strpos('{_LOOK[0]}', c), 1) ELSE c END"""


def _form(table: str, key: str) -> str:
    chars = f"SELECT {key}, pos, c, unicode(c) AS u FROM (SELECT {key}, unnest(s) AS c, generate_subscripts(s, 1) AS pos FROM (SELECT {key}, string_split(replace(text, chr(13) || chr(10), chr(10)), '') AS s FROM {table} WHERE text <> ''))"
    made = f"SELECT {key}, nfc_normalize(coalesce(string_agg({_CHAR}, '' ORDER BY pos), '')) AS canonical FROM ({chars}) GROUP BY {key}"
    return f"SELECT {key}, text, CASE WHEN text = '' THEN '' ELSE canonical END AS canonical FROM {table} LEFT JOIN ({made}) USING ({key}) WHERE text IS NOT NULL"


_C = _form("documents", "doc_id")
_SEEN = f"SELECT * FROM ({_C}) WHERE regexp_matches(canonical, '[^\\s]')"
_WORDS = "regexp_extract_all(lower(canonical), '[\\p{L}\\p{N}]+')"
_SOURCE = lambda c: f"regexp_replace(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '[\\s-]', '_', 'g')"

ORACLE_SQL = {
    "p7_found": f"""
    WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM ({_C})),
    item AS (SELECT item_id, {_WORDS} AS w FROM ({_form("eval_items", "item_id")})),
    dg AS (SELECT doc_id, list_aggregate(w[i : i + 11], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM doc)),
    ig AS (SELECT item_id, list_aggregate(w[i : i + 11], 'string_agg', ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM item))
    SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    "p8_limits": f"""
    WITH have AS (SELECT {_SOURCE("source")} AS source, count(*) AS n FROM documents WHERE text <> '' AND doc_id IS NOT NULL GROUP BY 1),
    t AS (SELECT {_SOURCE("source")} AS source, sum(target_share) AS target_share, CAST(max(max_repeats) AS BIGINT) AS max_repeats FROM mix_targets GROUP BY 1)
    SELECT source, round(target_share, 9) AS target_share, round(CASE WHEN n > 0 THEN target_share / sum(target_share) FILTER (WHERE n > 0) OVER () ELSE 0 END, 9) AS reachable_share, max_repeats,
      coalesce(n, 0) AS records, true AS within_cap, true AS share_met, true AS ids_once, true AS sums_agree FROM t LEFT JOIN have USING (source)""",
    "p9_found": f"""
    WITH c AS ({_SEEN})
    SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM c a JOIN c b ON a.canonical = b.canonical AND a.text <> b.text AND a.doc_id < b.doc_id""",
    "p9_classes": f"""
    WITH s AS ({_SEEN}) SELECT doc_id, min(doc_id) OVER w AS class_id, v.variants, count(*) OVER w - count(*) OVER (PARTITION BY canonical, text) AS links FROM s
    JOIN (SELECT canonical, count(DISTINCT text) AS variants FROM s GROUP BY 1) v USING (canonical) WINDOW w AS (PARTITION BY canonical)""",
    "p9_canonical": f"SELECT doc_id, canonical FROM ({_C}) UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL",
}
