"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    decontamination,
    lm_scoring,
    near_duplicates,
    packing,
    periodic_runs,
    quality_rules,
    repeated_phrases,
    sharding,
    spelling,
    suffix_arrays,
    token_counts,
    toxicity,
    url_rules,
)
from tidewatch.llm.common import BLANK_RUN, shared_folder

SHARDS = [f"shard-{i:02d}" for i in range(64)]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op1_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_phrases.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op4_nearest_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_walk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rates",
    )


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False, with_text=True)


def op6_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard_no", "shard")


def op11_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache of this run starts empty, so that every different text is encoded."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_path(), shared_folder(spark, "token-counts"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which every tenth, by the crc32 of the id, repeats its words from some word on.

    With h the checksum and g a tenth of it, word a + i becomes word a + i % p
    of the n words, where a = g % n and p = 1 + (n - a) / (3 + g % 8). Texts
    without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words").cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    words = F.filter(F.split("text", BLANK_RUN), lambda w: w != "")
    chosen = docs.select("doc_id", F.col("text"), F.when(h % 10 == 0, words).alias("words"))
    tail = F.slice("words", a.cast("int") + 1, p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    planted = F.concat(F.slice("words", F.lit(1), a.cast("int")), F.flatten(F.array_repeat(tail, times)))
    text = F.when(F.size("words") > 0, F.array_join(F.slice(planted, F.lit(1), n.cast("int")), " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.select(
        "doc_id", "n_words", "runs", "collapsed",
        F.when(F.size("runs") > 0, longest).alias("longest"), F.concat_ws("\n", lines, F.array(F.lit(""))).alias("lines"),
    )
    start, length, period = -F.col("longest.col2"), F.col("longest.length"), -F.col("longest.col3")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        _sha256(F.when(F.size("runs") > 0, F.col("lines")).otherwise("")).alias("runs_sha256"),
        _sha256(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), spoiled=97)


QUERIES: dict[str, Query] = {
    "op1_gated_lm": op1_gated_lm,
    "op2_repeated_phrases": op2_repeated_phrases,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_nearest_toxic": op4_nearest_toxic,
    "op5_adaptive_quality": op5_adaptive_quality,
    "op6_shard_lookup": op6_shard_lookup,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_url_rules": op8_url_rules,
    "op9_suffix_arrays": op9_suffix_arrays,
    "op10_walk_decontamination": op10_walk_decontamination,
    "op11_digest_cache": op11_digest_cache,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

_LOWER = f"translate({{}}, '{url_rules.UPPER}', '{url_rules.LOWER}')"


def _listed_sql(column: int) -> str:
    """CASE over the listed rules, longest first; column 0: the rule, 1: its verdict."""
    order = sorted(url_rules.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    cases = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{(host + path, says)[column]}'"
        for host, path, says in order
    )
    return f"CASE {cases} END"


_URLS = f"""WITH RECURSIVE urls AS (
  SELECT page_id, url,
    coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_distinct(list_filter(string_split_regex({_LOWER.format("coalesce(url, '')")}, '[^a-z0-9]+'),
      lambda x: regexp_matches(x, '[a-z]'))) AS tokens
  FROM pages),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
labelled AS (SELECT row_number() OVER () AS nr, tokens, bad FROM urls JOIN marks ON page_id = doc_id),
least AS (
  SELECT greatest({url_rules.MIN_PAGES}, ceil(CAST({url_rules.MIN_SUPPORT} AS DOUBLE) * count(*))) AS pages FROM labelled),
single AS (SELECT nr, bad, unnest(tokens) AS token FROM labelled),
held AS (
  SELECT nr, bad, [token] AS needed, token AS last FROM single
  UNION ALL
  SELECT held.nr, held.bad, list_append(needed, token), token FROM held JOIN single ON single.nr = held.nr AND token > last),
sets AS (SELECT needed, count(*) AS n, count(*) FILTER (WHERE bad) AS k FROM held GROUP BY needed),
rules AS (SELECT needed FROM sets, least WHERE k >= pages AND k >= CAST({url_rules.MIN_CONFIDENCE} AS DOUBLE) * n),
judged AS (
  SELECT page_id, host, path, {_listed_sql(0)} AS rule, {_listed_sql(1)} AS says,
    EXISTS (SELECT 1 FROM rules WHERE list_has_all(tokens, needed)) AS mined
  FROM urls)
"""

ORACLES: dict[str, str] = {
    "op8_url_rules": _URLS + """SELECT page_id, host, path, rule,
      coalesce(says, CASE WHEN mined THEN 'block' ELSE 'allow' END) AS verdict, mined FROM judged""",
}
