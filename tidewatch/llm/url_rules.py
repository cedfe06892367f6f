"""Filtering of URLs by host and path rules and by token combinations mined from labelled pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: The least share of the labelled pages, and the least number, that a combination and the bad label must share.
MIN_SUPPORT, MIN_PAGES = 0.002, 20
MIN_CONFIDENCE = 0.6
#: A rule of more tokens is left out where one of at most so many, all of them its own, is a rule and fits its pages.
SHORT = 3
BAD = "\x00bad"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct runs of letters and digits that hold a letter."""
    parts = F.split(lower_ascii(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.filter(parts, lambda x: x.rlike("[a-z]")))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does. Rules of one length go by name."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(own_path))
        rule = F.when(fits, F.lit(own_host + own_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def labelled_tokens(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens and bad of each page that has a label: low quality or toxic, by any of its label rows."""
    bad = labels.filter(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").alias("_labelled")
    ).agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad"))
    urls = pages.select("page_id", tokens_of(F.col("url")).alias("tokens"))
    return urls.join(bad, urls["page_id"] == bad["_labelled"]).select("tokens", "bad")


def mine(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_pages: int = MIN_PAGES,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules (tokens, n_bad, n_pages, confidence) of any size: pages with all the tokens are bad often enough.

    FP-growth counts the combinations over all labelled pages. Tokens that no
    rule can hold, for want of support, are removed before, by one count.
    """
    spark = pages.sparkSession
    rows = labelled_tokens(pages, labels)
    total = rows.count()
    least = max(min_pages, -int(-min_support * total // 1))
    frequent = rows.filter("bad").select(F.explode("tokens").alias("token")).groupBy("token").count().filter(
        F.col("count") >= least
    )
    schema = "tokens array<string>, n_bad long, n_pages long, confidence double"
    # at most one token in 1 / min_support has the support, times the tokens of a URL
    common = [r["token"] for r in frequent.collect()]
    if not common:
        return spark.createDataFrame([], schema)
    kept = F.filter("tokens", lambda t: t.isin(common))
    baskets = rows.select(F.when(F.col("bad"), F.array_append(kept, F.lit(BAD))).otherwise(kept).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=0.0).fit(baskets)
    sets = model.freqItemsets
    with_bad = sets.filter(F.array_contains("items", BAD)).select(
        F.sort_array(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("n_bad")
    ).filter(F.size("tokens") > 0)
    without = sets.filter(~F.array_contains("items", BAD)).select(
        F.sort_array("items").alias("tokens"), F.col("freq").alias("n_pages")
    )
    rules = with_bad.join(without, "tokens").withColumn("confidence", F.col("n_bad") / F.col("n_pages"))
    rules = stored(rules.filter(F.col("confidence") >= min_confidence), "url-rules")
    short = rules.filter(F.size("tokens") <= SHORT).select(F.col("tokens")[0].alias("_one"), F.col("tokens").alias("_part"))
    longer = rules.filter(F.size("tokens") > SHORT).select("tokens", F.explode("tokens").alias("_one"))
    said = longer.join(short, "_one").filter(F.size(F.array_except("_part", "tokens")) == 0).select("tokens").distinct()
    return rules.join(said, "tokens", "left_anti").select("tokens", "n_bad", "n_pages", "confidence")


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id and url_hash of the pages that hold all tokens of some rule.

    The index lists each rule under the token of it that the fewest pages hold,
    so that no token which nearly every page has is looked up; a page is
    compared with the rules found under its tokens.
    """
    own = pages.select("page_id", F.xxhash64("url").alias("url_hash"), tokens_of(F.col("url")).alias("tokens"))
    needed = rules.select(F.col("tokens").alias("needed"), F.explode("tokens").alias("token"))
    held = own.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("pages"))
    rarest = F.min(F.struct(F.coalesce("pages", F.lit(0)).alias("pages"), "token"))["token"]
    index = needed.join(held, "token", "left").groupBy("needed").agg(rarest.alias("token"))
    looked_up = own.select("*", F.explode("tokens").alias("token")).join(index, "token")
    holds = F.size(F.array_except("needed", "tokens")) == 0
    return looked_up.filter(holds).select("page_id", "url_hash").distinct()


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **limits: float
) -> DataFrame:
    """page_id, host, path, rule, verdict and mined (a mined rule matches) of every page.

    A listed rule decides; else a page is blocked if a mined rule matches, and
    allowed if none does. A null URL, or one without ://, has an empty host
    and path; tokens are still looked up. Repeated rows are judged alike.
    Without labels nothing is mined. Other columns are not read.
    """
    urls = pages.select("page_id", "url", F.xxhash64("url").alias("url_hash"))
    hits = matched(urls, mine(urls, labels, **limits)).select(
        F.col("page_id").alias("_page"), F.col("url_hash").alias("_hash")
    )
    on = urls["page_id"].eqNullSafe(hits["_page"]) & (urls["url_hash"] == hits["_hash"])
    split = urls.join(hits, on, "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("_hash").isNotNull().alias("mined"),
    )
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    return split.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined",
    )
