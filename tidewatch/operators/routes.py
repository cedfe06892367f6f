"""Which topic a source's lines go to, and whether the routing makes sense."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.shuffles import lookup_join


def _blank(name: str):
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def build_routes(files: DataFrame, topics: DataFrame, rotated: DataFrame | None = None) -> DataFrame:
    """Join files (name, path), topics (name, topic) and rotated (name,
    rotated_glob) into routes; entries that violate a rule are left out."""
    routes = files.filter(~_blank("path")).join(topics.filter(~_blank("topic")), "name")
    if rotated is None:
        return routes.select("name", "path", "topic", F.lit(None).cast("string").alias("rotated_glob"))
    return routes.join(rotated, "name", "left").select("name", "path", "topic", "rotated_glob")


def route_violations(
    files: DataFrame, topics: DataFrame, rotated: DataFrame | None = None
) -> DataFrame:
    """(name, problem) for every configuration entry that cannot be used."""
    no_path = files.filter(_blank("path")).select("name", F.lit("missing_path").alias("problem"))
    no_topic = files.join(topics.filter(~_blank("topic")), "name", "left_anti").select(
        "name", F.lit("missing_topic").alias("problem")
    )
    found = no_path.unionByName(no_topic)
    if rotated is None:
        return found
    unknown = rotated.join(files, "name", "left_anti").select(
        "name", F.lit("unknown_rotated").alias("problem")
    )
    bad_glob = rotated.join(files, "name", "left_semi").filter(_blank("rotated_glob")).select(
        "name", F.lit("empty_rotated").alias("problem")
    )
    return found.unionByName(unknown).unionByName(bad_glob)


def missing_topics(routes: DataFrame, existing: DataFrame) -> DataFrame:
    """Topics some route wants and the broker does not have."""
    return routes.select("topic").distinct().subtract(existing.select("topic"))


def route(lines: DataFrame, routes: DataFrame) -> DataFrame:
    """Lines with the topic of their source, ready to be written to a broker."""
    names = routes.select(F.col("name").alias("source"), "topic")
    return lookup_join(lines, names, ["source"])


def check_rollup(results: DataFrame) -> DataFrame:
    """One verdict per check (name, ok, detail rows): ok only if every part is."""
    return results.groupBy("name").agg(
        F.bool_and("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count("*").alias("parts"),
    )


def check_details(results: DataFrame) -> DataFrame:
    """The details to report per check: the failing parts, or all if none fails."""
    verdicts = check_rollup(results).select("name", F.col("ok").alias("_all_ok"))
    return (
        lookup_join(results, verdicts, ["name"])
        .filter(F.col("_all_ok") | ~F.col("ok"))
        .select("name", F.col("_all_ok").alias("ok"), "detail")
    )



def check_report(results: DataFrame) -> DataFrame:
    """One row per check with its verdict and the details to report, sorted and joined.

    A check has as many parts as the configuration names, so they fit a row.
    """
    return check_details(results).groupBy("name").agg(
        F.first("ok").alias("ok"), F.array_join(F.array_sort(F.collect_list("detail")), "; ").alias("report")
    )
