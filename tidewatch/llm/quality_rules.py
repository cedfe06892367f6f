"""Quality rules whose thresholds come from the corpus: quantile sketches for each language and source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.json_text import computed_once
from tidewatch.llm.common import BLANK_RUN, BLANKS, stored, texts_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
#: Size parameter of the sketches: ranks are right within about 0.5 %.
SKETCH_K = 800
#: Limits lie this many spreads beyond the quarter of the documents on their side of the median.
FENCE = 6.0
#: Part of the way from the median to the far quantile that is allowed at least, and that quantile.
REACH, FAR = 0.5, 0.999
#: Where the middle of a group is all alike, the quantile up to which its documents are kept.
ALIKE = 0.98
#: Documents from which on a group's own middle, and its own far quantile, are taken; below, those of the
#: wider group are, the last of which is all documents.
LEAST_MIDDLE, LEAST_FAR = 20, 4000

#: Rates that are judged, and the sides on which they can be bad.
RATES = {
    "symbols_per_word": (1,),
    "chars_per_word": (1, -1),
    "dup_line_share": (1,),
    "repeat_share": (1,),
    "capital_share": (1, -1),
    "mark_share": (1,),
}


def _repeat_words() -> Column:
    """Words in three-word windows that occur twice or more, from the windows sorted by hash and position."""
    placed = F.col("_placed")
    same = F.filter(
        F.transform(
            placed,
            lambda x, i: F.when(
                ((i > 0) & (x["h"] == placed[F.greatest(i - 1, F.lit(0))]["h"]))
                | ((i < F.size(placed) - 1) & (x["h"] == placed[F.least(i + 1, F.size(placed) - 1)]["h"])),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    return F.size(F.array_distinct(F.flatten(F.transform(same, lambda i: F.array(i, i + 1, i + 2)))))


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """The base columns of each document; a null text has no words.

    They are evaluated once for a row, whatever filters and rates are put on them.
    """
    words = texts_of(docs, *more).withColumn("_words", F.array_remove(F.split("text", BLANK_RUN), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    counted = words.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate("text", BLANKS, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        "n_capitals": (F.length("text") - F.length(F.regexp_replace("text", "\\p{Lu}", ""))).cast("long"),
        "n_marks": (F.length("text") - F.length(F.translate("text", "!?", ""))).cast("long"),
        "_lines": lines,
        "_grams": F.when(
            F.size("_words") > 2,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - 3),
                lambda i: F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2]),
            ),
        ).otherwise(F.array().cast("array<long>")),
    }).drop("text", "_words")
    repeated = counted.withColumn("_distinct", F.size(F.array_distinct("_grams"))).withColumn(
        "_placed",
        F.when(
            F.col("_distinct") < F.size("_grams"),
            F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    known = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_marks"]
    once = computed_once(repeated.select(
        "doc_id", *more, *known, "_lines", "_placed"
    ), **{
        **{f"_own_{c}": F.col(c) for c in known},
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_placed").isNull(), 0).otherwise(_repeat_words()).cast("long"),
    })
    return once.select(
        "doc_id", *more, *[F.col(f"_own_{c}").alias(c) for c in known], "n_lines", "n_dup_lines", "n_repeat_words"
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rates() -> dict[str, Column]:
    """What the thresholds are about; null for a document without words."""
    words, chars = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("word_chars"), F.lit(0))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "chars_per_word": F.col("word_chars") / words,
        "dup_line_share": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)),
        "repeat_share": F.col("n_repeat_words") / words,
        "capital_share": F.col("n_capitals") / chars,
        "mark_share": F.col("n_marks") / chars,
    }


def sketches(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One quantile sketch for each group and rate.

    Tasks make partial sketches and only these are shuffled, so a group with
    a third of all rows costs no more than another. Sketches of several
    corpora can be merged with merge_sketches().
    """
    return rows.groupBy(*groups).agg(
        F.count("*").alias("n_docs"),
        *[F.kll_sketch_agg_double(F.col(rate), SKETCH_K).alias(rate) for rate in RATES],
    )


def merge_sketches(tables: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    return union.groupBy(*groups).agg(
        F.sum("n_docs").alias("n_docs"),
        *[F.kll_merge_agg_double(F.col(rate), SKETCH_K).alias(rate) for rate in RATES],
    )


def _quantile(sketch: Column, rank: float) -> Column:
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def _limit(side: int, middle: Column, far: Column, fence: float) -> Column:
    """The limit on one side, from the sketch of the middle and that of the far quantile.

    It lies so many spreads beyond the quarter of the documents, and at least
    half-way to the far quantile, as far as that is known. A middle that is all
    alike has no spread; there the limit is a high quantile of the group, or
    half-way to the far one if junk reaches down to it.
    """
    up = lambda rank: rank if side > 0 else 1 - rank
    mid, near = _quantile(middle, 0.5), _quantile(middle, up(0.75))
    way = mid + REACH * (_quantile(far, up(FAR)) - mid)
    wide, narrow = (F.greatest, F.least) if side > 0 else (F.least, F.greatest)
    return F.when(near != mid, wide(near + fence * (near - mid), way)).otherwise(
        narrow(_quantile(middle, up(ALIKE)), way)
    )


def _name(rate: str, side: int) -> str:
    return f"_{'most' if side > 0 else 'least'}_{rate}"


def thresholds(found: DataFrame, groups: Sequence[str], fence: float = FENCE) -> DataFrame:
    """For each group the limits of each rate, from its sketch and those of the wider groups.

    Wider groups leave out the last columns one by one; their sketches are
    merged from those of the groups, so nothing is measured again.
    """
    wider = [found]
    for n in range(len(groups) - 1, -1, -1):
        names = [F.col(g).alias(f"_wide{n}_{g}") for g in groups[:n]] or [F.lit(1).alias(f"_wide{n}")]
        wider.append(found.groupBy(*names).agg(
            F.sum("n_docs").alias(f"_n{n}"),
            *[F.kll_merge_agg_double(F.col(rate), SKETCH_K).alias(f"_{rate}{n}") for rate in RATES],
        ))
    joined, pools = found, [("n_docs", "{}")]
    for n, pool in zip(range(len(groups) - 1, -1, -1), wider[1:], strict=True):
        on = F.col(f"_wide{n}") == 1 if not n else F.lit(True)
        for g in groups[:n]:
            on = on & F.col(g).eqNullSafe(F.col(f"_wide{n}_{g}"))
        joined = joined.join(F.broadcast(pool) if not n else pool, on)
        pools.append((f"_n{n}", "_{}" + str(n)))

    def chosen(rate: str, least: int) -> Column:
        """The sketch of the narrowest group with so many documents."""
        sketch = F.col(pools[-1][1].format(rate))
        for count, name in reversed(pools[:-1]):
            sketch = F.when(F.col(count) >= least, F.col(name.format(rate))).otherwise(sketch)
        return sketch

    limits = [
        _limit(side, chosen(rate, LEAST_MIDDLE), chosen(rate, LEAST_FAR), fence).alias(_name(rate, side))
        for rate, sides in RATES.items() for side in sides
    ]
    return joined.select(*[F.col(g).alias(f"_group_{g}") for g in groups], *limits)


def judge(docs: DataFrame, groups: Sequence[str] = ("lang", "source"), fence: float = FENCE) -> DataFrame:
    """A row for each document: the base columns, base_failed, kept and the rates it fails.

    Thresholds come from all documents that pass the base rules, by language
    and source; a null language or source is a group like any other. A
    document whose group has no such documents, or that has no words, is
    decided by the base rules. Repeated rows count as often as they occur;
    other columns are not read; an empty table gives no rows.
    """
    rows = stored(measured(docs, *groups), "quality").withColumns(rates()).withColumn("base_failed", base_failed())
    limits = thresholds(stored(sketches(rows.filter(~F.col("base_failed")), groups), "sketches"), groups, fence)
    same = [rows[g].eqNullSafe(limits[f"_group_{g}"]) for g in groups]
    on = same[0]
    for more in same[1:]:
        on = on & more
    failed = []
    for rate, sides in RATES.items():
        beyond = F.lit(False)
        for side in sides:
            beyond = beyond | F.coalesce((F.col(rate) - F.col(_name(rate, side))) * side > 0, F.lit(False))
        failed.append(F.when(beyond, F.lit(rate)))
    return rows.join(limits, on, "left").select(
        *rows.columns, F.array_compact(F.array(*failed)).alias("failed_rates")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rates") == 0))
