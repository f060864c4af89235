"""Quality rules whose cutoffs come from the corpus.

Every document is measured; for each language and source a quantile sketch of
each measure is kept, a count per value rounded down to its six leading bits.
Sketches merge by adding counts, so they are built by one pre-aggregated
grouping, are the same in any order of rows, hold at most about 2,000 counters
for a group however many rows it has, and give a quantile to within 1/32 of
its value. Small groups borrow: the sketches of all sources of a language, and
of all languages, are sums of the group's sketches. The cutoff of a measure is
its median plus ``SPREAD`` times the larger of its upper spread (75 % point
less median, which up to a quarter of bad rows cannot stretch) and a floor; documents join their group's cutoffs and fail beyond
any of them.

Measures, all whole numbers: symbols, repeated lines and repeated words in
thousandths of the text's characters, lines and words, and tenths of the mean
word length.

Defined results: a null text is an empty text, has no words and fails the base
rule. Null language or source is a group of its own. Ties and repeated rows
are counted once each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SPACE_RUN, bind, packed_rows, stage, text_of, unpacked_rows, without_spaces

WINDOW_WORDS = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: A group with fewer rows takes the cutoffs of its language, then of the whole corpus.
LEAST_ROWS = 200
#: The cutoff lies this many upper spreads above the median.
SPREAD = 4
#: Least upper spread of each measure, so that a group without variation doesn't reject small deviations.
FLOORS = {"symbol_rate": 10, "dup_line_rate": 75, "repeat_rate": 75, "word_length": 10}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Positions covered by windows of eight words that occur more than once in the text.

    Windows are compared by a 64-bit hash of their word hashes. Most texts have
    no window twice, which a distinct count shows; only for the others are the
    windows sorted, equal neighbours marked and the covered positions summed.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = lambda h, n: F.transform(
        F.sequence(F.lit(0), n - WINDOW_WORDS), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW_WORDS)])
    )

    def covered(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, k: (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(F.lit(True))
                | (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(F.lit(True)),
            )
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        starts = bind(pairs, marked)
        return bind(
            starts,
            lambda p: F.aggregate(
                F.transform(
                    p, lambda x, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW_WORDS)))
                ),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    zero = F.lit(0).cast("bigint")
    return F.when(F.size(words) <= WINDOW_WORDS, zero).otherwise(
        bind(
            bind(hashes, lambda h: windows(h, F.size(h))),
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(covered(w)),
        )
    )


def measure(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    bare = F.length(without_spaces(F.col("_t"))).cast("bigint")
    symbols = F.col("_t")
    for s in SYMBOLS:
        symbols = F.replace(symbols, F.lit(s), F.lit(""))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: F.length(without_spaces(x)) > 0)
    return (
        df.withColumn("_t", text_of(text))
        .withColumns({"_w": words_of(F.col("_t")), "_l": lines})
        .withColumns(
            {
                "n_words": F.size("_w").cast("bigint"),
                "word_chars": bare,
                "n_symbols": (F.length("_t") - F.length(symbols)).cast("bigint"),
                "n_lines": F.size("_l").cast("bigint"),
                "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
                "n_repeat_words": _repeat_words(F.col("_w")),
            }
        )
        .drop("_t", "_w", "_l")
    )


def rates() -> dict[str, Column]:
    """The measures as whole numbers, from the counted columns."""
    part = lambda a, b, unit: F.coalesce(F.expr(f"{a} * {unit} DIV nullif({b}, 0)"), F.lit(0).cast("bigint"))
    return {
        "symbol_rate": part("n_symbols", "word_chars", 1000),
        "dup_line_rate": part("n_dup_lines", "n_lines", 1000),
        "repeat_rate": part("n_repeat_words", "n_words", 1000),
        "word_length": part("word_chars", "n_words", 10),
    }


def bucket(value: Column) -> Column:
    """The value with all but its six leading bits cleared."""
    spare = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(measured: DataFrame) -> DataFrame:
    """Counters (lang, source, measure, bucket, rows); adding the rows of equal counters merges sketches."""
    counts = measured.groupBy("lang", "source", *[bucket(F.col(m)).alias(m) for m in FLOORS]).count()
    unpivoted = counts.select(
        "lang",
        "source",
        "count",
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("bucket")) for m in FLOORS])).alias("c"),
    )
    return unpivoted.groupBy("lang", "source", F.col("c.measure").alias("measure"), F.col("c.bucket").alias("bucket")).agg(
        F.sum("count").alias("rows")
    )


def _cut(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Cutoff and rows of each measure for one level of grouping; a group has a bounded number of counters."""
    each = Window.partitionBy(*keys, "measure")
    upto = each.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    floor = F.create_map(*[F.lit(x) for item in FLOORS.items() for x in item])
    ranked = sketch.withColumns({"n": F.sum("rows").over(each), "below": F.sum("rows").over(upto)})
    point = lambda percent: F.min(F.when(F.col("below") * 100 >= F.col("n") * percent, F.col("bucket")))
    points = ranked.groupBy(*keys, "measure").agg(F.max("n").alias("n"), point(50).alias("mid"), point(75).alias("high"))
    return points.withColumn("cut", F.col("mid") + SPREAD * F.greatest(F.col("high") - F.col("mid"), floor[F.col("measure")]))


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row per language and source with a cutoff for each measure.

    The coarser sketches are sums of the finer ones, so the documents are not read again.
    """
    by_language = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("rows").alias("rows"))
    overall = by_language.groupBy("measure", "bucket").agg(F.sum("rows").alias("rows"))
    fine = _cut(sketch, ["lang", "source"])
    middle = _cut(by_language, ["lang"]).select(
        F.col("lang").alias("lang2"), F.col("measure").alias("m2"), F.col("cut").alias("cut2"), F.col("n").alias("n2")
    )
    coarse = _cut(overall, []).select(F.col("measure").alias("m3"), F.col("cut").alias("cut3"))
    chosen = (
        F.when(F.col("n") >= LEAST_ROWS, F.col("cut")).when(F.col("n2") >= LEAST_ROWS, F.col("cut2")).otherwise(F.col("cut3"))
    )
    return (
        fine.join(middle, F.col("lang").eqNullSafe(F.col("lang2")) & (F.col("measure") == F.col("m2")))
        .join(coarse, F.col("measure") == F.col("m3"))
        .groupBy(F.col("lang").alias("cut_lang"), F.col("source").alias("cut_source"))
        .agg(*[F.max(F.when(F.col("measure") == m, chosen)).alias(f"cut_{m}") for m in FLOORS])
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judged(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """``measured``, which has the rates, with base_failed and kept; the planner broadcasts the cutoffs if they are small."""
    beyond = F.lit(False)
    for m in FLOORS:
        beyond = beyond | (F.col(m) > F.col(f"cut_{m}"))
    joined = measured.join(
        cuts, F.col("lang").eqNullSafe(F.col("cut_lang")) & F.col("source").eqNullSafe(F.col("cut_source")), "left"
    )
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))
    )


def _measured(df: DataFrame, text: Column) -> DataFrame:
    return measure(df, text).withColumns(rates())


def quality_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the counts, the rates, the cutoffs of its group and the verdict."""
    measured = stage(_measured(docs.select("doc_id", "lang", "source", "text"), F.col("text")).drop("text"), "measured")
    cuts = stage(cutoffs(sketches(measured)), "cutoffs")
    return judged(measured, cuts).drop("cut_lang", "cut_source")


def good_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; texts are measured twice rather than stored again."""
    slim = docs.select("lang", "source", "text")
    cuts = stage(cutoffs(sketches(_measured(slim, F.col("text")))), "cutoffs")
    rows = packed_rows(docs).withColumns({c: F.col("row").getField(c) for c in ("lang", "source")})
    return unpacked_rows(judged(_measured(rows, F.col("row.text")), cuts).filter("kept"))
