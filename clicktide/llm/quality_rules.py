"""Quality rules whose cutoffs follow the data: quantile sketches per language and source.

DataFrame functions only. One pass measures every text and writes the measures, a few
numbers a row. KLL sketches of each measure are built per (lang, source), with partial
sketches before the shuffle, and merged to sketches per language and of all texts. From
a sketch follow the cutoffs: quartiles widened by ``SPREADS`` times their distance, which
is never taken as less than the measure's ``least`` spread, so that a group of texts
without any symbol does not refuse the first one that has some. A (lang, source) of fewer
than ``MIN_GROUP`` texts takes the cutoffs of its language, and that in turn those of all
texts. The cutoffs are joined to the measures by (lang, source) and decide each row.

A null text has no words, like an empty one: ``n_words`` 0, refused by the fixed base rule
of at least ten words. A null lang or source is a group of its own. Repeated rows are
measured each, and ``kept`` alike. Texts of any length are measured whole. A measure equal
to a cutoff is kept. Texts refused by the base rules don't count for cutoffs. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import BLANKS, computed_once, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SKETCH_K = 400
MIN_GROUP = 100
SPREADS = 4.0
GROUP_BY = ("lang", "source")


@dataclass(frozen=True)
class Measure:
    """A number per text with the least spread that its cutoffs assume; sides with a cutoff."""

    name: str
    least: float
    low: bool = False
    high: bool = True


MEASURES = (
    Measure("symbols_per_char", least=0.02),
    Measure("dup_lines_per_line", least=0.05),
    Measure("repeats_per_word", least=0.02),
    Measure("chars_per_word", least=0.5, low=True),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS, -1), lambda word: word != "")


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more; windows start at each word."""

    def of_sorted(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        repeated = F.filter(
            F.transform(
                ordered,
                lambda one, i: F.when(
                    ((i > 0) & (one["hash"] == F.get(ordered, i - 1)["hash"]))
                    | ((i < last) & (one["hash"] == F.get(ordered, i + 1)["hash"])),
                    one["at"],
                ),
            ),
            lambda at: at.isNotNull(),
        )

        def steps(starts: Column) -> Column:
            gaps = F.transform(
                starts,
                lambda at, i: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))
                ),
            )
            return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

        return computed_once(F.array_sort(repeated), steps)

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    return computed_once(F.array_sort(placed), of_sorted)


def repeated_words(words: Column) -> Column:
    """Words in five-word windows that the text has twice or more, the first included."""

    def of_hashes(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        windows = F.transform(
            starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW)))
        )
        return computed_once(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w)),
        )

    found = computed_once(F.transform(words, lambda word: F.xxhash64(word)), of_hashes)
    return F.when(F.size(words) > WINDOW, found).otherwise(0)


def measured(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, the group columns and the base measures of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = texts.select(
        F.col(key).alias("key"),
        *(F.col(name).alias(name) for name in GROUP_BY),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace(text, BLANKS, "")).alias("word_chars"),
    )
    return rows.select(
        "key",
        *GROUP_BY,
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def with_rates(rows: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and the rates that the cutoffs are about (0 without words)."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return rows.withColumns({
        "base_failed": failed,
        "symbols_per_char": rate("n_symbols", "word_chars"),
        "dup_lines_per_line": rate("n_dup_lines", "n_lines"),
        "repeats_per_word": rate("n_repeat_words", "n_words"),
        "chars_per_word": rate("word_chars", "n_words"),
    })


def _cutoffs(sketches: DataFrame, suffix: str) -> DataFrame:
    """Of each group of sketches its size and its cutoffs as columns."""

    def quantile(measure: Measure, rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(F.col(measure.name), F.lit(rank))

    columns = [F.col("texts").alias(f"texts_{suffix}")]
    for m in MEASURES:
        q25, q75 = quantile(m, 0.25), quantile(m, 0.75)
        wide = SPREADS * F.greatest(q75 - q25, F.lit(m.least))
        if m.low:
            columns.append((q25 - wide).alias(f"low_{m.name}_{suffix}"))
        if m.high:
            columns.append((q75 + wide).alias(f"high_{m.name}_{suffix}"))
    groups = [name for name in GROUP_BY if name in sketches.columns]
    return sketches.select(*groups, *columns)


def cutoffs(rates: DataFrame) -> DataFrame:
    """Per (lang, source) its cutoffs, from the smallest enclosing group that is large enough."""
    sound = rates.where(~F.col("base_failed"))
    by_source = written(
        sound.groupBy(*GROUP_BY).agg(
            F.count("*").alias("texts"),
            *(F.kll_sketch_agg_double(m.name, F.lit(SKETCH_K)).alias(m.name) for m in MEASURES),
        ),
        "quality-sketches",
    )

    def merged(by: list[str]) -> DataFrame:
        return by_source.groupBy(*by).agg(
            F.sum("texts").alias("texts"),
            *(F.kll_merge_agg_double(m.name, F.lit(SKETCH_K)).alias(m.name) for m in MEASURES),
        ).where("texts > 0")

    lang = F.col("lang").alias("of_lang")
    own = _cutoffs(by_source, "own")
    of_lang = _cutoffs(merged(["lang"]), "lang").withColumn("of_lang", lang).drop("lang")
    of_all = _cutoffs(merged([]), "all")
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").join(
        of_all, F.lit(True), "left"
    )
    bounds = [f"{side}_{m.name}" for m in MEASURES for side in ("low", "high") if getattr(m, side)]
    return joined.select(
        *(F.col(name).alias(f"group_{name}") for name in GROUP_BY),
        *(
            F.when(F.col("texts_own") >= MIN_GROUP, F.col(f"{bound}_own"))
            .when(F.col("texts_lang") >= MIN_GROUP, F.col(f"{bound}_lang"))
            .otherwise(F.col(f"{bound}_all"))
            .alias(bound)
            for bound in bounds
        ),
    )


def quality_rules(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """The key, the base measures, ``base_failed``, ``kept`` and the rates that decided."""
    rates = with_rates(written(measured(texts, key), "quality-measures"))
    bounds = written(cutoffs(rates), "quality-cutoffs")
    same_group = [F.col(n).eqNullSafe(F.col(f"group_{n}")) for n in GROUP_BY]
    joined = rates.join(bounds, same_group, "left")
    within = F.lit(True)
    for m in MEASURES:
        if m.low:
            within &= F.col(m.name) >= F.col(f"low_{m.name}")
        if m.high:
            within &= F.col(m.name) <= F.col(f"high_{m.name}")
    return joined.select(
        F.col("key").alias(key),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
        # a group without sound texts has no cutoffs, and no row that needs them
        (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"),
        *(m.name for m in MEASURES),
    )
