"""Quality rules whose thresholds adapt to each language and source.

Each rule measures one quantity per document. Quantile sketches (KLL) of every quantity are built
per language and source and merged upwards to languages and to the whole corpus. From its group's
quantiles a document gets the fence ``median + spread * max(upper - median, step)`` and is rejected
where a quantity lies above the fence. The group alone sets the fence; the small ``step`` is the
scale only where a quantity hardly varies, as symbols do where nobody writes any. The ``upper``
quantile defaults to 0.75: a quarter of a group would have to be junk before its fence moves into the
junk. Quantities that are zero in nearly all documents but not in all good ones take their scale
from a farther quantile.

A group sets a rule's fence if it has ``least`` documents and ``tail`` of them above the rule's
quantile; otherwise the language does, on the same terms, and else the corpus.

Only documents that pass the fixed base rules enter the sketches, so rejected ones shift nothing.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; null
``lang`` and ``source`` are groups of their own; each row is judged on its own, also where rows
repeat; other columns pass through, except that columns named like a result are replaced; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import NOT_SPACE_CLASS, SPACE_CLASS, SPACES, sheltered
from rollbook.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Sketch size; ranks are right to about 0.3 percent, which the far quantiles need.
SKETCH = 800
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``value`` is over the measures of a document; documents far above their group fall.

    ``step`` is the least scale. Without a quantile and spread of its own a rule takes the caller's.
    """

    name: str
    value: Column
    step: float
    upper: float | None = None
    spread: float | None = None


def default_rules() -> tuple[Rule, ...]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return (
        Rule("symbol_rate", F.col("n_symbols") / words, 0.002),
        Rule("shout_rate", F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)), 0.002),
        Rule("stutter_rate", F.col("n_stutters") / words, 0.002),
        Rule("word_length", F.col("word_chars") / words, 0.02),
        Rule("no_letter_rate", F.col("n_no_letter") / words, 0.01),
        Rule("dup_line_rate", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.002, 0.99, 3.0),
    )


def _repeat_words(hashes: Column) -> Column:
    """Words inside the windows whose hash occurs twice or more.

    The windows are sorted by hash, repeated ones are neighbours then; their sorted places tell
    how many words they cover together. That is n log n also for one very long document.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW),
        lambda i: F.struct(
            F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")
        ),
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(hashes) <= WINDOW, none).otherwise(F.sort_array(windows))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of every document as long columns, each from the whole text."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Each step is a projection of its own and used more than once after it.
    step = docs.select(
        *[c for c in docs.columns if c not in _OWN],
        whole.alias("_whole"),
        F.filter(F.split(whole, SPACE_CLASS + "+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(NOT_SPACE_CLASS)).alias("_lines"),
    )
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    step = step.withColumn("_sorted", _repeat_words(F.col("_hashes")))
    size = F.size("_sorted")
    twice = F.filter(
        F.transform(
            "_sorted",
            lambda x, i: F.when(
                (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]),
                x["i"],
            ),
        ),
        lambda p: p.isNotNull(),
    )
    step = step.withColumn("_places", F.when(size > 0, F.sort_array(twice)).otherwise(F.array().cast("array<int>")))
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, i: F.least(F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b.cast("bigint"),
    )
    bare = F.translate("_whole", SPACES, "")
    return step.select(
        *[c for c in docs.columns if c not in _OWN],
        F.size("_words").cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("_whole") - F.length(F.translate("_whole", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_whole", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.filter("_hashes", lambda h, i: h == F.get("_hashes", i - 1))).cast("long").alias("n_stutters"),
        F.size(F.filter("_words", lambda w: ~w.rlike(r"\p{L}"))).cast("long").alias("n_no_letter"),
    )


RESULTS = (*MEASURES, "n_lines", "n_upper", "n_stutters", "n_no_letter", "base_failed", "kept")
_OWN = (*RESULTS, "_whole", "_words", "_lines", "_hashes", "_sorted", "_places")


def base_failed(least_words: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")
    )


def _sketches(measured: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per language and source: the count and a sketch of every rule's value.

    The partial sketches of a hot group are merged, so a reducer gets one per map task.
    """
    return measured.where(~F.col("base_failed")).groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(r.value.cast("double"), SKETCH).alias(r.name) for r in rules],
    )


def thresholds(
    sketches: DataFrame, rules: tuple[Rule, ...], upper: float, spread: float, least: int = 1, tail: int = 0
) -> DataFrame:
    """The fences of each row of sketches; null where it has too few documents for a rule."""
    fences = []
    for rule in rules:
        at = upper if rule.upper is None else rule.upper
        middle = F.kll_sketch_get_quantile_double(rule.name, F.lit(0.5))
        high = F.kll_sketch_get_quantile_double(rule.name, F.lit(at))
        scale = F.greatest(high - middle, F.lit(rule.step))
        enough = (F.col("n") >= max(least, 1)) & (F.col("n") * (1 - at) >= tail)
        fences.append(F.when(enough, middle + (spread if rule.spread is None else rule.spread) * scale).alias(rule.name))
    return sketches.select(*[c for c in ("lang", "source", "n") if c in sketches.columns], *fences)


def quality_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    upper: float = 0.75,
    spread: float = 16.0,
    least: int = 50,
    tail: int = 12,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``; without the text unless asked."""
    rules = rules or default_rules()
    for name in ("lang", "source"):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    slim, restore = sheltered(docs, "lang", "source", "text")
    # Written once: the sketches and the filter both read the numbers, not the texts.
    measured = measure(slim).withColumn("base_failed", base_failed())
    dropped = () if keep_text else ("text",)
    measured = written(measured.drop(*dropped), "quality-measures")
    by_group = written(_sketches(measured, rules), "quality-sketches")
    merged = [F.kll_merge_agg_double(r.name).alias(r.name) for r in rules]
    by_lang = by_group.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    over_all = by_group.agg(F.sum("n").alias("n"), *merged)
    everywhere = thresholds(over_all, rules, upper, spread).first()  # one row of numbers
    own = thresholds(by_group, rules, upper, spread, least, tail)
    lang = thresholds(by_lang, rules, upper, spread, least, tail)
    names = [r.name for r in rules]
    own = own.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.struct(*names).alias("_own"))
    lang = lang.select(F.col("lang").alias("_k"), F.struct(*names).alias("_lang"))
    joined = measured.join(
        own, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left"
    ).join(lang, F.col("lang").eqNullSafe(F.col("_k")), "left")
    passed = F.lit(True)
    for rule in rules:
        last = everywhere[rule.name]
        fence = F.coalesce(f"_own.{rule.name}", f"_lang.{rule.name}", F.lit(float("inf") if last is None else last))
        passed &= rule.value.cast("double") <= fence
    out = joined.select(*measured.columns, (~F.col("base_failed") & passed).alias("kept"))
    return restore(out if keep_text else out.withColumn("text", F.lit(None)), *RESULTS).drop(*dropped)
