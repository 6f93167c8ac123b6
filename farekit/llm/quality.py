"""Quality rules whose cutoffs are certified on labelled documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farekit.llm.chance import binomial_at_most
from farekit.llm.columns import without, words
from farekit.session import stage

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
MOST_REPEATED = 0.5

# At most this share of good documents is rejected in a stratum, with this confidence for all strata and rules at once.
RISK = 0.02
ERROR = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject where ``count`` per word reaches a cutoff; the cutoffs are tried from the laxest (first) on."""

    name: str
    count: str
    cutoffs: tuple[float, ...]

    @property
    def value(self) -> Column:
        return F.try_divide(F.col(self.count), F.col("n_words"))


RULES = (
    Rule("symbols_per_word", "n_symbols", (2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    Rule("repeated_share", "n_repeat_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("dup_lines_per_word", "n_dup_lines", (0.2, 0.15, 0.1, 0.075, 0.05, 0.025)),
    Rule("chars_per_word", "word_chars", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
)


def _repeated_words(tokens: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more; ``tokens`` must be a stored column."""
    last = F.size(tokens) - 3
    places = F.sequence(F.lit(0), last)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def with_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, replacing columns of these names.

    A null text counts as empty: all are 0. Repeated windows are found by
    sorting the window hashes of one text. Only a text in which two are equal
    goes on to sort them with their places.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    split = (
        without(docs, *COUNTS)
        .withColumn("__words", words(F.col("text")))
        .withColumn("__hashes", _repeated_words(F.col("__words")))
        .withColumn("__sorted", F.array_sort("__hashes"))
    )
    ordered = F.col("__sorted")
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    placed = F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = (
        split.withColumn("__placed", F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
        .withColumn(
            "__starts",
            F.sort_array(
                F.transform(
                    F.filter(
                        "__placed",
                        lambda x, k: (x["h"] == F.get("__placed", k + 1)["h"]) | (x["h"] == F.get("__placed", k - 1)["h"]),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
    )
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")) != "")
    symbols = sum((F.length(body) - F.length(F.replace(body, F.lit(c))) for c in SYMBOLS), F.lit(0))
    counts = {
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": covered,
    }
    # Generated columns, so that a later filter on a count isn't moved below and doesn't repeat the whole computation.
    numbers = F.inline(F.array(F.struct(*[value.alias(name) for name, value in counts.items()])))
    kept = [c for c in marked.columns if not c.startswith("__") or c in docs.columns]
    return marked.withColumn("__lines", lines).select(*[F.col(f"`{c}`") for c in kept], numbers)


def base_failed() -> Column:
    """Too short, or mostly repeated windows; the same for every stratum and certified by nothing."""
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 100 * MOST_REPEATED * F.col("n_words"))


def certified_cutoffs(
    counted: DataFrame, labels: DataFrame, *, stratum: str = "lang", risk: float = RISK, error: float = ERROR
) -> DataFrame:
    """The cutoff of each rule in each stratum: (stratum, rule, cutoff, n_good, false_rejections, p_value).

    The holdout is every document with a quality label that passes the base
    rules. For each stratum and rule the cutoffs are tested from the laxest on.
    The hypothesis "this rule rejects more than risk / rules of the good
    documents" is refuted when so few false rejections would have probability
    error / (strata x rules) or less under it: the exact binomial bound, with
    Bonferroni's correction over strata and rules. Within one rule the order is
    fixed, so testing stops at the first cutoff that fails and needs no further
    correction. With probability 1 - error, no stratum loses more than ``risk``
    of its good documents to all rules together.

    Of the certified cutoffs the strictest is used, provided that it rejects
    more labelled bad documents than good ones; else the rule stays off in the
    stratum. Strata without enough labels have no row. A null stratum is one.
    Documents with several labels count once for each, ids that are null
    never. Each labelled row becomes one row per rule, summed before the
    shuffle; the tests run on one row per stratum, rule and cutoff.
    """
    tests = RULES
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"))
    passed = counted.where(~base_failed()).select("doc_id", F.col(stratum).alias("stratum"), *COUNTS)
    holdout = passed.join(known, F.col("doc_id") == F.col("__id"))
    reached = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            sum((F.coalesce(rule.value >= cutoff, F.lit(False)).cast("int") for cutoff in rule.cutoffs), F.lit(0)).alias("reached"),
        )
        for rule in tests
    ]
    counts = (
        holdout.select("stratum", "__quality", F.inline(F.array(*reached)))
        .groupBy("stratum", "rule", "reached")
        .agg(F.count_if(F.col("__quality") == 1).alias("good"), F.count_if(F.col("__quality") == 0).alias("bad"))
    )
    counts = stage(counts, "quality-counts")
    grid = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.lit(i + 1).alias("step"), F.lit(cutoff).alias("cutoff"))
            for rule in tests
            for i, cutoff in enumerate(rule.cutoffs)
        ]
    )
    steps = counts.select("stratum").distinct().select("stratum", F.inline(grid))
    # A document that reaches ``reached`` cutoffs is rejected at the steps len - reached + 1 .. len: the lax ones come first.
    lengths = F.create_map(*[x for rule in tests for x in (F.lit(rule.name), F.lit(len(rule.cutoffs)))])
    rejected = (
        steps.withColumnsRenamed({"stratum": "__s", "rule": "__r"})
        .join(counts, F.col("__s").eqNullSafe(F.col("stratum")) & (F.col("__r") == F.col("rule")))
        .groupBy("stratum", "rule", "step", "cutoff")
        .agg(
            F.sum("good").alias("n_good"),
            F.sum(F.when(F.col("step") > lengths[F.col("rule")] - F.col("reached"), F.col("good")).otherwise(0)).alias("false_rejections"),
            F.sum(F.when(F.col("step") > lengths[F.col("rule")] - F.col("reached"), F.col("bad")).otherwise(0)).alias("true_rejections"),
        )
    )
    strata = rejected.select(F.count_distinct(F.struct("stratum"))).scalar()
    tested = rejected.withColumn(
        "p_value", binomial_at_most(F.col("false_rejections"), F.col("n_good"), risk / len(tests))
    ).withColumn("passes", F.col("p_value") <= F.lit(error) / (strata * len(tests)))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    certified = tested.withColumn("certified", F.min("passes").over(so_far)).where("certified")
    useful = certified.where(F.col("true_rejections") > F.col("false_rejections"))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("step"))
    return (
        useful.withColumn("__best", F.row_number().over(best))
        .where("__best = 1")
        .select("stratum", "rule", "cutoff", "n_good", "false_rejections", "true_rejections", "p_value")
    )


def judged(counted: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang") -> DataFrame:
    """Documents from ``with_counts`` with base_failed, kept and failed_rules (names), replacing such columns.

    ``kept`` is false if the base rules fail, or if a rule reaches the cutoff
    that ``certified_cutoffs`` has for the document's stratum. An empty table
    stays empty; without cutoffs only the base rules decide.
    """
    tests = RULES
    wide = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(
        *[F.max(F.when(F.col("rule") == rule.name, F.col("cutoff"))).alias(f"__{rule.name}") for rule in tests]
    )
    wide = stage(wide, "quality-strata")
    joined = without(counted, "base_failed", "kept", "failed_rules").join(
        wide, F.col(stratum).eqNullSafe(F.col("__stratum")), "left"
    )
    failed = F.array_compact(
        F.array(*[F.when(rule.value >= F.col(f"__{rule.name}"), F.lit(rule.name)) for rule in tests])
    )
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop("__stratum", *[f"__{rule.name}" for rule in tests])
    )
