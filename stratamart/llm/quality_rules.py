"""Quality rules: a table of thresholds compiled into one projection of Spark's own functions.

A rule bounds the ratio of two counts of a text. All counts are expressions
over the text column; nothing is moved, and no user function runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

WORD = rf"[^{SPACE}]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as this by at are from or an "
    "der die und das den von zu mit des im ist nicht ein eine sich auf für dem als "
    "de la le et les un une est en que pour dans du qui sur au pas avec "
    "el los y por con se las del al lo su para es no una más"
).split()


@dataclass(frozen=True)
class Rule:
    """``low`` <= 100 * ``count`` / ``per`` <= ``high``, for texts of ``from_words`` words or more."""

    name: str
    count: str
    per: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0

    def broken(self) -> Column:
        found, whole = 100 * F.col(self.count), F.col(self.per)
        outside = F.lit(False)
        if self.low is not None:
            outside |= found < self.low * whole
        if self.high is not None:
            outside |= found > self.high * whole
        return outside & (F.col("n_words") >= self.from_words)


# Ratios in hundredths. A base rule is part of ``base_failed``.
BASE_LEAST_WORDS = 10
BASE_MOST_REPEATED = 20
RULES = (
    Rule("mean word length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols per word", "n_symbols", "n_words", high=10),
    Rule("stop words", "n_stop_words", "n_words", low=2, from_words=50),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=30, from_words=50),
    Rule("lines cut short", "n_cut_lines", "n_lines", high=30, from_words=50),
)


def _window_hashes(words: str, hashes: str) -> Column:
    """Hashes of all windows of five words; none for a shorter text."""
    last = F.size(words) - WINDOW
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """How many words the windows at these ascending places cover together."""
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("free"))
    return F.aggregate(
        starts,
        state,
        lambda s, at: F.struct(
            (s["n"] + at + WINDOW - F.greatest(at, s["free"])).alias("n"),
            (at + WINDOW).alias("free"),
        ),
        lambda s: s["n"],
    )


def with_counts(docs: DataFrame, carry: Column | str = "doc_id") -> DataFrame:
    """One carried column, n_words, and every count that a rule names, per row of ``docs``.

    Windows are compared by 64-bit hashes within one text. They are sorted only
    in texts in which one repeats.
    """
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        F.col(carry).alias(carry) if isinstance(carry, str) else carry,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    hashed = words.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashed.select("*", _window_hashes("words", "hashes").alias("windows"))
    no_pairs = F.array().cast("array<struct<h:bigint,at:int>>")
    ordered = windows.select(
        "*",
        F.when(
            F.size("windows") > F.size(F.array_distinct("windows")),
            F.sort_array(
                F.transform("windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
            ),
        )
        .otherwise(no_pairs)
        .alias("pairs"),
    )

    def neighbour(k: Column) -> Column:
        return F.get(F.col("pairs"), k)["h"]

    repeated = F.filter(
        "pairs",
        lambda x, k: F.coalesce(neighbour(k - 1) == x["h"], F.lit(False))
        | F.coalesce(neighbour(k + 1) == x["h"], F.lit(False)),
    )
    placed = ordered.select(
        "*", F.array_sort(F.transform(repeated, lambda x: x["at"])).alias("starts")
    )
    stop_words = F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))
    cut_lines = F.filter("lines", lambda line: line.rlike(rf"(\.\.\.|…)[{SPACE}]*$"))
    return placed.select(
        words.columns[0],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("starts")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(stop_words).cast("long").alias("n_stop_words"),
        F.size(cut_lines).cast("long").alias("n_cut_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < BASE_LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MOST_REPEATED * F.col("n_words")
    )


def quality_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: Column | str = "doc_id"
) -> DataFrame:
    """The carried column, counts, ``base_failed``, the names of the rules a text breaks, and ``kept``.

    One row per row of ``docs``, repeated rows each, whatever other columns
    there are. A null text has no words, so it fails the base like an empty
    one; a null doc_id stays null; an empty table gives an empty result.
    """
    broken = F.filter(
        F.array(*[F.when(rule.broken(), rule.name) for rule in rules]), lambda x: x.isNotNull()
    )
    return (
        with_counts(docs, carry)
        .select("*", base_failed().alias("base_failed"), broken.alias("broken_rules"))
        .select("*", (~F.col("base_failed") & (F.size("broken_rules") == 0)).alias("kept"))
    )
