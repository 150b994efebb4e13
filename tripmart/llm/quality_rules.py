"""Quality rules: a table of thresholds compiled into one projection.

Measures are built-in expressions over the whole text; nothing is shuffled and no user function
runs. A NULL text counts as one without words. A text without words fails the word rule and
passes every ratio rule (its ratios are 0). Rows are judged one by one, so ties, repeated rows
and an empty table need no care; all columns of the input stay, and a measure whose name the
input already has replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import words

WINDOW = 8
#: Frequent function words of the languages that the corpus holds.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this"),
    *("le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "en", "au", "est", "pour", "dans", "pas", "sur"),
    *("der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "ist", "ein", "eine", "nicht", "auf", "dem", "im", "als"),
    *("el", "los", "las", "y", "con", "se", "del", "por", "su", "al", "no", "es", "una", "para", "lo", "como"),
)


@dataclass(frozen=True)
class Rule:
    """Passes while ``low <= 100 * of / per <= high``; without ``per``, the bounds are of the count itself."""

    name: str
    of: str
    per: str | None = None
    low: float | None = None
    high: float | None = None
    base: bool = False


RULES = (
    Rule("words", "n_words", low=20, base=True),
    Rule("repeated_words", "n_repeat_words", per="n_words", high=30, base=True),
    Rule("word_length", "word_chars", per="n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", per="n_words", high=20),
    Rule("exclamations", "n_exclamations", per="n_words", high=20),
    Rule("stop_words", "n_stop_words", per="n_words", low=4),
    Rule("repeated_lines", "n_dup_lines", per="n_lines", high=50),
)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_exclamations``, ``n_stop_words``, ``n_lines``,
    ``n_dup_lines`` and ``n_repeat_words`` (all long)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    kept = [F.col(c) for c in docs.columns if c not in MEASURES]
    steps = docs.select(*kept, words(F.col(text)).alias("_words"), lines.alias("_lines"), whole.alias("_whole"))
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    steps = steps.select("*", F.size("_words").alias("_n"), hashed.alias("_hashes"))
    starts = F.when(F.col("_n") >= WINDOW, F.sequence(F.lit(1), F.col("_n") - (WINDOW - 1)))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, F.lit(WINDOW))))
    steps = steps.select("*", windows.alias("_windows"))
    # only a text with a repeated window pays for the sort that finds where it stands
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    steps = steps.select("*", F.when(repeats, ordered).alias("_ordered"))
    twice = F.filter(
        "_ordered",
        lambda x, i: (x["h"] == F.get("_ordered", i - 1)["h"]) | (x["h"] == F.get("_ordered", i + 1)["h"]),
    )
    places = F.array_sort(F.transform(twice, lambda x: x["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"],
    )
    counts = {
        "n_words": F.col("_n"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_whole", F.lit(r"[#*$%&|<>]")),
        "n_exclamations": F.regexp_count("_whole", F.lit("!")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    # generated, so that a filter on a measure is not rewritten into the expressions above
    found = F.inline(F.array(F.struct(*[value.cast("long").alias(name) for name, value in counts.items()])))
    return steps.select(*kept, found)


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_exclamations",
    "n_stop_words",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


def passes(rule: Rule) -> Column:
    """The rule in whole numbers where its bounds are whole."""
    value, unit = (F.col(rule.of), F.lit(1)) if rule.per is None else (100 * F.col(rule.of), F.col(rule.per))
    fine = F.lit(True)
    if rule.low is not None:
        fine &= value >= rule.low * unit
    if rule.high is not None:
        fine &= value <= rule.high * unit
    return fine if rule.per is None else (F.col(rule.per) == 0) | fine


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Add the measures, ``base_failed``, ``failed`` (names of all failed rules) and ``kept``."""
    found = measured(docs.drop("base_failed", "failed", "kept"), text)
    failed = F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull()
    )
    base = F.lit(False)
    for rule in rules:
        if rule.base:
            base |= ~passes(rule)
    return found.select("*", base.alias("base_failed"), failed.alias("failed"), (F.size(failed) == 0).alias("kept"))
