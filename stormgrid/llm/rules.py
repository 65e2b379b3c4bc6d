"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule names a measure and the range in which it must lie, from a number of
words on. Measures and verdict are one projection of built-in functions over the
text: no shuffle, no user function. Measures of a text that holds lists (words,
lines, five-word windows) are computed once and bound to lambda variables.

Defined results: null, empty and blank texts have no words, all measures 0 and
fail; equal rows are judged alike; very long texts are measured whole, in time
proportional to n log n; columns named like a measure are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.common import let

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of to and a in is it that was for on are as with be by this from or an at not "
    "le la les de des du et un une est en que qui dans pour pas par sur au avec "
    "der die das und ist ein eine zu den von mit auf als nicht auch für im in dem es "
    "el los las y del se con una su al lo para por"
).split()

BLANK = r"[ \t-\r]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    measure: str
    low: float | None = None
    high: float | None = None
    #: Texts of fewer words pass.
    from_words: int = 0


#: The base check and the thresholds beyond it.
BASE_RULES = [Rule("n_words", low=10), Rule("repeat_ratio", high=0.2)]
RULES = [
    Rule("mean_word_chars", low=2.0, high=16.0),
    Rule("symbol_ratio", high=0.25),
    Rule("capital_ratio", high=0.5),
    Rule("dup_line_ratio", high=0.5),
    Rule("stop_word_ratio", low=0.02, from_words=50),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))


def repeated_neighbours(ordered: Column) -> Column:
    return F.size(F.filter(ordered, lambda x, i: F.coalesce(F.get(ordered, i - 1) == x, F.lit(False))))


def words_in_repeats(words: Column, window: int = WINDOW) -> Column:
    """Words that lie inside windows found twice or more.

    Windows are compared by 64-bit hashes. Only a text that has equal ones sorts
    them by hash and place; the places of repeated windows, in order, then add
    what each covers beyond the one before.
    """
    def covered(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - 1)
        pairs = F.sort_array(F.zip_with(hashes, places, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))

        def total(ordered: Column) -> Column:
            same = lambda x, other: F.coalesce(F.get(ordered, other)["h"] == x["h"], F.lit(False))
            repeated = F.transform(F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"])
            start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
            step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n"))
            return F.aggregate(F.sort_array(repeated), start, step, lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, total))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(hashes, covered))


def measures(text: Column) -> Column:
    """A struct of counts and ratios of a text."""
    whole = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        lines = let(F.sort_array(lines_of(whole)), lambda s: F.struct(F.size(s).alias("n"), repeated_neighbours(s).alias("same")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            words_in_repeats(words).cast("long").alias("n_repeat_words"),
            lines.alias("lines"),
        )

    return let(words_of(whole), of)


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def verdict(rules: list[Rule], values: dict[str, Column]) -> Column:
    """True if every measure lies in its range, bounds included."""
    passed = F.lit(True)
    for rule in rules:
        value = values[rule.measure]
        if rule.low is not None:
            passed = passed & ((value >= rule.low) | (values["n_words"] < rule.from_words))
        if rule.high is not None:
            passed = passed & ((value <= rule.high) | (values["n_words"] < rule.from_words))
    return passed


def judge(docs: DataFrame, text: str = "text", base: list[Rule] = BASE_RULES, rules: list[Rule] = RULES) -> DataFrame:
    """All columns of `docs` with the measures, base_failed and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stop_words", "base_failed", "kept"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    m = F.col("__m")
    values = {c: m[c] for c in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_capitals", "n_stop_words")}
    values |= {"n_lines": m["lines"]["n"].cast("long"), "n_dup_lines": m["lines"]["same"].cast("long")}
    values |= {
        "mean_word_chars": ratio(values["word_chars"], values["n_words"]),
        "symbol_ratio": ratio(values["n_symbols"], values["n_words"]),
        "capital_ratio": ratio(values["n_capitals"], values["word_chars"]),
        "stop_word_ratio": ratio(values["n_stop_words"], values["n_words"]),
        "dup_line_ratio": ratio(values["n_dup_lines"], values["n_lines"]),
        "repeat_ratio": ratio(values["n_repeat_words"], values["n_words"]),
    }
    measured = docs.select(*kept, measures(F.col(f"`{text}`")).alias("__m"))
    failed = ~verdict(base, values)
    return measured.select(
        *kept, *[values[n].alias(n) for n in names[:8]], failed.alias("base_failed"), (~failed & verdict(rules, values)).alias("kept")
    )
