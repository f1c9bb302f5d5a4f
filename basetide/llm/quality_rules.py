"""Quality rules as one Spark projection.

A table of thresholds is compiled into boolean expressions over a few measures of a text. Everything is a
built-in function, so rows never leave the JVM and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import SPACE_PATTERN

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent short words of four languages.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "with",
              "der", "die", "das", "und", "ist", "von", "zu", "mit", "ein", "auf",
              "le", "la", "les", "de", "et", "des", "un", "une", "est", "que",
              "el", "los", "en", "y", "del", "por", "con", "una", "para", "se")


@dataclass(frozen=True)
class Rule:
    """Texts stay while ``low <= measure <= high``; an open side is None."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Ratios are per word or per line with a word; see ``measures``.
RULES = (
    Rule("mean_word_length", "word_length", 2.0, 16.0),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("symbols_per_word", "symbol_ratio", None, 0.25),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable, which the optimizer cannot inline."""
    return F.transform(F.array(value), body)[0]


def _long(c: Column) -> Column:
    return c.cast("long")


def words_in_repeats(words: Column, window: int = 3) -> Column:
    """Words covered by ``window``-word sequences that occur twice or more in the array.

    Sequences are compared by 96 hashed bits. Sorting (hash, place) pairs brings equal ones together, so the
    cost is n log n and the memory that of the text.
    """
    def keys(ws: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(ws) - window)
        return F.transform(at, lambda i: F.struct(
            F.xxhash64(*[F.get(ws, i + k) for k in range(window)]).alias("a"),
            F.hash(*[F.get(ws, i + k) for k in range(window)]).alias("b"), i.alias("i")))

    def places(pairs: Column) -> Column:
        same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"])
        hit = F.filter(pairs, lambda p, j: F.coalesce(same(p, F.get(pairs, j - 1)), F.lit(False))
                       | F.coalesce(same(p, F.get(pairs, j + 1)), F.lit(False)))
        return F.sort_array(F.transform(hit, lambda p: p["i"]))

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda i, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - i, F.lit(window))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    found = let(F.sort_array(keys(words)), lambda p: let(places(p), covered))
    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(found)


def measures(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All counts of a text as one struct: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_stop_words, n_repeat_words."""
    has_word = lambda s: F.length(F.translate(s, SPACES, "")) > 0

    def of_words(ws: Column, lines: Column) -> Column:
        stops = F.size(F.filter(ws, lambda w: F.lower(w).isin(*stop_words)))
        return F.struct(
            _long(F.size(ws)).alias("n_words"),
            _long(F.length(F.translate(text, SPACES, ""))).alias("word_chars"),
            _long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
            _long(F.size(lines)).alias("n_lines"),
            _long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            _long(stops).alias("n_stop_words"),
            words_in_repeats(ws).alias("n_repeat_words"))

    words = F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), has_word)
    return let(words, lambda ws: let(lines, lambda ln: of_words(ws, ln)))


def ratios(m: Callable[[str], Column]) -> dict[str, Column]:
    """The measures that rules refer to, from the counts."""
    per = lambda a, b: m(a) / F.greatest(m(b), F.lit(1))
    return {"n_words": m("n_words"), "word_length": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"), "stop_word_ratio": per("n_stop_words", "n_words"),
            "repeat_ratio": per("n_repeat_words", "n_words")}


def verdict(values: dict[str, Column], rules: Sequence[Rule]) -> Column:
    """The rule table as one boolean expression."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (values[r.measure] >= r.low)
        if r.high is not None:
            ok = ok & (values[r.measure] <= r.high)
    return ok


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = 50, max_repeat_percent: int = 50,
                  id_col: str = "doc_id", text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept`` behind its own columns.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of them inside
    repeated 3-word sequences. kept: not base_failed and every rule holds. A null or empty text has no word
    and fails. Every row is judged on its own, also repeated ones, whatever its id. ``prefix`` goes before
    the new names where ``docs`` has columns of that name.
    """
    m = f"_{prefix}measures"
    out = docs.withColumn(m, measures(F.coalesce(F.col(text_col), F.lit(""))))
    count = lambda name: F.col(m)[name]
    failed = (count("n_words") < min_words) | (100 * count("n_repeat_words") > max_repeat_percent * count("n_words"))
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")
    return out.select(*docs.columns, *[count(n).alias(prefix + n) for n in names], failed.alias(prefix + "base_failed"),
                      (~failed & verdict(ratios(count), rules)).alias(prefix + "kept"))
