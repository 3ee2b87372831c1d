"""Quality rules as a short-circuit cascade.

Every rule has an expression that is true for a text to reject. On a sample each rule alone is timed and its share
of rejections counted; rules then run in the order of rejections per second, and a text rejected by one is not looked at by
the next. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT = 50, 50

SYMBOL_PERCENT = 10
DUPLICATE_LINES_PERCENT = 30
MEAN_WORD_CHARS = (2, 15)
#: Rows of the sample on which costs and selectivities are estimated, on average.
SAMPLE_ROWS = 1000
#: Up to so many distinct repeated windows are looked up one by one.
FEW_REPEATS = 32


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: an expression inside a lambda would be computed per element."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def has_word(line: Column) -> Column:
    return line.rlike(f"[^{SPACE}]")


def count_word_chars(word: Column) -> Column:
    return F.length(F.array_join(word, "")).cast("bigint")


def count_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint")


def count_duplicate_lines(text: Column) -> Column:
    return let(F.filter(F.split(text, "\n"), has_word), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def _neighbours(ordered: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of each element and the next, without nulls."""
    count = F.size(ordered)
    found = F.zip_with(F.slice(ordered, 1, count - 1), F.slice(ordered, 2, count - 1), use)
    return F.filter(found, lambda x: x.isNotNull())


def count_repeat_words(word: Column) -> Column:
    """Words in a window of three words that occurs twice or more in the text, the first occurrence included.

    Equal hashes of windows are neighbours once sorted. Texts without a repeat skip the sort; with few repeated windows
    their places are looked up, with many the hashes are sorted with their places.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(word) - 2),
        lambda i: F.xxhash64(F.element_at(word, i), F.element_at(word, i + 1), F.element_at(word, i + 2)))

    def covered(first: Column) -> Column:
        words_in = F.flatten(F.transform(first, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(words_in)).cast("bigint")

    def looked_up(hashes: Column, repeated: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return covered(F.filter(at, lambda i: i.isNotNull()))

    def sorted_places(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return covered(let(pairs, lambda p: F.array_distinct(F.flatten(_neighbours(
            p, lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))))))

    def repeats(hashes: Column) -> Column:
        repeated = let(F.sort_array(hashes), lambda s: F.array_distinct(_neighbours(s, lambda x, y: F.when(x == y, x))))
        return let(repeated, lambda r: F.when(F.size(r) <= FEW_REPEATS, looked_up(hashes, r)).otherwise(sorted_places(hashes)))

    none = F.lit(0).cast("bigint")
    return F.when(F.size(word) < 4, none).otherwise(let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeats(h))))


def measures(text: Column, word: Column) -> dict[str, Column]:
    return {
        "n_words": F.size(word).cast("bigint"),
        "word_chars": count_word_chars(word),
        "n_symbols": count_symbols(text),
        "n_dup_lines": count_duplicate_lines(text),
        "n_repeat_words": count_repeat_words(word),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the text and its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _few_words(text: Column, word: Column) -> Column:
    return F.size(word) < LEAST_WORDS


def _repeats(text: Column, word: Column) -> Column:
    return 100 * count_repeat_words(word) > REPEAT_PERCENT * F.size(word)


def _symbols(text: Column, word: Column) -> Column:
    return 100 * count_symbols(text) > SYMBOL_PERCENT * count_word_chars(word)


def _duplicate_lines(text: Column, word: Column) -> Column:
    lines = F.size(F.filter(F.split(text, "\n"), has_word))
    return 100 * count_duplicate_lines(text) > DUPLICATE_LINES_PERCENT * lines


def _word_lengths(text: Column, word: Column) -> Column:
    chars = count_word_chars(word)
    return (chars < MEAN_WORD_CHARS[0] * F.size(word)) | (chars > MEAN_WORD_CHARS[1] * F.size(word))


BASE_RULES = (Rule("few_words", _few_words), Rule("repeats", _repeats))
RULES = (*BASE_RULES, Rule("symbols", _symbols), Rule("duplicate_lines", _duplicate_lines), Rule("word_lengths", _word_lengths))


def _worded(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("__text", text).withColumn("__word", words(F.col("__text")))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Time and share of rejections of each rule on a sample, best order first.

    The words are there before any rule, so their cost is measured alone and taken off.
    """
    total = docs.count()
    if not total:
        return [Estimate(rule, 0.0, 0.0) for rule in rules]
    seen = docs.select("text").sample(min(1.0, sample_rows / total), seed=7)
    sample = _worded(seen.repartition(1)).cache()
    rows = max(1, sample.count())

    def timed(rejects: Column) -> tuple[float, int]:
        begin = time.perf_counter()
        found = sample.agg(F.count_if(rejects)).first()[0]
        return time.perf_counter() - begin, found

    timed(F.lit(False))
    floor = min(timed(F.lit(False))[0] for _ in range(2))
    found = []
    for rule in rules:
        rejects = rule.rejects(F.col("__text"), F.col("__word"))
        seconds, rejected = min(timed(rejects) for _ in range(2))
        found.append(Estimate(rule, max(seconds - floor, 1e-4), rejected / rows))
    sample.unpersist()
    return sorted(found, key=lambda e: (-e.rejected / e.seconds, e.seconds))


def cascade(text: Column, word: Column, ordered: Sequence[Rule]) -> Column:
    """False from the first rule that rejects, else true; later branches of a CASE are not evaluated."""
    out = None
    for rule in ordered:
        rejects = F.coalesce(rule.rejects(text, word), F.lit(False))
        out = F.when(rejects, False) if out is None else out.when(rejects, False)
    return F.lit(True) if out is None else out.otherwise(True)


def with_words(use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the text and its words, both computed once per row wherever the optimizer moves the expression."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return let(text, lambda t: let(words(t), lambda w: use(t, w)))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``; other columns are ignored) ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``.

    A null text has no words and fails. Rows are judged one by one, so repeated rows give repeated results; an empty table
    gives none. The measures of the base rules are given, so those rules read them instead of running again.
    """
    ordered = [e.rule for e in estimate(docs, rules) if e.rule not in BASE_RULES]

    def all_of(text: Column, word: Column) -> Column:
        def verdict(m: Column) -> Column:
            failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
            kept = F.when(failed, False).otherwise(cascade(text, word, ordered))
            return F.struct(*[m[name].alias(name) for name in names], failed.alias("base_failed"), kept.alias("kept"))

        measured = measures(text, word)
        names = list(measured)
        return let(F.struct(*[c.alias(name) for name, c in measured.items()]), verdict)

    return docs.select("doc_id", with_words(all_of).alias("__found")).select("doc_id", "__found.*")


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects, by the cascade alone."""
    ordered = [e.rule for e in estimate(docs, rules)]
    return docs.filter(with_words(lambda text, word: cascade(text, word, ordered)))
