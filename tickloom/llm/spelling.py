"""Spelling variants: words grouped around the much more frequent word that differs by one code point.

PartEnum on letter multisets: the alphabet is cut into ``PARTS`` parts, and a word is the binary vector of its letters with
their numbers of occurrence. One inserted or deleted letter changes one position of the vector, one replaced letter two, so
two words that differ so agree in all parts but one or two. The signatures of a word are its letters in every choice of parts
that may remain, and near words share at least one; candidates come from an equi-join on signatures and are verified.

A signature also holds the half of the word that one changed letter must leave as it is, the first half or the last, and the
length of the shorter word. Both are exact, and they keep groups small where many words have the same letters.

No join here is a broadcast. Spark takes the size of exploded signatures from that of the words, which is dozens of times less,
and that of words from their compressed file, a tenth of what a driver holds to broadcast them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
RUN = "[a-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Parts of the alphabet. Two may differ after a replaced letter; for an inserted or deleted one, of pairs of parts, one.
PARTS = 6
SLIP = 199
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5


def slipped(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``word`` per run of letters of the texts with at least ``least`` letters, one letter deleted where the checksum of
    document and run says so. A null doc_id reads as empty, a null text has no runs."""
    text = F.translate(F.col("text").cast("string"), UPPER, UPPER.lower())
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= least)
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    place = F.pmod(h, F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    return runs.select(F.when(F.pmod(h, F.lit(SLIP)) == 0, cut).otherwise(F.col("run")).alias("word")).filter(
        F.char_length("word") >= least)


def vocabulary(words: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that occur ``least`` times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def alphabet_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The alphabet in parts that hold about equally many letters of the words: each letter, the most frequent first, goes to
    the lightest part. Any partition gives the same result."""
    held = words.agg(*[F.sum(F.contains("word", F.lit(c)).cast("bigint")).alias(f"l{k}") for k, c in enumerate(LETTERS)]).first()
    weight, found = [0] * parts, [""] * parts
    for n, c in sorted(((held[f"l{k}"] or 0, c) for k, c in enumerate(LETTERS)), reverse=True):
        lightest = weight.index(min(weight))
        weight[lightest] += n
        found[lightest] += c
    return found


def signatures(parts: list[str], role: str) -> Column:
    """Signatures of ``word``, as an array. Those of pairs of one length are the same for ``role`` ``shorter`` and ``longer``;
    those of pairs that differ in length by one have the shorter word's length."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    length = F.char_length("word")

    def of(kind: int, left_out: tuple[str, ...], size: Column) -> list[Column]:
        rest = F.translate(letters, "".join(left_out), "")
        half = (size / 2).cast("int")
        number = F.lit(sum(ord(x[0]) << (8 * k) for k, x in enumerate(left_out) if x))
        return [F.xxhash64(F.lit(2 * kind), number, size, F.substring("word", F.lit(1), half), rest),
                F.xxhash64(F.lit(2 * kind + 1), number, size, F.substring("word", length - half + 1, half), rest)]

    replaced = [x for two in combinations(parts, 2) for x in of(0, two, length)]
    size = length if role == "shorter" else length - 1
    pairs = ["".join(parts[k:k + 2]) for k in range(0, len(parts), 2)]
    return F.array(*replaced, *[x for one in pairs for x in of(1, (one,), size)])


def near_words(words: DataFrame, parts: list[str]) -> DataFrame:
    """``word, n, other, other_n`` once per pair of ``words`` that differ by exactly one code point."""
    def signed(role: str, word: str, n: str) -> DataFrame:
        return words.select(F.explode(signatures(parts, role)).alias("signature"), F.col("word").alias(word), F.col("n").alias(n))

    one, other = signed("shorter", "word", "n"), signed("longer", "other", "other_n")
    longer = F.char_length("word") < F.char_length("other")
    ordered = longer | ((F.char_length("word") == F.char_length("other")) & (F.col("word") < F.col("other")))
    return one.join(other.hint("merge"), "signature").filter(ordered & (F.levenshtein("word", "other", 1) == 1)).select(
        "word", "n", "other", "other_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that following ``form`` from ``word`` leads to. Each round doubles the steps."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = stored(found.join(further.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if found.filter("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``; words are distinct).

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of the largest
    ``n`` if that is at least ``factor`` (2 or more) times the word's own, equal ``n`` by code-point order; else null. The
    root is where following the forms ends, the word itself without form. An empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_words(words, alphabet_parts(words)), "near")
    both = pairs.select("word", "other", "other_n").union(
        pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    has_form = -F.col("best.less") >= factor * F.col("n")
    formed = stored(words.join(near.hint("merge"), "word", "left").select(
        "word", F.when(has_form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "formed")
    rooted = roots(formed.filter("form is not null"))
    return formed.join(rooted.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame) -> DataFrame:
    """The variants among the words of ``docs`` (``doc_id, text``; other columns are ignored): runs of letters with their
    slips, of ``MIN_LENGTH`` letters and ``MIN_COUNT`` occurrences. Repeated rows count as often as they are there."""
    return variants(vocabulary(slipped(docs)))
