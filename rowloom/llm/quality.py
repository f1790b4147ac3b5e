"""Quality rules: a threshold table compiled into one projection.

``measures`` adds counts of a text (words, characters, symbols, stop words, lines,
repetition) as built-in expressions, and ``compile_rules`` turns rows of the table
``(name, numerator, denominator, low, high)`` into one boolean per rule.  A rule holds
when low <= 1000 * numerator / denominator <= high, compared as whole numbers, so no
rounding is involved.  Stop words and word lengths tell something of languages they were
chosen for only: rules marked ``listed`` abstain (hold) where over ``FOREIGN`` thousandths of
the characters in words are letters outside the alphabets of the stop-word lists, such as
Polish, Russian or Chinese text.  Lists, alphabets and rules are parameters; a language in
plain letters without a list (Dutch, say) needs one.  Everything is one scan with projections: no shuffle, no user
function, nothing kept between rows.

Defined cases: a null or empty text has zero words and fails by length; texts of any
length are read whole; repeated rows are judged alike; an empty table gives an empty
result; other columns of the input are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import text_of, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
#: Thousandths of foreign letters beyond which rules marked ``listed`` abstain.
FOREIGN = 20

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be as with by this at are from an or have not "
    "le la les de des du un une et en que qui dans pour par sur est au avec ne "
    "der die das und zu den von mit ist im ein eine auf des dem sich nicht auch als "
    "el los las del y se por con para una su al lo como es no"
).split()

#: Letters of those languages, both cases.
ALPHABET = "abcdefghijklmnopqrstuvwxyzàâäæáçéèêëíîïñóôöœßùûüúÿABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÆÁÇÉÈÊËÍÎÏÑÓÔÖŒẞÙÛÜÚŸ"


class Rule(NamedTuple):
    """low <= 1000 * numerator / (denominator - spare) <= high; None leaves a side open.

    The first ``spare`` units of the denominator ask for nothing, so a low share grows steadily
    from there on.  A ``listed`` rule abstains outside the alphabets of the stop-word lists.
    """

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    spare: int = 0
    listed: bool = False


#: The production table, in thousandths.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2000, 12000, listed=True),
    Rule("symbols", "n_symbols", "n_words", None, 100),
    # Clean headings and lists of one or two lines often have no stop word at all: 30 words ask for none.
    Rule("stop_words", "n_stop_words", "n_words", 60, None, spare=30, listed=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 300),
    Rule("shouted_words", "n_shouted", "n_words", None, 300),
)


def foreign_letters(alphabet: str = ALPHABET) -> str:
    """Pattern of a letter outside an alphabet."""
    return rf"[^\P{{L}}{alphabet}]"


def measures(
    df: DataFrame,
    keep: Sequence[str | Column] = (),
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
    alphabet: str = ALPHABET,
) -> DataFrame:
    """``keep`` plus the counts of every text; stop words in lower case, and the letters they are written in."""
    own = "__q_"
    rows = df.select(*keep, text_of(text).alias(own + "text"))
    rows = rows.select(
        "*",
        words_of(F.col(own + "text")).alias(own + "words"),
        F.filter(F.split(own + "text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(own + "lines"),
    )
    words, lines = F.col(own + "words"), F.col(own + "lines")
    # Equal windows have equal hashes: only texts with an equal pair are looked at exactly.
    hashes = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.withColumn(own + "hashes", hashes)
    repeats = F.size(F.array_distinct(own + "hashes")) < F.size(own + "hashes")
    windows = F.transform(
        F.slice(words, 1, F.size(words) - (WINDOW - 1)),
        lambda w, i: F.struct(
            F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, WINDOW)]).alias("w"), i.alias("at")
        ),
    )
    rows = rows.withColumn(own + "sorted", F.when(repeats, F.array_sort(windows)))
    ordered = F.col(own + "sorted")
    twice = F.filter(
        ordered,
        lambda x, i: F.coalesce(x["w"] == F.get(ordered, i - 1)["w"], F.lit(False))
        | F.coalesce(x["w"] == F.get(ordered, i + 1)["w"], F.lit(False)),
    )
    rows = rows.withColumn(own + "at", F.array_sort(F.transform(twice, lambda x: x["at"])))
    at = F.col(own + "at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    stop = F.filter(words, lambda w: F.lower(w).isin(list(stop_words)))
    shouted = F.filter(words, lambda w: w.endswith("!!"))
    as_long = lambda c, name: c.cast("long").alias(name)
    kept = rows.columns[: len(keep)]
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        as_long(F.size(words), "n_words"),
        as_long(F.length(F.array_join(words, "")), "word_chars"),
        as_long(
            F.length(own + "text") - F.length(F.regexp_replace(own + "text", SYMBOLS, "")), "n_symbols"
        ),
        as_long(F.size(lines), "n_lines"),
        as_long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
        as_long(F.coalesce(covered, F.lit(0)), "n_repeat_words"),
        as_long(F.size(stop), "n_stop_words"),
        as_long(F.size(shouted), "n_shouted"),
        as_long(F.length(own + "text") - F.length(F.regexp_replace(own + "text", foreign_letters(alphabet), "")), "n_foreign"),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * n)


def compile_rules(rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """One boolean column per rule: does the text pass it?"""
    out = {}
    for rule in rules:
        part, whole = 1000 * F.col(rule.numerator), F.col(rule.denominator)
        if rule.spare:
            whole = F.greatest(whole - rule.spare, F.lit(0))
        passed = F.lit(True)
        if rule.low is not None:
            passed &= part >= rule.low * whole
        if rule.high is not None:
            passed &= part <= rule.high * whole
        if rule.listed:
            passed |= 1000 * F.col("n_foreign") > FOREIGN * F.col("word_chars")
        out[rule.name] = passed
    return out


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds base_failed, kept and failed_rules (names, in table order)."""
    passed = compile_rules(rules)
    every = F.lit(True)
    for verdict in passed.values():
        every &= verdict
    names = F.array_compact(F.array(*[F.when(~v, F.lit(n)) for n, v in passed.items()]))
    return measured.withColumns(
        {"base_failed": base_failed(), "kept": ~base_failed() & every, "failed_rules": names.cast("array<string>")}
    )


def keep_good(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    stop_words: Sequence[str] = STOP_WORDS,
    alphabet: str = ALPHABET,
) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns only.

    The columns travel as one struct, so names of the counts cannot clash with them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__q_row")
    judged = judge(measures(df, [row], text, stop_words, alphabet), rules)
    # A plain filter on ``kept`` would be pushed down with all counts written out in it, again and again.
    kept = judged.select(F.explode_outer(F.when(F.col("kept"), F.array("__q_row"))).alias("__q_row"))
    return kept.where("__q_row is not null").select(*[F.col("__q_row")[c].alias(c) for c in df.columns])
