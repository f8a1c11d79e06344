"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from acreage.llm.common import whole_text

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for with this "
    "le la les de des du et un une que qui est dans pour "
    "der die das und ist von mit den ein eine zu nicht "
    "el los las y en que del por con una para se"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure of the text and the closed range in which it is accepted; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The base rules: enough words, and not more than half of them in repeated windows.
BASE = (Rule("few_words", "n_words", low=50), Rule("repeated_words", "repeat_percent", high=50))

#: The further rules; each measure is a column of :func:`measures`.
RULES = (
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("stop_words", "stop_word_ratio", low=0.01),
    Rule("repeated_lines", "dup_line_ratio", high=0.6),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("open_lines", "ellipsis_line_ratio", high=0.5),
)


def _unused(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has, for columns that are needed on the way only."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def _split(df: DataFrame, text: str, p: str) -> DataFrame:
    """Words, their hashes, lines with a word: each array is a column of its own, so that it is made once a row."""
    t = df.withColumn(p + "t", whole_text(text))
    t = t.withColumn(p + "w", F.filter(F.split(_without(F.col(p + "t"), BLANKS[1:], " "), " "), lambda x: x != ""))
    t = t.withColumn(p + "l", F.filter(F.split(p + "t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    t = t.withColumn(p + "h", F.transform(p + "w", lambda x: F.xxhash64(x)))
    windows = F.transform(p + "h", lambda x, i: F.xxhash64(x, F.get(p + "h", i + 1), F.get(p + "h", i + 2)))
    return t.withColumn(p + "g", F.slice(windows, 1, F.greatest(F.lit(0), F.size(p + "h") - 2)))


def _without(text: Column, chars: str, by: str = "") -> Column:
    """Each of a few characters replaced, one plain search after the other: far cheaper than a pattern."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _repeat_words(windows: str) -> Column:
    """Words inside windows found twice or more: sort (window, place), keep those with an equal neighbour, and add up the places.

    Work is n log n for each text, however often a window is found; texts without a repeated window skip the sort.
    """
    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

    def places(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        F.get(F.transform(F.array(ordered), places), F.lit(0)),
        start,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered).otherwise(F.lit(0)).cast("long")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` with the measures that rules can name. No shuffle: a row is measured where it is read."""
    own, p = df.columns, _unused(df)
    t = _split(df, text, p)
    t = (
        t.withColumn("n_words", F.size(p + "w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join(p + "w", "")).cast("long"))
        .withColumn("n_symbols", (F.length(p + "t") - F.length(_without(F.col(p + "t"), SYMBOLS))).cast("long"))
        .withColumn("n_lines", F.size(p + "l").cast("long"))
        .withColumn("n_dup_lines", (F.size(p + "l") - F.size(F.array_distinct(p + "l"))).cast("long"))
        .withColumn("n_repeat_words", _repeat_words(p + "g"))
        .withColumn(p + "stop", F.size(F.filter(p + "w", lambda x: x.isin(STOP_WORDS))))
        .withColumn(p + "bullet", F.size(F.filter(p + "l", lambda x: F.ltrim(x).rlike("^[-*•]"))))
        .withColumn(p + "open", F.size(F.filter(p + "l", lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)\\z"))))
    )
    n, lines = F.col("n_words"), F.col("n_lines")
    made = {
        "repeat_percent": _ratio(100 * F.col("n_repeat_words"), n),
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbols_per_word": _ratio(F.col("n_symbols"), n),
        "stop_word_ratio": _ratio(F.col(p + "stop"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), lines),
        "bullet_line_ratio": _ratio(F.col(p + "bullet"), lines),
        "ellipsis_line_ratio": _ratio(F.col(p + "open"), lines),
    }
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    return t.select(*[F.col(f"`{c}`") for c in own if c not in counts and c not in made], *counts, *[v.alias(k) for k, v in made.items()])


def failed(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a measured row breaks, as an array: the table compiled into one expression."""
    def broken(r: Rule) -> Column:
        m, out = F.col(r.measure), F.lit(False)
        if r.low is not None:
            out = out | (m < r.low)
        if r.high is not None:
            out = out | (m > r.high)
        return F.when(out, F.lit(r.name))

    return F.array_compact(F.array(*[broken(r) for r in rules])) if rules else F.array().cast("array<string>")


def judge(df: DataFrame, text: str = "text", base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with its measures, ``failed_rules``, ``base_failed`` and ``kept``.

    A null text counts as empty, so it fails the base rules; an empty table gives an empty one. Input columns stay, but for
    those with the name of a measure or a verdict, which are replaced. Repeated rows are judged alike, each for itself.
    """
    made = ["failed_rules", "base_failed", "kept"]
    m = measures(df.drop(*[c for c in made if c in df.columns]), text)
    p = _unused(m)
    m = m.withColumn(p + "base", failed(base)).withColumn(p + "more", failed(rules))
    return (
        m.withColumn("failed_rules", F.concat(p + "base", p + "more"))
        .withColumn("base_failed", F.size(p + "base") > 0)
        .withColumn("kept", F.size("failed_rules") == 0)
        .drop(p + "base", p + "more")
    )


def only_kept(df: DataFrame, text: str = "text", base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that are kept, with its columns as they are.

    The row id takes part in the condition because Spark moves no filter below it: moved down, the verdict would be written out
    in terms of the text, each measure as often as it is used, and planning would not end.
    """
    judged = judge(df.select(F.struct("*").alias("_own"), F.col(text).alias("_text")), "_text", base, rules)
    judged = judged.withColumn("_id", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("_id") >= 0)).select("_own.*")
