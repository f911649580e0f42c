"""Quality rules: a threshold table compiled into one projection.

Every rule bounds a count of a text per hundred of another count: word length,
symbols, stop words, lines. The table becomes one row-wise projection of built-in
functions; nothing is shuffled and no user function runs.

Defined cases: a NULL text counts as empty. A text without words has zero counts
and fails, as every text of fewer than ``LEAST_WORDS`` words does. Repeated rows
keep their rows, NULL and repeated ids are passed through, an empty table gives
no rows. Texts of any length are measured whole, in time that grows as n log n.
Columns other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # of 100 words

# Frequent function words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au".split(),
    "es": "de la que el en y los se del las un por con no su una para es al lo".split(),
}


@dataclass(frozen=True)
class Threshold:
    """``measure`` must be ``low`` to ``high`` for every 100 of ``per``; an open end is None."""

    name: str
    measure: str
    per: str
    low: int | None = None
    high: int | None = None

    def breaks(self, value: Callable[[str], Column]) -> Column:
        scaled, per = value(self.measure) * 100, value(self.per)
        below = scaled < per * self.low if self.low is not None else F.lit(False)
        above = scaled > per * self.high if self.high is not None else F.lit(False)
        return below | above


TABLE = (
    Threshold("word_length", "word_chars", "n_words", 300, 1000),
    Threshold("symbols", "n_symbols", "n_words", high=10),
    Threshold("exclamations", "n_exclamations", "n_words", high=30),
    Threshold("letters", "n_letter_words", "n_words", low=60),
    Threshold("stop_words", "n_stop_words", "n_words", low=5),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", high=40),
    Threshold("bullets", "n_bullet_lines", "n_lines", high=90),
    Threshold("ellipses", "n_ellipsis_lines", "n_lines", high=30),
)


def bound_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(starts: Column) -> Column:
    """Places covered by windows of ``WINDOW`` places at the given ascending starts."""
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts, first,
        lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"],
    )


def _repeated_starts(grams: Column) -> Column:
    """Ascending places of the windows that occur twice or more: equal ones are neighbours once sorted."""
    def pairs(s: Column) -> Column:
        n = F.size(s) - 1
        equal = F.filter(
            F.arrays_zip(F.slice(s, F.lit(1), n).alias("x"), F.slice(s, F.lit(2), n).alias("y")),
            lambda z: z["x"]["gram"] == z["y"]["gram"],
        )
        return F.array_distinct(F.flatten(F.transform(equal, lambda z: F.array(z["x"]["at"], z["y"]["at"]))))

    placed = F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at")))
    return F.sort_array(bound_once(F.sort_array(placed), pairs))


def repeated_words(words: Column) -> Column:
    """Words inside windows of five words that the text holds twice or more, the first included."""
    def of(w: Column) -> Column:
        # Words hold no blanks, so joined windows are equal only if their words are.
        grams = F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(WINDOW)), " ")
        )
        return bound_once(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), _covered(_repeated_starts(g))).otherwise(0))

    return bound_once(words, lambda w: F.when(F.size(w) > WINDOW, of(w)).otherwise(0)).cast("long")


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts by name. ``lines`` are those that hold a word."""
    stop = sorted({w for group in STOP_WORDS.values() for w in group})
    terms = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"{LETTER}+"), F.lit(0))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(LETTER))),
        "n_stop_words": F.size(F.filter(terms, lambda t: t.isin(stop))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
        "n_repeat_words": repeated_words(words),
    }
    return {name: count.cast("long") for name, count in counts.items()}


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: tuple[Threshold, ...] = TABLE,
) -> DataFrame:
    """One row per document: id, the counts, ``base_failed``, ``kept`` and the names of the broken rules."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col), text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    counts = measures(F.col("text"), F.col("words"), F.col("lines"))
    counted = split.select(id_col, *(c.alias(name) for name, c in counts.items()))
    short = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    broken = F.concat_ws(",", *(F.when(t.breaks(F.col), t.name) for t in table))
    return counted.select(
        id_col, *counts, short.alias("base_failed"), (~short & (broken == "")).alias("kept"), broken.alias("broken_rules"),
    )
