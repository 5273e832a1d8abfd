"""Quality rules, line first: lines that fail are removed, then documents that lose too much are rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import WORD, n_words, set_aside, whole, words_of

WINDOW = 8
ADDED = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "line_faults",
    "clean_text",
    "n_clean_words",
    "base_failed",
    "kept",
)
SYMBOLS = "[#*$%&|<>]"
SENTENCE_END = r"""[.!?…。！？]["')\]»”’]*([\x20\x09-\x0D]|$)"""
SEPARATOR = r"[|»›•·→>]"
SHORT = 200
"""Longest line, in characters, that a boilerplate phrase condemns."""
BOILERPLATE = (
    r"(?i)(all rights reserved|licen[sc]ed under|released under the|copyright|©|privacy policy"
    r"|terms (of (use|service)|and conditions)|cookies?\b.*\b(accept|use|policy|consent)|enable javascript"
    r"|subscribe to|sign (in|up)\b|log ?in\b|share this|lorem ipsum)"
)


def line_fault(line: Column) -> Column:
    """The first rule that a line breaks, or null.

    punctuation: no sentence ends in it, or a quarter of its words carry doubled
    exclamation or question marks. symbols: a tenth of its characters or more are
    markup signs. navigation: three separators or more, one for each four words.
    boilerplate: a licence, legal or site phrase in a line of at most 200 characters.
    """
    words = F.regexp_count(line, F.lit(WORD))
    marks = F.regexp_count(line, F.lit(r"[!?]{2,}"))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    return (
        F.when((separators >= 3) & (4 * separators >= words), F.lit("navigation"))
        .when((symbols > 0) & (10 * symbols >= F.length(line)), F.lit("symbols"))
        .when(~line.rlike(SENTENCE_END), F.lit("punctuation"))
        .when((marks > 0) & (4 * marks >= words), F.lit("punctuation"))
        .when((F.length(line) <= SHORT) & line.rlike(BOILERPLATE), F.lit("boilerplate"))
    )


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def repeat_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more; ``windows`` holds the hash of the window at each word."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = F.struct(placed.alias("p"), F.transform(placed, lambda x: x["h"]).alias("h"))
    twice = F.transform(
        F.array(ordered),
        lambda s: F.filter(
            s["p"],
            lambda x, k: F.coalesce(F.get(s["h"], k - 1) == x["h"], F.lit(False))
            | F.coalesce(F.get(s["h"], k + 1) == x["h"], F.lit(False)),
        ),
    )[0]
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.transform(
        F.array(places),
        lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.get(p, k - 1)))),
            F.lit(0),
            lambda total, x: total + x,
        ),
    )
    return covered[0].cast("bigint")


def clean_lines(docs: DataFrame, text_col: str = "text", max_loss: float = 0.3) -> DataFrame:
    """Add the counts of each text, its failing lines, the cleaned text and the verdict.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``; ``line_faults`` (rule and number of
    lines), ``clean_text`` (the lines that pass), ``n_clean_words`` and ``kept``:
    not failed, and at most ``max_loss`` of the words lost with failing lines.

    Lines are cut at ``\\n``; lines without a word neither fail nor count. A null
    text is empty: no words, failed, an empty clean text. Nothing but the row
    itself is looked at, so repeated rows get equal results. Columns of ``docs``
    with the names above are replaced; an empty table gives no rows.
    """
    return set_aside(docs, lambda d: _judged(d, text_col, max_loss), [text_col])


def _judged(docs: DataFrame, text_col: str, max_loss: float) -> DataFrame:
    text = whole(text_col)
    texts = docs.withColumn("_text", text).withColumn("_words", words_of(F.col("_text")))
    lines = F.filter(F.split("_text", "\n", -1), has_word)
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    cut = texts.withColumns({"_lines": lines, "_hashes": hashes, "word_chars": F.length(F.array_join("_words", "")).cast("bigint")})
    n = F.size("_hashes")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW))),
    )
    faults = F.transform("_lines", line_fault)
    cut = cut.withColumns({"_windows": windows, "_faults": faults, "n_words": n.cast("bigint")})
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    counted = cut.withColumns(
        {
            "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": F.when(repeated, repeat_words(F.col("_windows"))).otherwise(F.lit(0).cast("bigint")),
            "clean_text": F.array_join(F.filter("_lines", lambda line, k: F.get("_faults", k).isNull()), "\n"),
            "line_faults": F.map_from_entries(
                F.transform(
                    F.array_distinct(F.array_compact("_faults")),
                    lambda f: F.struct(f, F.size(F.filter("_faults", lambda x: x == f))),
                )
            ),
        }
    )
    lost = F.size(F.array_compact("_faults")) > 0
    counted = counted.withColumn("n_clean_words", F.when(lost, n_words(F.col("clean_text"))).otherwise(F.col("n_words")))
    # A filter on the verdict must not pull the expressions below into itself; it stays above a generator.
    others = [c for c in docs.columns if c not in ADDED]
    once = counted.select(*[F.col(f"`{c}`") for c in others], F.inline(F.array(F.struct(*ADDED[:-2]))))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    loss = F.col("n_words") - F.col("n_clean_words")
    judged = once.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (loss <= max_loss * F.col("n_words")))
