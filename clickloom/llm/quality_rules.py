"""Line-first quality rules, in DataFrame functions only.

Every line is judged by itself: navigation (many short parts between bars, arrows or bullets),
boilerplate (phrases of page furniture in a short line), shouting, symbol noise, and lines that
stop in mid air, without closing punctuation, though they are as short as a menu entry. Failing
lines are removed; a document that keeps too small a part of its characters is rejected, as is one
that fails the base rules: fewer than ``min_words`` words, or more than half of its words in
windows of three words that occur twice.

Null and empty texts have no words and fail. Rows are judged one by one, so repeated rows, null
ids and other columns change nothing; nothing is exchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.columns import sets_aside

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# Fixed phrases of page furniture.
BOILERPLATE = ("cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved",
               "subscribe to", "sign up", "log in", "click here", "read more", "share this",
               "javascript", "lorem ipsum")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    repeat_percent: int = 50
    # A line of at most so many words may be furniture.
    furniture_words: int = 12
    # A line of fewer words needs closing punctuation.
    open_words: int = 3
    # Of a line's characters other than spaces, in percent.
    symbol_percent: int = 10
    capital_percent: int = 70
    # Parts between bars that make a line a menu.
    menu_parts: int = 4
    # What must be left of a document's characters, in percent.
    left_percent: int = 50


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def line_fails(line: Column, rules: Rules = Rules()) -> Column:
    """Whether a line with at least one word is to be removed."""
    solid = F.length(F.regexp_replace(line, SPACE, ""))
    n_words = F.size(words(line))
    symbols = F.length(F.regexp_replace(line, r"[^#*$%&<>{}\\~^=]+", ""))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    parts = F.size(F.split(line, r"\s[|»›•>·]\s|\s::\s"))
    furniture = F.lower(line).rlike("|".join(BOILERPLATE)) & (n_words <= rules.furniture_words)
    return ((parts >= rules.menu_parts)
            | furniture
            | (100 * symbols > rules.symbol_percent * solid)
            | ((100 * capitals > rules.capital_percent * letters) & (letters >= 20))
            | (~line.rlike(r"[.!?:;…。！？\"'”’)\]][\x20\x09-\x0D]*$")
               & (n_words < rules.open_words)))


def with_repeat_words(docs: DataFrame, held: str, name: str) -> DataFrame:
    """Adds how many words of the array ``held`` stand in 3-word windows that occur twice or more.

    Windows are ordered by their hash; equal neighbours repeat. Each repeated window covers its
    three words, less those the next one covers as well.
    """
    n = F.size(held)
    # In steps: a column that is used twice is made by a projection of its own.
    hashed = docs.withColumn("_windows", F.when(n >= 3, F.expr(f"""
        sort_array(transform(sequence(0, greatest(size(`{held}`) - 3, 0)), i -> named_struct(
            'h', xxhash64(`{held}`[i], `{held}`[i + 1], `{held}`[i + 2]), 'i', i)))""")))
    repeated = hashed.withColumn("_at", F.expr("""
        sort_array(transform(filter(_windows, (w, k) ->
            (k > 0 and _windows[k - 1].h = w.h)
            or (k < size(_windows) - 1 and _windows[k + 1].h = w.h)), w -> w.i))"""))
    return repeated.withColumn(name, F.expr("""
        coalesce(aggregate(_at, named_struct('n', 0L, 'end', 0),
            (s, i) -> named_struct('n', s.n + i + 3 - greatest(i, s.end), 'end', i + 3),
            s -> s.n), 0L)""")).drop("_windows", "_at")


@sets_aside("_words", "_lines", "_kept_lines", "_windows", "_at")
def measured(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    clean_text, left_percent, kept``; columns of these names are replaced."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.withColumns({"_words": words(text), "_lines": lines})
    counted = with_repeat_words(base, "_words", "n_repeat_words").withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_kept_lines": F.filter("_lines", lambda x: ~line_fails(x, rules)),
    })
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")))
    cleaned = counted.withColumn("clean_text", F.array_join("_kept_lines", "\n"))
    left = (100 * F.length(F.regexp_replace("clean_text", SPACE, ""))
            / F.greatest("word_chars", F.lit(1)))
    judged = cleaned.withColumns({"base_failed": failed, "left_percent": left})
    return (judged.withColumn("kept", ~F.col("base_failed")
                              & (F.col("left_percent") >= rules.left_percent))
            .drop("_words", "_lines", "_kept_lines"))
