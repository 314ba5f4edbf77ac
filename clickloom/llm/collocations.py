"""Phrases of two to four words that belong together, by best-first branch and bound.

A phrase's score is the Dice coefficient of its weakest cut: with ``a`` occurrences, and ``l`` and
``r`` of the parts before and after the cut, 2a / (l + r) in millionths. Phrases grow by a word at
either end, and counts bound what can still come. A phrase that begins with the part ``p`` has at
most f(p) occurrences, cut behind its first word w it has at least as many on the right, so its
score is at most 2 f(p) / (f(w) + f(p)); the same holds for the end of a phrase and its last word.
So every part of a phrase with a score of ``theta`` or more has a bound of ``theta`` or more.

Words and pairs of frequent words are counted first, each in one pass over the texts. The frontier
is the pairs; they are expanded best bound first, all those of a language with ``theta`` or more at
once: a pass counts the triples that grow out of them at either end, and another one the phrases of
four words that grow out of the triples. Then all phrases with that score are known, with all their
neighbours, and so is whether a longer one takes their place. If a language has too few survivors
for its list, ``theta`` falls and what is new in the frontier is expanded; phrases that are counted
stay counted. When it has enough, no phrase that is not counted can be in the list or tie with its
last one.

A pass over the texts counts by numpy per Arrow batch and adds up in Spark. A phrase is the tuple of
its words' 64-bit hashes, which the language is part of. What a pass counts is chosen by bitmaps of
fixed size; where one also lets other phrases pass, these are counted in full and judged by their
counts.

Null texts are empty, null languages are ``und``; null ids and repeated rows count like all others.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.bitmaps import bitmap, holds
from clickloom.llm.words import CHUNK, mix, runs, utf8, word_hashes
from clickloom.sources.storage import materialize

MILLION = 1_000_000
UNKNOWN = "und"


@dataclass(frozen=True)
class Rules:
    min_count: int = 30
    # Phrases in the list of a language.
    top: int = 2000
    # A phrase gives way to a longer one with so many percent of its occurrences.
    inside_percent: int = 80
    # The first frontier holds about so many pairs for each place in the list; later ones as many
    # times more.
    widen: int = 4


# --- texts ----------------------------------------------------------------------------------

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = False
_ENDS_PIECE = ~_IS_WORD
_ENDS_PIECE[[0x20, 0x09]] = False
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Distinct phrases a task holds before it passes them on.
HELD_PHRASES = 2_000_000


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch: the bytes, every word's hash and first byte, and the number of its piece.

    Long texts are cut where a piece ends; only a longer piece is a part of its own.
    """
    at, held = utf8(batch["text"])
    of_lang = batch["lang_code"].to_numpy().view(np.uint64)
    for low, high in runs(at):
        data = held[at[low]:at[high]]
        for start, end in _cuts(data) if high - low == 1 else [(0, len(data))]:
            part = data[start:end]
            starts = at[low:high] - at[low] if high - low > 1 else np.zeros(1, np.int64)
            hashes, begin = word_hashes(part, _IS_WORD, starts[starts < len(part)])
            if not len(hashes):
                continue
            text = np.searchsorted(starts, begin, "right") - 1
            piece = np.cumsum(_ENDS_PIECE[part])[begin] + text * (len(part) + 1)
            # One hash for a word of a language; words are told apart by it from here on.
            yield part, mix(hashes ^ of_lang[low:high][text]), begin, piece


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    start = 0
    while len(data) - start > 2 * CHUNK:
        end = start + CHUNK
        while end < len(data) and not _ENDS_PIECE[data[end]]:
            end += 1
        yield start, end
        start = end
    yield start, len(data)


def code_of(words: list[np.ndarray]) -> np.ndarray:
    """One hash for a tuple of word hashes, to look it up in a bitmap."""
    code = words[0].copy()
    for word in words[1:]:
        code = mix(code * _BASE + word)
    return code


def _distinct(words: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal tuples as one, with the sum of their numbers."""
    if not len(n):
        return words, n
    order = np.argsort(code_of(words), kind="stable")
    words = [w[order] for w in words]
    new = np.ones(len(n), dtype=bool)
    new[1:] = np.any([w[1:] != w[:-1] for w in words], axis=0)
    heads = np.flatnonzero(new)
    return [w[heads] for w in words], np.add.reduceat(n[order], heads)


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_code"),
                       F.col("text").cast("string").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """``(lang, word, text, n)`` of all words of all languages; ``word`` is the hash."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.int64()), ("text", pa.string()),
                        ("n", pa.int64())])

    def count(batches):
        for batch in batches:
            # A batch in parts by language, so that a word's text is taken with its language.
            for lang in batch["lang"].unique().to_pylist():
                of_lang = batch.filter(pc.equal(batch["lang"], lang))
                found: dict[int, list] = {}
                for data, hashes, begin, _ in _passes(of_lang):
                    inside = np.append(_IS_WORD[data], False)
                    ends = np.flatnonzero(~inside)
                    codes, one, n = np.unique(hashes, return_index=True, return_counts=True)
                    first = begin[one]
                    # A word of one text may touch the next text's; word starts end it too.
                    after = np.append(begin, len(data))[one + 1]
                    last = np.minimum(ends[np.searchsorted(ends, first)], after)
                    raw = data.tobytes().translate(_LOWER)
                    for code, low, high, times in zip(codes.view(np.int64).tolist(), first.tolist(),
                                                      last.tolist(), n.tolist()):
                        if code in found:
                            found[code][1] += times
                        else:
                            found[code] = [raw[low:high], times]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()),
                     pa.array(list(found), pa.int64()),
                     pa.array([w.decode() for w, _ in found.values()], pa.string()),
                     pa.array([n for _, n in found.values()], pa.int64())], schema=schema)

    return (_texts(docs).mapInArrow(count, "lang string, word long, text string, n long")
            .groupBy("lang", "word", "text").agg(F.sum("n").alias("n")))


def _names(size: int) -> list[str]:
    return [f"w{k}" for k in range(1, size + 1)]


def count_phrases(docs: DataFrame, size: int, wanted) -> DataFrame:
    """``(w1, ..., n)`` of the phrases that ``wanted`` selects from arrays of word hashes."""
    schema = pa.schema([(c, pa.int64()) for c in (*_names(size), "n")])

    def as_batch(words, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array(w.view(np.int64)) for w in words), pa.array(n)], schema=schema)

    def count(batches):
        held, rows = [], 0
        for batch in batches:
            for _, hashes, _, piece in _passes(batch):
                at = np.flatnonzero(piece[:-size + 1] == piece[size - 1:])
                words = [hashes[at + k] for k in range(size)]
                chosen = wanted(words)
                words = [w[chosen] for w in words]
                words, n = _distinct(words, np.ones(len(words[0]), dtype=np.int64))
                held.append((words, n))
                rows += len(n)
                if rows > HELD_PHRASES:
                    words, n = _distinct([np.concatenate(c) for c in zip(*(w for w, _ in held))],
                                         np.concatenate([n for _, n in held]))
                    held, rows = [(words, n)], len(n)
                    if 2 * rows > HELD_PHRASES:  # hardly any were equal
                        yield as_batch(words, n)
                        held, rows = [], 0
        if held:
            yield as_batch(*_distinct([np.concatenate(c) for c in zip(*(w for w, _ in held))],
                                      np.concatenate([n for _, n in held])))

    columns = ", ".join(f"{c} long" for c in (*_names(size), "n"))
    return (_texts(docs).select("lang_code", "text").mapInArrow(count, columns)
            .groupBy(_names(size)).agg(F.sum("n").alias("n")))


# --- bounds and scores ----------------------------------------------------------------------

def _dice(a: str, l_and_r: str) -> str:
    """floor(2000000 a / (l + r)); the product may need more than 64 bits."""
    return f"cast({2 * MILLION} * cast({a} as decimal(20, 0)) div ({l_and_r}) as long)"


def _with_bounds(phrases: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """Adds ``lang`` and the bounds of phrases that go on at the end, and at the beginning."""
    first = words.select(F.col("word").alias("w1"), "lang", F.col("n").alias("first_n"))
    last = words.select(F.col("word").alias(f"w{size}"), F.col("n").alias("last_n"))
    return (phrases.join(first, "w1").join(last, f"w{size}")
            .withColumns({"onward": F.expr(_dice("n", "first_n + n")),
                          "backward": F.expr(_dice("n", "last_n + n"))}))


def _scored(phrases: DataFrame, parts: dict[int, DataFrame], size: int) -> DataFrame:
    """Adds ``l, r, score`` of the lowest-scoring cut; phrases with an uncounted part go."""
    scored = phrases
    for cut in range(1, size):
        for side, names in (("l", _names(size)[:cut]), ("r", _names(size)[cut:])):
            part = parts[len(names)].select(
                *[F.col(a).alias(b) for a, b in zip(_names(len(names)), names)],
                F.col("n").alias(f"{side}{cut}"))
            scored = scored.join(part, names)
        scored = scored.withColumn(f"score{cut}", F.expr(_dice("n", f"l{cut} + r{cut}")))
    cuts = F.array(*[F.struct(F.col(f"score{k}").alias("score"), F.lit(k).alias("cut"),
                              F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
                     for k in range(1, size)])
    return (scored.withColumn("lowest", F.array_min(cuts))
            .select(*phrases.columns, "lowest.l", "lowest.r", "lowest.score"))


def _codes(phrases: DataFrame, size: int, *flags: str) -> DataFrame:
    """``code`` of every phrase, as :func:`code_of` makes it, with some boolean columns."""
    names = _names(size)

    def code(batches):
        for batch in batches:
            codes = code_of([batch[c].to_numpy().view(np.uint64) for c in names])
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), *(batch[c] for c in flags)],
                names=["code", *flags])

    return phrases.select(*names, *flags).mapInArrow(
        code, ", ".join(["code long", *(f"{c} boolean" for c in flags)]))


class _Frontier:
    """Bitmaps of the phrases of one size that are expanded, one pair for each round."""

    def __init__(self, size: int):
        self.size, self.rounds = size, []

    def expand(self, phrases: DataFrame) -> None:
        """``phrases`` has the bounds ``onward`` and ``backward``, and the ``theta`` to reach."""
        context = phrases.sparkSession.sparkContext
        codes = materialize(_codes(phrases.select(
            *_names(self.size), F.expr("onward >= theta").alias("at_end"),
            F.expr("backward >= theta").alias("at_begin")), self.size, "at_end", "at_begin"),
            "frontier")
        self.rounds.append(tuple(context.broadcast(bitmap(codes.where(side), "code"))
                                 for side in ("at_end", "at_begin")))

    def wanted(self):
        """Phrases that grow out of the last round's and out of no earlier one's."""
        rounds = list(self.rounds)

        def choose(words: list[np.ndarray]) -> np.ndarray:
            begin, end = code_of(words[:-1]), code_of(words[1:])
            new = [holds(at_end.value, begin) | holds(at_begin.value, end)
                   for at_end, at_begin in rounds]
            for earlier in new[:-1]:
                new[-1] &= ~earlier
            return new[-1]

        return choose


def _all_of(held, size: int):
    """Selects phrases whose parts of ``size`` words are all in a bitmap."""
    def choose(words: list[np.ndarray]) -> np.ndarray:
        kept = np.ones(len(words[0]), dtype=bool)
        for k in range(len(words) - size + 1):
            kept &= holds(held.value, code_of(words[k:k + size]))
        return kept

    return choose


def _both(one, other):
    def choose(words: list[np.ndarray]) -> np.ndarray:
        kept = one(words)
        kept[kept] = other([w[kept] for w in words])
        return kept

    return choose


# --- the search -----------------------------------------------------------------------------

def _thresholds(pairs: DataFrame, places: int) -> DataFrame:
    """``(lang, theta)``: about ``places`` pairs of a language have this score or more.

    From a histogram of scores, a thousand bars a language; 0 where there are fewer pairs.
    """
    bars = pairs.groupBy("lang", F.expr("score div 1000").alias("bar")).count()
    above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("bar")))
    return (bars.withColumn("above", above).groupBy("lang")
            .agg((F.coalesce(F.max(F.when(F.col("above") >= places, F.col("bar"))), F.lit(0))
                  * 1000).alias("theta")))


def _survivors(scored: dict[int, DataFrame], counted: dict[int, DataFrame], thetas: DataFrame,
               rules: Rules) -> DataFrame:
    """Phrases with their language's ``theta`` or more that no longer phrase takes the place of.

    If a longer phrase has enough occurrences, so has the one with a single word more.
    """
    found = None
    for size in (2, 3, 4):
        names = _names(size)
        left = scored[size].join(thetas, "lang").where("score >= theta")
        if size < 4:
            longer = counted[size + 1]
            around = longer.select(*names, "n").union(longer.select(*_names(size + 1)[1:], "n"))
            around = around.groupBy(names).agg(F.max("n").alias("longer_n"))
            left = left.join(around, names, "left").where(
                f"longer_n is null or 100 * longer_n < {rules.inside_percent} * n")
        rest = [F.lit(None).cast("long").alias(c) for c in _names(4)[size:]]
        left = left.select("lang", *names, *rest, "n", "l", "r", "score")
        found = left if found is None else found.union(left)
    return found


def _first(survivors: DataFrame, words: DataFrame, rules: Rules) -> DataFrame:
    """The first ``top`` phrases of every language, with their words."""
    order = [F.desc("score"), F.desc("n")]
    tied = survivors.withColumn("place", F.rank().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= rules.top)
    for name in _names(4):
        text = words.select(F.col("word").alias(name), F.col("text").alias(f"{name}_text"))
        tied = tied.join(text, name, "left")
    phrase = F.concat_ws(" ", *[f"{c}_text" for c in _names(4)])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (tied.withColumn("phrase", phrase).withColumn("rank", rank.cast("long"))
            .where(F.col("rank") <= rules.top)
            .select("lang", "rank", "phrase", F.col("n").alias("a"), "l", "r", "score"))


def collocations(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of the best phrases of every language."""
    spark = docs.sparkSession
    every_word = materialize(count_words(docs), "words")
    totals = every_word.groupBy("lang").agg(F.sum("n").alias("total"))
    words = materialize(every_word.where(F.col("n") >= rules.min_count), "frequent")
    frequent = spark.sparkContext.broadcast(bitmap(words, "word"))
    enough = F.col("n") >= rules.min_count

    pairs = materialize(_with_bounds(
        count_phrases(docs, 2, _all_of(frequent, 1)).where(enough), words, 2), "pairs")
    counted = {1: words.withColumnRenamed("word", "w1"), 2: pairs}
    scored = {2: materialize(_scored(pairs, counted, 2), "scored")}
    common_pairs = spark.sparkContext.broadcast(bitmap(_codes(pairs, 2), "code"))

    frontiers = {2: _Frontier(2), 3: _Frontier(3)}
    open_langs = materialize(words.select("lang").distinct(), "langs")
    thetas, places = None, rules.top
    while True:
        places *= rules.widen
        now = _thresholds(scored[2], places).join(open_langs, "lang", "right").select(
            "lang", F.coalesce("theta", F.lit(0)).alias("theta"))
        if thetas is not None:  # settled languages keep theirs
            now = now.union(thetas.join(open_langs, "lang", "left_anti"))
        thetas = materialize(now, "thetas")
        for size in (2, 3):
            frontiers[size].expand(counted[size].join(
                thetas.join(open_langs, "lang", "left_semi"), "lang"))
            choose = _both(_all_of(common_pairs, 2), frontiers[size].wanted())
            grown = _with_bounds(count_phrases(docs, size + 1, choose).where(enough), words,
                                 size + 1)
            if size + 1 in counted:
                grown = counted[size + 1].union(grown.select(counted[size + 1].columns))
            counted[size + 1] = materialize(grown, "grown")
        for size in (3, 4):
            scored[size] = _scored(counted[size], counted, size)
        survivors = materialize(_survivors(scored, counted, thetas, rules), "survivors")
        full = survivors.groupBy("lang").count().where(F.col("count") >= rules.top)
        open_langs = materialize(
            thetas.where("theta > 0").join(full, "lang", "left_anti").select("lang"), "langs")
        if open_langs.isEmpty():
            break
    return _first(survivors, words, rules).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
