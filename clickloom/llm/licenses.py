"""Licence scan: the Dice coefficient of word bigrams with licence templates.

Texts are normalised to words: runs of ASCII letters and digits and non-ASCII bytes, letters in
lower case. A template of n words is compared with every stretch of n words of the text, cut at the
text's ends, and with the text as a whole. Dice is twice the shared bigrams (with repeats) over
those of both sides. Bounds prune before any stretch is looked at: with n bigrams in a template and
s shared by the whole text, no stretch reaches ``min_dice`` unless ``s >= n * min_dice /
(2 - min_dice)``, as no stretch shares more bigrams than it has.

What a stretch shares is counted for all of them at once: an occurrence of a bigram that the
template has m times counts for the stretches that hold it and not the m-th occurrence before it.
The work for a template is linear in its length and the text's.

Of matches that overlap the one stays that shares the most bigrams, so a licence's full text goes
before the notices in it; then the highest Dice, the first, and the first template.

Null and empty texts have no matches. Rows are scanned one by one; repeated rows have equal
results, null ids and other columns (but for those named in the result) pass through.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.license_texts import templates as public_templates
from clickloom.llm.words import mix, words_by_text

MIN_DICE = 0.85
# Template words in all; every task holds them. It bounds what is broadcast.
MAX_TEMPLATE_WORDS = 2_000_000

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def bigrams(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, ...``, ``n[k]`` numbers for each k, one after the other."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def shared_by_stretch(occurrences: np.ndarray, counts: np.ndarray, times: np.ndarray, size: int,
                      length: int) -> np.ndarray:
    """Shared bigrams of the stretches of ``size`` bigrams from ``1 - size`` to ``length - 1``.

    ``occurrences`` has the places of each shared bigram in the text, ascending, ``counts`` of them
    for each; ``times`` is how often the template has it.
    """
    rank = _ranges(np.zeros(len(counts), dtype=np.int64), counts)
    limit = np.repeat(times, counts)
    # The stretches that count an occurrence start after the one ``limit`` before it.
    low = occurrences - size + 1
    late = np.flatnonzero(rank >= limit)
    low[late] = np.maximum(low[late], occurrences[late - limit[late]] + 1)
    begin = np.bincount(low + size - 1, minlength=length + size)
    end = np.bincount(occurrences + size, minlength=length + size)
    return np.cumsum(begin - end)[:length + size - 1]


class Templates:
    """Distinct bigrams of all templates, and for each which templates have it, and how often."""

    def __init__(self, texts: list[tuple[str, str]], min_dice: float = MIN_DICE):
        self.names, self.min_dice = [name for name, _ in texts], min_dice
        sizes, codes, times = [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for name, text in texts:
            _, words, _ = next(words_by_text(pa.array([text]), _IS_WORD))
            if len(words) < 2:
                raise ValueError(f"template of {name} has fewer than two words")
            held, n = np.unique(bigrams(words), return_counts=True)
            sizes.append(len(words) - 1)
            codes.append(held)
            times.append(n)
        self.sizes = np.array(sizes, dtype=np.int64)
        if self.sizes.sum() + len(sizes) > MAX_TEMPLATE_WORDS:
            raise ValueError("more template words than may be broadcast; scan in several parts")
        template = np.repeat(np.arange(len(sizes)), [len(c) for c in codes[1:]])
        codes = np.concatenate(codes)
        order = np.argsort(codes, kind="stable")
        self.template, self.times = template[order], np.concatenate(times)[order]
        self.known, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(codes))

    def matches(self, words: np.ndarray) -> list[tuple[str, float, int, int]]:
        """``(name, dice, first word, words)`` of matches that do not overlap, by place."""
        if len(words) < 2 or not len(self.known):
            return []
        codes = bigrams(words)
        at = np.searchsorted(self.known, codes)
        at[at == len(self.known)] = 0
        places = np.flatnonzero(self.known[at] == codes)
        places = places[np.argsort(at[places], kind="stable")]
        hit, first, n = np.unique(at[places], return_index=True, return_counts=True)
        # A row for each shared bigram and template that has it.
        width = self.first[hit + 1] - self.first[hit]
        row = _ranges(self.first[hit], width)
        which = np.repeat(np.arange(len(hit)), width)
        template, times = self.template[row], self.times[row]
        shared = np.bincount(template, np.minimum(times, n[which]), minlength=len(self.names))
        least = self.sizes * self.min_dice / (2 - self.min_dice)
        found = []
        for k in np.flatnonzero(shared >= least - 1e-6).tolist():
            mine = template == k
            held = which[mine]
            found.append(self._stretches(
                k, places[_ranges(first[held], n[held])], n[held], times[mine], len(codes),
                int(shared[k])))
        return self._best(found)

    def _stretches(self, k: int, occurrences: np.ndarray, counts: np.ndarray, times: np.ndarray,
                   length: int, whole: int) -> np.ndarray:
        """Rows of shared bigrams, Dice, first and end bigram, and template ``k``."""
        size = int(self.sizes[k])
        shared = shared_by_stretch(occurrences, counts, times, size, length)
        start = np.arange(1 - size, length)
        low, high = np.maximum(start, 0), np.minimum(start + size, length)
        shared, low, high = (np.append(a, b) for a, b in
                             ((shared, whole), (low, 0), (high, length)))
        value = 2 * shared / (size + high - low)
        enough = np.flatnonzero(value >= self.min_dice)
        return np.stack([shared[enough], value[enough], low[enough], high[enough],
                         np.full(len(enough), k)])

    def _best(self, found: list[np.ndarray]) -> list[tuple[str, float, int, int]]:
        if not found:
            return []
        shared, value, low, high, template = np.concatenate(found, axis=1)
        order = np.lexsort((template, low, -value, -shared))
        starts: list[int] = []
        kept: list[tuple[str, float, int, int]] = []
        ends: list[int] = []
        for v, a, b, k in zip(value[order].tolist(), low[order].astype(int).tolist(),
                              high[order].astype(int).tolist(),
                              template[order].astype(int).tolist()):
            place = bisect(starts, a)
            if (place and ends[place - 1] > a) or (place < len(starts) and starts[place] < b):
                continue
            starts.insert(place, a)
            ends.insert(place, b)
            kept.insert(place, (self.names[k], v, a, b - a + 1))
        return kept


_RESULT = "array<struct<license:string,dice:double,first_word:long,n_words:long>>"


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None,
         min_dice: float = MIN_DICE) -> DataFrame:
    """``docs`` with ``matches`` (by place), ``license`` and ``dice`` of the best one (null if
    none) and ``n_matches``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(
        Templates(public_templates() if templates is None else templates, min_dice))

    @F.pandas_udf(_RESULT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = shared.value
        for texts in batches:
            rows = []
            for first in range(0, len(texts), 256):
                part = pa.array(texts[first:first + 256], pa.string())
                for _, words, cuts in words_by_text(part, _IS_WORD):
                    for low, high in zip(cuts[:-1], cuts[1:]):
                        rows.append([dict(zip(("license", "dice", "first_word", "n_words"), m))
                                     for m in held.matches(words[low:high])])
            yield pd.Series(rows, dtype=object)

    best = F.expr("array_max(transform(matches, m -> named_struct('dice', m.dice, 'at',"
                  " -m.first_word, 'license', m.license)))")
    # The best match stands in the column of its licence first, so that no other name is needed.
    return (docs.withColumn("matches", find(F.col("text").cast("string")))
            .withColumn("license", best)
            .withColumns({"license": F.col("license.license"), "dice": F.col("license.dice"),
                          "n_matches": F.size("matches")}))
