"""Language identification by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary (with a piece for every byte). For each language the
probability of each piece is learned from labelled texts. A text is scored without choosing one
segmentation: the forward algorithm sums the probabilities of all ways to cut each word into pieces.
Words are runs of ASCII letters and non-ASCII bytes of the lower-cased text. Pieces do not span
words, so a text's log probability is the sum over its words, and a task keeps what it knows of the
words it has seen.

The pieces are counted on a bounded sample (``sample_docs``) of the labelled training rows, each of
them whole: first the longest pieces of each word, then ``rounds`` times what the probabilities so
far expect over all segmentations (expectation and maximisation). All texts are scored whole. Null texts and texts without a letter are ``und`` with
score 0, and so is every text if there is nothing to learn from. The score is the probability of
the predicted language among those learned; equally likely languages go to the first by name.
Repeated rows get equal results; null ids are scored but not learned from; other columns pass.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import about
from clickloom.sources.storage import materialize

UNKNOWN = "und"
# Training rows whose pieces are counted.
SAMPLE_DOCS = 6000
SMOOTH = 0.5
# Times that the pieces are counted anew, as the last probabilities expect them.
ROUNDS = 2
# Expected counts are sums of whole parts of one, which do not depend on the order of the rows.
UNIT = 1 << 20
# A longer word is scored by itself, byte by byte, so that few bytes are held; the sum is the same.
ALONE = 256
CACHE_WORDS = 400_000

_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")
_START = "▁".encode()


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


@functools.cache
def vocabulary(path: str) -> dict[bytes, int]:
    """Number of each piece; pieces of one byte stand for the byte.

    Pieces that no word can hold are left out: with capitals, signs or several spaces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]): b for b in range(256)}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).encode()
        if (not model.is_control(i) and not model.is_unknown(i) and not model.is_byte(i)
                and len(piece) > 1 and b" " not in piece.translate(_LETTERS)
                and _START not in piece[1:]):
            pieces.setdefault(piece, len(pieces))
    return pieces


@functools.cache
def longest(path: str) -> int:
    """Bytes of the longest piece."""
    return max(map(len, vocabulary(path)))


class Trie:
    """The pieces as a table of steps from byte to byte, for many words at a time."""

    def __init__(self, pieces: dict[bytes, int]):
        # Bytes that no longer piece holds share one column, which leads nowhere.
        used = sorted({b for piece in pieces if len(piece) > 1 for b in piece})
        self.column = np.full(256, len(used), dtype=np.int64)
        self.column[used] = range(len(used))
        self.one = np.array([pieces[bytes([b])] for b in range(256)], dtype=np.int64)
        steps: list[dict[int, int]] = [{}]
        number = {}
        for piece, k in pieces.items():
            if len(piece) > 1:
                node = 0
                for b in piece:
                    node = steps[node].setdefault(b, len(steps))
                    if node == len(steps):
                        steps.append({})
                number[node] = k
        self.step = np.zeros((len(steps), len(used) + 1), dtype=np.int32)
        for node, follow in enumerate(steps):
            self.step[node, self.column[list(follow)]] = list(follow.values())
        self.number = np.full(len(steps), -1, dtype=np.int64)
        self.number[list(number)] = list(number.values())

    def found(self, parts: list[bytes]) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
        """By end: width, rows of ``parts`` that have a piece of it there, and its number."""
        lengths = np.array([len(p) for p in parts])
        size = int(lengths.max())
        text = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in parts),
                             dtype=np.uint8).reshape(-1, size)
        columns = self.column[text]
        ends: dict[int, list] = {end: [] for end in range(1, size + 1)}
        # From the last start to the first, so that the widths of an end are in order.
        for start in reversed(range(size)):
            rows = np.flatnonzero(lengths > start)
            ends[start + 1].append((1, rows, self.one[text[rows, start]]))
            node = self.step[0, columns[rows, start]]
            for end in range(start + 2, size + 1):
                on = (node > 0) & (lengths[rows] >= end)
                rows = rows[on]
                if not len(rows):
                    break
                node = self.step[node[on], columns[rows, end - 1]]
                number = self.number[node]
                whole = number >= 0
                if whole.any():
                    ends[end].append((end - start, rows[whole], number[whole]))
        return ends


@functools.cache
def trie(path: str) -> Trie:
    return Trie(vocabulary(path))


def _longest_first(word: bytes, pieces: dict[bytes, int], most: int) -> list[int]:
    found, at = [], 0
    while at < len(word):
        for size in range(min(most, len(word) - at), 0, -1):
            number = pieces.get(word[at:at + size])
            if number is not None:
                found.append(number)
                at += size
                break
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)``: how often each word stands in the texts of a language."""

    def count(batches):
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                seen.setdefault(lang, Counter()).update(words(text or ""))
            rows = [(lang, word, n) for lang, held in seen.items() for word, n in held.items()]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.int64())], names=["lang", "word", "n"])

    return (docs.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def expected_pieces(word: bytes, pieces: dict[bytes, int], most: int,
                    log: list[float]) -> Counter:
    """How often each piece is expected in ``word``, over all its segmentations.

    ``log`` has the log probabilities of the pieces. Sums forward and backward are logs, so words
    of any length do not underflow.
    """
    get, size = pieces.get, len(word)
    forward, edges = [0.0], []
    for end in range(1, size + 1):
        into = []
        for start in range(max(0, end - most), end):
            number = get(word[start:end])
            if number is not None:
                into.append((start, number))
        values = [forward[start] + log[number] for start, number in into]
        top = max(values)
        forward.append(top + math.log(sum(math.exp(v - top) for v in values)))
        edges.append(into)
    expected: Counter = Counter()
    # Chance that a segmentation of the whole word has a cut at each place.
    cut = [0.0] * size + [1.0]
    for end in range(size, 0, -1):
        if cut[end]:
            for start, number in edges[end - 1]:
                chance = cut[end] * math.exp(forward[start] + log[number] - forward[end])
                cut[start] += chance
                expected[number] += chance
    return expected


def piece_counts(counted: DataFrame, path: str, model: Model | None = None) -> DataFrame:
    """``(lang, piece, n)``: n times ``UNIT``, of the rows of :func:`word_counts`.

    Expected counts by ``model``, or without one those of each word's longest pieces first.
    """
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        pieces, most, held = vocabulary(path), longest(path), shared.value
        logs = {} if held is None else {
            lang: np.log(held.chances[:, k]).tolist() for k, lang in enumerate(held.langs)}
        for batch in batches:
            total: Counter = Counter()
            for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n"))):
                if held is None:
                    found = Counter(_longest_first(_START + word, pieces, most))
                else:
                    found = expected_pieces(_START + word, pieces, most, logs[lang])
                for number, times in found.items():
                    total[lang, number] += times * n
            rows = [(lang, number, round(n * UNIT)) for (lang, number), n in total.items()]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.int64())], names=["lang", "piece", "n"])

    # Few bytes and much work for each, so words are spread by tasks, not by size.
    tasks = counted.sparkSession.sparkContext.defaultParallelism
    return (counted.repartition(tasks, "lang", "word")
            .mapInArrow(count, "lang string, piece int, n long")
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")))


class Model:
    """Languages and the probabilities of all pieces in each."""

    def __init__(self, langs: list[str], chances: np.ndarray, path: str):
        self.langs, self.chances, self.path = langs, chances, path

    @staticmethod
    def _of_counts(counts: DataFrame, path: str) -> Model:
        rows = counts.collect()
        langs = sorted({row["lang"] for row in rows})
        n = np.full((len(vocabulary(path)), len(langs)), SMOOTH)
        at = {lang: k for k, lang in enumerate(langs)}
        for row in rows:
            n[row["piece"], at[row["lang"]]] += row["n"] / UNIT
        return Model(langs, n / n.sum(axis=0), path)

    @staticmethod
    def learn(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS,
              rounds: int = ROUNDS) -> Model:
        """From the rows of ``docs`` that have ``lang``; languages times vocabulary at most."""
        labelled = docs.where("lang is not null and text is not null and doc_id is not null")
        counted = materialize(
            word_counts(about(labelled, sample_docs, F.col("doc_id"))), "words")
        model = Model._of_counts(piece_counts(counted, path), path)
        for _ in range(rounds if model.langs else 0):
            model = Model._of_counts(piece_counts(counted, path, model), path)
        return model


class Scorer:
    """Log probabilities of words in each language, remembered by word."""

    def __init__(self, model: Model):
        self.model = model
        self.pieces, self.most = vocabulary(model.path), longest(model.path)
        self.at: dict[bytes, int] = {}
        self.table = np.empty((0, len(model.langs)))
        self.used = 0

    def _forward_alone(self, word: bytes) -> np.ndarray:
        """Log of the sum over all segmentations of one word of any length.

        Only the sums for the last bytes are held, as logs of a common scale and values beside it.
        """
        get, most, chances = self.pieces.get, self.most, self.model.chances
        langs = range(len(self.model.langs))
        known: dict[int, list[float]] = {}
        last = deque([[1.0 for _ in langs]], maxlen=most)
        scale = [0.0 for _ in langs]
        for end in range(1, len(word) + 1):
            total = [0.0 for _ in langs]
            for width in range(1, min(most, end) + 1):
                number = get(word[end - width:end])
                if number is not None:
                    chance = known.get(number)
                    if chance is None:
                        chance = known[number] = chances[number].tolist()
                    before = last[-width]
                    for k in langs:
                        total[k] += before[k] * chance[k]
            last.append(total)
            if end % 16 == 0:
                # Rescaled, so that long words do not underflow.
                for k in langs:
                    norm = total[k]
                    scale[k] += math.log(norm)
                    for held in last:
                        held[k] /= norm
        return np.array([scale[k] + math.log(last[-1][k]) for k in langs])

    def _forward(self, parts: list[bytes]) -> np.ndarray:
        """Sum over all segmentations of each part, which are of nearly equal size."""
        size = max(map(len, parts))
        langs = len(self.model.langs)
        alpha = np.zeros((size + 1, len(parts), langs))
        alpha[0] = 1
        scale = np.zeros((len(parts), langs))
        lengths = np.array([len(p) for p in parts])
        out = np.zeros((len(parts), langs))
        found = trie(self.model.path).found(parts)
        chances = self.model.chances
        for end in range(1, size + 1):
            total = np.zeros((len(parts), langs))
            for width, rows, ids in found[end]:
                total[rows] += alpha[end - width, rows] * chances[ids]
            # Rescaled, so that long words do not underflow.
            norm = np.where(total > 0, total, 1)
            low = max(0, end - self.most)
            alpha[end] = total / norm
            alpha[low:end] /= norm
            scale += np.log(norm)
            done = lengths == end
            out[done] = scale[done]
        return out

    def _learn(self, new: list[bytes]) -> None:
        if self.used + len(new) > CACHE_WORDS:
            self.at, self.used = {}, 0
        scores = np.zeros((len(new), len(self.model.langs)))
        parts = sorted(((_START + word, k) for k, word in enumerate(new) if len(word) <= ALONE),
                       key=lambda x: len(x[0]))
        for k, word in enumerate(new):
            if len(word) > ALONE:
                scores[k] = self._forward_alone(_START + word)
        for low in range(0, len(parts), 4096):
            held = parts[low:low + 4096]
            scores[[k for _, k in held]] = self._forward([p for p, _ in held])
        need = self.used + len(new)
        if need > len(self.table):
            grown = np.empty((max(need, 2 * len(self.table), 1024), len(self.model.langs)))
            grown[:self.used] = self.table[:self.used]
            self.table = grown
        self.table[self.used:need] = scores
        self.at.update(zip(new, range(self.used, need)))
        self.used = need

    def know(self, held: list[list[bytes]]) -> None:
        new = {w for one in held for w in one} - self.at.keys()
        if self.used + len(new) > CACHE_WORDS:
            self.at, self.used = {}, 0
            new = {w for one in held for w in one}
        if new:
            self._learn(sorted(new))

    def log_probability(self, text_words: list[bytes]) -> np.ndarray:
        at = np.fromiter(map(self.at.__getitem__, text_words), dtype=np.int64,
                         count=len(text_words))
        return self.table[at].sum(axis=0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = shared.value
        scorer = Scorer(held)
        for texts in batches:
            rows = []
            texts = texts.tolist()
            # Some texts at a time, so that new words are many and memory is bounded.
            for part in _parts(texts):
                split = [words(t) if t and held.langs and has_letter(t) else [] for t in part]
                scorer.know(split)
                for one in split:
                    if not one:
                        rows.append((UNKNOWN, 0.0))
                        continue
                    log = scorer.log_probability(one)
                    best = int(np.argmax(log))
                    rows.append((held.langs[best], float(1 / np.exp(log - log[best]).sum())))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    # Both stand in one column of the result first, so that no other name is needed.
    judged = docs.withColumn("lang_pred", score(F.col("text").cast("string")))
    return judged.withColumns({"lang_pred": F.col("lang_pred.lang_pred"),
                               "score": F.col("lang_pred.score")})


def _parts(texts: list[str | None], size: int = 1 << 20):
    part, total = [], 0
    for text in texts:
        part.append(text)
        total += len(text or "")
        if total >= size:
            yield part
            part, total = [], 0
    if part:
        yield part
