"""Toxicity by non-negative learning from positive and unlabelled texts.

Positives are confirmed toxic texts; everything else is unlabelled, toxic or not. With the share
``prior`` of toxic texts, the risk of a linear classifier is estimated as

    prior * loss(positives as toxic) + max(0, loss(unlabelled as clean)
                                              - prior * loss(positives as clean))

The second part is a risk and cannot be negative; where a flexible model pushes it below 0 it is
overfitting, and the step goes the other way. Losses are logistic, so the score is a probability.

Features are the distinct words of a text, ASCII letters lower-cased, cut at everything that is not
a letter or digit, and the beginnings (``BEGINNING`` bytes) that two of its words or more share, as
languages that inflect or compound have a form for each place. The classifier knows the features
whose shares among positives and unlabelled texts differ by ``MIN_Z`` standard errors or more (at
most ``MAX_FEATURES``, the most telling ones), so a small sample does not teach it the words of
single texts. It is fitted on a bounded sample (``SAMPLE_TEXTS`` positives and as many unlabelled
texts), each whole; all texts are scored whole.

Null and empty texts have no words and get the score of the constant. If there are no positives or
no unlabelled texts the score is the prior. Rows of one ``doc_id`` get results by their own texts;
null ids are scored, not learned from. Other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.sampling import about
from clickloom.llm.words import words_by_text

SAMPLE_TEXTS = 8000
MAX_FEATURES = 20_000
MIN_TEXTS, MIN_Z = 3, 4.5
DEFAULT_PRIOR = 0.1
# Bytes of the beginning that inflected and compound forms of a word share.
BEGINNING = 5
STEPS, RATE, DECAY = 400, 0.1, 1e-4

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _text_features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The features of each text: distinct words, and beginnings that two words or more have."""
    for words, begun in zip(words_by_text(texts, _IS_WORD),
                            words_by_text(texts, _IS_WORD, BEGINNING)):
        for low, high, first, last in zip(words[2][:-1], words[2][1:], begun[2][:-1], begun[2][1:]):
            beginnings, n = np.unique(begun[1][first:last], return_counts=True)
            # Flipped bits keep a beginning apart from the word of the same letters.
            yield np.unique(np.concatenate([words[1][low:high], ~beginnings[n > 1]]))


def _features(rows: DataFrame) -> DataFrame:
    def distinct(batches):
        for batch in batches:
            words = [w.view(np.int64) for w in _text_features(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array(words, pa.list_(pa.int64()))], names=["toxic", "words"])

    return rows.select("toxic", "text").mapInArrow(distinct, "toxic boolean, words array<long>")


class _Texts:
    """Word lists as one array, with the number of each text beside each word."""

    def __init__(self, lists: list[np.ndarray], known: np.ndarray):
        words = np.concatenate(lists) if lists else np.empty(0, np.uint64)
        text = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        at = np.searchsorted(known, words)
        at[at == len(known)] = 0
        keep = known[at] == words if len(known) else np.zeros(len(words), dtype=bool)
        self.n, self.size = len(lists), len(known)
        self.at, self.text = at[keep], text[keep]

    def margins(self, weights: np.ndarray, constant: float) -> np.ndarray:
        return constant + np.bincount(self.text, weights[self.at], minlength=self.n)

    def gradient(self, by_text: np.ndarray) -> tuple[np.ndarray, float]:
        return np.bincount(self.at, by_text[self.text], minlength=self.size), by_text.sum()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(margins: np.ndarray) -> float:
    return float(np.logaddexp(0, -margins).mean())


def nonnegative_step(a: _Texts, b: _Texts, weights: np.ndarray, constant: float,
                     prior: float) -> tuple[np.ndarray, float]:
    """Gradient to go down, for positives ``a`` and unlabelled texts ``b``.

    That of the whole risk; where the part of the clean texts is negative, that part's, turned.
    """
    at_p, at_u = a.margins(weights, constant), b.margins(weights, constant)
    clean = _loss(-at_u) - prior * _loss(-at_p)
    g_w, g_c = b.gradient(_sigmoid(at_u) / b.n)
    h_w, h_c = a.gradient(prior * _sigmoid(at_p) / a.n)
    g_w, g_c = g_w - h_w, g_c - h_c
    if clean < 0:
        return -g_w, -g_c
    t_w, t_c = a.gradient(-prior * _sigmoid(-at_p) / a.n)
    return g_w + t_w, g_c + t_c


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray],
        prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Known words, sorted, their weights, and the constant."""
    in_positive, n_p = np.unique(np.concatenate(positive), return_counts=True)
    in_unlabelled, n_u = np.unique(np.concatenate(unlabelled), return_counts=True)
    known = np.union1d(in_positive, in_unlabelled)
    p, u = np.zeros(len(known)), np.zeros(len(known))
    p[np.searchsorted(known, in_positive)] = n_p
    u[np.searchsorted(known, in_unlabelled)] = n_u
    share = (p + u) / (len(positive) + len(unlabelled))
    error = np.sqrt(share * (1 - share) * (1 / len(positive) + 1 / len(unlabelled)))
    telling = np.abs(p / len(positive) - u / len(unlabelled)) / np.maximum(error, 1e-12)
    chosen = np.flatnonzero((p + u >= MIN_TEXTS) & (telling >= MIN_Z))
    chosen = np.sort(chosen[np.argsort(-telling[chosen], kind="stable")][:MAX_FEATURES])
    known = known[chosen]
    a, b = _Texts(positive, known), _Texts(unlabelled, known)
    weights, constant = np.zeros(len(known)), float(np.log(prior / (1 - prior)))
    m_w, v_w, m_c, v_c = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        g_w, g_c = nonnegative_step(a, b, weights, constant, prior)
        g_w = g_w + DECAY * weights
        m_w, v_w = 0.9 * m_w + 0.1 * g_w, 0.999 * v_w + 0.001 * g_w ** 2
        m_c, v_c = 0.9 * m_c + 0.1 * g_c, 0.999 * v_c + 0.001 * g_c ** 2
        fix_m, fix_v = 1 - 0.9 ** step, 1 - 0.999 ** step
        weights = weights - RATE * (m_w / fix_m) / (np.sqrt(v_w / fix_v) + 1e-8)
        constant -= RATE * (m_c / fix_m) / (np.sqrt(v_c / fix_v) + 1e-8)
    return known, weights, constant


class Model:
    def __init__(self, known: np.ndarray, weights: np.ndarray, constant: float):
        self.known, self.weights, self.constant = known, weights, constant

    @staticmethod
    def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS,
              prior: float | None = None) -> Model:
        """``labels`` has ``doc_id, toxic``; ids that are labelled twice are toxic if one row is.

        ``prior`` is, if not given, the share of toxic rows among the labelled ones of ``docs``.
        """
        marks = (labels.where("doc_id is not null and toxic is not null")
                 .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
        rows = docs.where("doc_id is not null").select("doc_id", "text")
        marked = rows.select("doc_id").join(marks, "doc_id")
        if prior is None:
            share = marked.agg(F.avg("toxic")).first()[0]
            prior = DEFAULT_PRIOR if share is None else min(0.9, max(1e-3, share))
        # Ids are joined and sampled first, and then the texts of the few that are left.
        chosen = about(marked.where("toxic = 1").distinct(), sample, F.col("doc_id"))
        toxic = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id")
        others = about(rows, sample, F.col("doc_id"))
        held = _features(toxic.select("text", F.lit(True).alias("toxic")).union(
            others.select("text", F.lit(False).alias("toxic"))))
        lists: dict[bool, list[np.ndarray]] = {True: [], False: []}
        for batch in held.toArrow().to_batches():
            for mark, words in zip(batch["toxic"].to_pylist(), batch["words"]):
                lists[mark].append(np.asarray(words.values).view(np.uint64))
        if not any(map(len, lists[True])) or not any(map(len, lists[False])):
            constant = float(np.log(prior / (1 - prior)))
            return Model(np.empty(0, np.uint64), np.empty(0), constant)
        return Model(*fit(lists[True], lists[False], prior))

    def scores(self, texts: pa.Array) -> np.ndarray:
        lists = list(_text_features(texts))
        return _sigmoid(_Texts(lists, self.known).margins(self.weights, self.constant))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = shared.value
        for texts in batches:
            parts = [held.scores(pa.array(texts[low:low + 256], pa.string()))
                     for low in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    judged = docs.withColumn("score", score(F.col("text").cast("string")))
    return judged.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
