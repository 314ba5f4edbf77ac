"""The learned operators on rows they have not learned from."""

import zlib

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clickloom.llm import queries, sampling, toxicity, words


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op5_language_id(spark, folder)
    docs = queries.table(spark, folder, "documents").where("lang is not null")
    held = docs.join(found, "doc_id").where("held_out and lang_pred <> 'und'").agg(
        F.count("*").alias("n"),
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"))
    row = held.first()
    assert row["n"] > 100 and row["right"] >= 0.99


def training_rows():
    """Documents of the training folds 1 to 4, with their fold and label; fold 0 is not read."""
    folder = "/root/testdata/sf0.1"
    fold = {k: zlib.crc32(str(k).encode()) % 5 for k in range(20_000)}
    rows = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by 1").fetchall()
    labels = dict(duckdb.sql(
        f"select doc_id, max(toxic) from '{folder}/labels.parquet' group by 1").fetchall())
    return [(text, fold[k], labels.get(k)) for k, text in rows if fold[k]]


def cross_validated(rows, features):
    """Shares of toxic and of clean documents that are told right, each by a model of other folds."""
    found = {0: [], 1: []}
    for held in range(1, 5):
        learned = [(f, label) for f, (_, fold, label) in zip(features, rows) if fold != held]
        prior = np.mean([label for _, label in learned if label is not None])
        model = toxicity.fit([f for f, label in learned if label == 1], [f for f, _ in learned],
                             prior)
        tested = [(f, label) for f, (_, fold, label) in zip(features, rows)
                  if fold == held and label is not None]
        margins = toxicity._Texts([f for f, _ in tested], model[0]).margins(*model[1:])
        for (_, label), margin in zip(tested, margins):
            found[label].append((margin >= 0) == (label == 1))
    return np.mean(found[1]), np.mean(found[0])


def test_toxicity_features_are_chosen_on_training_folds():
    """Beginnings are kept because they tell more rows right on folds 1 to 4, each held out once."""
    rows = training_rows()
    texts = pa.array([r[0] for r in rows], pa.string())
    alone = [np.unique(hashes[low:high])
             for _, hashes, cuts in words.words_by_text(texts, toxicity._IS_WORD)
             for low, high in zip(cuts[:-1], cuts[1:])]
    with_words = cross_validated(rows, alone)
    with_beginnings = cross_validated(rows, list(toxicity._text_features(texts)))
    assert sum(with_beginnings) > sum(with_words) + 0.05
    assert with_beginnings[0] >= 0.93 and with_beginnings[1] >= 0.99


def test_toxicity_of_a_training_fold(spark):
    """Fold 1 of the training rows by a model of folds 2 to 4; the bounds are those of the folds."""
    folder = "/root/testdata/sf0.1"
    docs = queries.table(spark, folder, "documents").select("doc_id", "text").withColumn(
        "fold", sampling.fold(F.col("doc_id"), 5))
    labels = queries.table(spark, folder, "labels")
    model = toxicity.Model.learn(docs.where("fold > 1"), labels)
    counts = {(r.toxic, r.predicted): r["count"] for r in toxicity.predict(
        docs.where("fold = 1"), model).join(labels, "doc_id").where("toxic is not null")
        .groupBy("toxic", "predicted").count().collect()}
    toxic = counts.get((1, 1), 0) / (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    clean = counts.get((0, 0), 0) / (counts.get((0, 0), 0) + counts.get((0, 1), 0))
    assert toxic >= 0.93 and clean >= 0.99


def test_beginnings_are_hashed_like_words_of_the_same_bytes():
    texts = pa.array(["Worthless worthles wort", None, "", "été", "a worthy"])
    begun = [h[low:high].tolist() for _, h, cuts in words.words_by_text(texts, width=5)
             for low, high in zip(cuts[:-1], cuts[1:])]
    whole = words.word_hashes(np.frombuffer(b"worth \xc3\xa9t\xc3\xa9", dtype=np.uint8))[0].tolist()
    assert begun == [[whole[0]] * 2, [], [], [whole[1]], [whole[0]]]
