"""Supervised subword embeddings for document quality.

Features of a text are hashed into ``buckets`` rows of vectors: its words, the byte n-grams of its words (with their
edges), and for each pair of neighbouring words whether the text has had that pair before. The vectors of each family
are averaged, the three averages added, and a softmax layer on the sum gives the probabilities of the two labels.
Vectors and layer are learned together by stochastic gradient descent (adaptive step sizes) in numpy.

Learning takes place in one task on at most ``fit_rows`` labelled texts, those with the smallest id hashes; this is the
documented bound of the sample. The model that leaves it is one number per bucket: averages and the layer are linear,
so a vector counts only by its product with the difference of the two label rows. Scoring reads every whole text.

Defined results: a null or empty text has no features and gets the score of the bias; without labels, or with labels
of one kind, the score of every text is the smoothed share of label 1 (0.5 without any); labels of ids without a text,
and null labels, are ignored; of labels that repeat for an id the largest counts, of texts the smallest.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.llm.flat import FlatTexts

BUCKETS = 1 << 17
DIMENSIONS = 8
FIT_ROWS = 4000
THRESHOLD = 0.3
GRAMS = (3, 4, 5)
#: The two features of word pairs; hashed features never take their rows.
FRESH, AGAIN = 0, 1


def families(flat: FlatTexts, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every feature, for each of the three families."""
    room = np.uint64(buckets - 2)
    words = (flat.hashes % room).astype(np.int64) + 2
    where, found = [], []
    text_of = np.repeat(np.arange(len(flat)), np.diff(flat.bounds))
    spaces = np.concatenate([[0], np.cumsum(flat.space)])
    code = flat.data.astype(np.uint64)
    code[flat.space] = 0  # any white space is the edge of a word
    for n in GRAMS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        # white space only at the ends of the window, and the window within one text
        good = (spaces[n - 1 : n - 1 + size] == spaces[1 : 1 + size]) & (text_of[:size] == text_of[n - 1 :])
        at = np.flatnonzero(good)
        gram = np.full(len(at), n, np.uint64)
        for k in range(n):
            gram = (gram << np.uint64(8)) | code[at + k]
        found.append((common.mix64(gram) % room).astype(np.int64) + 2)
        where.append(text_of[at])
    grams = (np.concatenate(where), np.concatenate(found)) if where else (np.zeros(0, np.int64),) * 2
    pairs, text, _ = flat.runs(2)
    key = common.mix64(pairs + text.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), np.int64)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return [grams, (flat.owner, words), (text, np.where(again == 1, AGAIN, FRESH))]


def logits(flat: FlatTexts, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(flat), bias)
    for text, bucket in families(flat, len(weights)):
        count = np.bincount(text, minlength=len(flat))
        out += np.bincount(text, weights[bucket], minlength=len(flat)) / np.maximum(count, 1)
    return out


def _rows(flat: FlatTexts, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, weights) of each text: the average as a sparse row."""
    keys, values = [], []
    for text, bucket in families(flat, buckets):
        count = np.bincount(text, minlength=len(flat))
        keys.append(text * buckets + bucket)
        values.append(1 / count[text])
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(place, np.concatenate(values), minlength=len(key))
    cut = np.searchsorted(key, np.arange(1, len(flat)) * buckets)
    return list(zip(np.split((key % buckets).astype(np.int32), cut), np.split(value.astype(np.float32), cut)))


def fit(texts: list[bytes], labels: np.ndarray, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, epochs: int = 12, batch: int = 64, step: float = 0.25, seed: int = 7) -> tuple[np.ndarray, float]:
    """(one number per bucket, bias): the logit of label 1 is bias plus the families' averages of these numbers."""
    ones = int(labels.sum())
    prior = float(np.log((ones + 1) / (len(labels) - ones + 1)))
    if not len(labels) or ones in (0, len(labels)):
        return np.zeros(buckets, np.float32), prior
    rows = []
    for at in range(0, len(texts), 64):
        rows += _rows(FlatTexts(pa.array(texts[at : at + 64], pa.large_binary())), buckets)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (buckets, dimensions)).astype(np.float32)
    layer = np.zeros((2, dimensions), np.float32)
    layer[0, : dimensions // 2] = layer[1, dimensions // 2 :] = 0.5
    bias = np.array([0.0, prior], np.float32)
    seen = np.full((buckets, 1), 1e-8, np.float32)
    seen_layer, seen_bias = np.full_like(layer, 1e-4), np.full_like(bias, 1e-4)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        pace = step * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            ids = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            which = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            used, place = np.unique(ids, return_inverse=True)
            part = vectors[used]
            hidden = np.stack([np.bincount(which, values * part[place, d], minlength=len(chosen)) for d in range(dimensions)], 1)
            raw = hidden @ layer.T + bias
            p = np.exp(raw - raw.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            p /= len(chosen)
            back = p @ layer
            slope = np.stack([np.bincount(place, values * back[which, d], minlength=len(used)) for d in range(dimensions)], 1)
            seen[used, 0] += (slope**2).mean(1)
            vectors[used] -= (pace * slope / np.sqrt(seen[used])).astype(np.float32)
            slope = p.T @ hidden
            seen_layer += slope**2
            layer -= (pace * slope / np.sqrt(seen_layer)).astype(np.float32)
            slope = p.sum(0)
            seen_bias += slope**2
            bias -= (pace * slope / np.sqrt(seen_bias)).astype(np.float32)
    return (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """A model from (doc_id, text) and (doc_id, quality); ``labels`` holds what may be learned from."""
    common.prepare(docs.sparkSession)
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    sample = good.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # at most fit_rows pairs of numbers
    texts = docs.select("doc_id", common.text_bytes().alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        model = fit(rows["text"].tolist(), (rows["quality"] > 0).to_numpy().astype(np.int64))
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    # one bounded group: at most fit_rows texts
    found = texts.groupBy(F.lit("all").alias("__all")).applyInPandas(train, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else fit([], np.zeros(0, np.int64))


def score(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 (in place of a column of that name, if there is one).

    The model is ``BUCKETS`` numbers, whatever the data.
    """
    common.prepare(docs.sparkSession)
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    text = common.text_bytes()
    rows = docs.withColumn("__text_bytes", text).drop(name)
    columns = rows.columns[:-1]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = FlatTexts(batch.column(len(columns)))
        p = 1 / (1 + np.exp(-logits(flat, shared.value, bias)))
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(p)], [*columns, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]) + f", `{name}` double"
    return rows.mapInArrow(common.in_batches(work, rows=512, size=2 << 20), schema)
