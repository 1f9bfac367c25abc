"""Toxicity: non-negative positive-unlabelled learning of a text classifier.

Confirmed toxic examples (P) and unlabelled text (U) train a linear model; rows
labelled as clean are not used as such.  With the class prior pi the clean class
is seen only through U, so its risk is E_U[l(-g)] - pi E_P[l(-g)]; where this
estimate falls below zero the model has begun to fit U's hidden positives, and
the step goes the other way (the non-negative risk estimator).

A text's features are its distinct words and word beginnings, hashed to BINS.
The prior is a count over all labelled learning rows; P and U are samples of at
most MOST_TOXIC and MOST_UNLABELLED ids, a text each, taken in the order of a hash.
Their features are found in the tasks; training is numpy on the driver over those
bounded samples; scoring is one pass over all
whole texts on the executors.

Cases: null and empty texts get the score of a text without features; rows
without an id are held out and never learned from; repeated label rows count
once; labels that name no document are ignored; without any toxic example every
score is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.textgrams import pieces_of, words_of

BINS = 1 << 22
BEGINNINGS = (4, 5, 6)
#: Evidence (log-likelihood ratio) that a feature needs; chance alone gives less over all BINS.
LEAST_EVIDENCE = 15.0
#: Toxic texts that have a feature at least.
LEAST_TEXTS = 3
MOST_TOXIC, MOST_UNLABELLED, MOST_FEATURES = 2000, 6000, 2048
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bin) of every word and word beginning; may repeat."""
    w = words_of(texts, lower=True)
    bins = [w.hash, *(w.beginning(n) for n in BEGINNINGS)]
    return np.tile(w.doc, len(bins)), (np.concatenate(bins) >> np.uint64(42)).astype(np.int64)


def presence(doc: np.ndarray, column: np.ndarray, n_docs: int, width: int) -> np.ndarray:
    """0/1 matrix of which text has which column (columns below 0 are left out)."""
    out = np.zeros(n_docs * width, np.float32)
    has = column >= 0
    out[doc[has].astype(np.int64) * width + column[has]] = 1
    return out.reshape(n_docs, width)


@dataclass
class Model:
    column_of: np.ndarray  # bin -> column, -1 if unused
    weight: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        doc, b = text_features(texts)
        g = presence(doc, self.column_of[b], len(texts), len(self.weight)) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -30, 30).astype(float)))


@dataclass
class Sample:
    """Texts as features: (text, bin) of every bin that a text has, and packed bits of hashed words."""

    size: int
    doc: np.ndarray
    bin: np.ndarray
    words: np.ndarray

    def counts(self) -> np.ndarray:
        """Number of texts that have each bin."""
        return np.bincount(self.bin, minlength=BINS)

    def matrix(self, column_of: np.ndarray, width: int) -> np.ndarray:
        return presence(self.doc, column_of[self.bin], self.size, width)

    def take(self, rows: np.ndarray) -> Sample:
        place = np.full(self.size, -1, np.int32)
        place[rows] = np.arange(len(rows))
        kept = place[self.doc] >= 0
        return Sample(len(rows), place[self.doc[kept]], self.bin[kept], self.words[rows])


WORD_BITS = 12


def _features(only: np.ndarray | None):
    """(doc_id, bins, words): what a Sample needs of each text, bounded however long it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text"):
                for at in range(0, part.num_rows, 1024):
                    yield some(part.slice(at, 1024))

    def some(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, b = text_features(part.column("text"))
        pair = np.unique(doc * BINS + b)
        if only is not None:
            pair = pair[np.isin(pair % BINS, only)]
        ends = np.searchsorted(pair, np.arange(part.num_rows + 1) * BINS).astype(np.int32)
        bins = pa.ListArray.from_arrays(pa.array(ends), pa.array((pair % BINS).astype(np.int32)))
        words = pa.nulls(part.num_rows, pa.binary())
        if only is None:
            w = words_of(part.column("text"), lower=True)
            rows = presence(w.doc, (w.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64), part.num_rows, 1 << WORD_BITS)
            words = pa.array([x.tobytes() for x in np.packbits(rows.astype(bool), axis=1)], pa.binary())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), bins, words], names=["doc_id", "bins", "words"])

    return run


def _sample(texts: DataFrame, only: np.ndarray | None = None) -> Sample:
    """The features of a bounded number of rows (doc_id, text), in the order of a hash of the id.

    With ``only`` the bins are those, and the words stay behind.
    """
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_features(only), "doc_id long, bins array<int>, words binary")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().combine_chunks()
    bins = got.column("bins").combine_chunks()
    bins = bins.chunk(0) if isinstance(bins, pa.ChunkedArray) else bins
    doc = np.repeat(np.arange(got.num_rows, dtype=np.int32), bins.value_lengths().to_numpy(zero_copy_only=False))
    packed = np.zeros((got.num_rows, 0), np.uint8)
    if only is None:
        packed = np.frombuffer(b"".join(got.column("words").to_pylist()), np.uint8).reshape(got.num_rows, (1 << WORD_BITS) // 8)
    return Sample(got.num_rows, doc, bins.flatten().to_numpy(zero_copy_only=False), packed)


def _unlike(texts: Sample, most: float = 0.5) -> np.ndarray:
    """Rows that share at most ``most`` of their words with an earlier kept row.

    Copies of one example would make each of its words look toxic.
    """
    x = np.unpackbits(texts.words, axis=1).astype(np.float32)
    size, kept = x.sum(1), []
    for i in range(texts.size):
        n = len(kept)  # kept rows lie at the front of x and size
        both = x[:n] @ x[i]
        if not np.any(both > most * (size[:n] + size[i] - both)):
            x[n], size[n] = x[i], size[i]
            kept.append(i)
    return np.asarray(kept, int)


def risk_slopes(gp: np.ndarray, gu: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The clean risk E_U[l(-g)] - prior E_P[l(-g)] and the slopes of a training step by g.

    They are those of prior E_P[l(g)] + clean risk; where the clean risk is below
    zero, those of minus the clean risk alone.
    """
    neg_p, neg_u = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))  # slopes of l(-g)
    risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    clean_p, clean_u = -prior * neg_p / len(gp), neg_u / len(gu)
    if risk < 0:
        return risk, -clean_p, -clean_u
    return risk, clean_p - prior * (1 - neg_p) / len(gp), clean_u


def fit(toxic: Sample, unlabelled: Sample, prior: float, steps: int = 300) -> Model:
    """Minimise the non-negative PU risk of the logistic loss with Adam."""
    toxic = toxic.take(_unlike(toxic))
    in_toxic = toxic.counts()
    seen = np.flatnonzero(in_toxic >= LEAST_TEXTS)
    p, u = in_toxic[seen] / toxic.size, unlabelled.counts()[seen] / max(unlabelled.size, 1)
    clean = np.maximum(u - prior * p, 0) / max(1 - prior, 1e-9)
    # Log-likelihood ratio of the count in P against the (smoothed) clean rate.
    count, wanted = p * toxic.size, (clean + 2 / max(unlabelled.size, 1)) * toxic.size
    evidence = np.where(count > wanted, count * np.log(count / wanted) - count + wanted, 0)
    order = np.argsort(-evidence, kind="stable")[:MOST_FEATURES]
    order = seen[order[evidence[order] > LEAST_EVIDENCE]]
    column_of = np.full(BINS, -1, np.int16)
    column_of[order] = np.arange(len(order))
    xp, xu = (some.matrix(column_of, len(order)) for some in (toxic, unlabelled))
    w, bias = np.zeros(len(order), np.float32), 0.0
    m, v = np.zeros(len(order) + 1), np.zeros(len(order) + 1)
    for t in range(1, steps + 1):
        _, slope_p, slope_u = risk_slopes(xp @ w + np.float32(bias), xu @ w + np.float32(bias), prior)
        slope_p, slope_u = slope_p.astype(np.float32), slope_u.astype(np.float32)
        grad = np.r_[slope_p @ xp + slope_u @ xu + 1e-4 * w, slope_p.sum() + slope_u.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = (w - step[:-1]).astype(np.float32), bias - step[-1]
    return Model(column_of, w, float(bias - _cut(xp @ w + np.float32(bias), xu @ w + np.float32(bias), prior)))


def _cut(gp: np.ndarray, gu: np.ndarray, prior: float) -> float:
    """The decision value with the least non-negative PU risk of the zero-one loss."""
    values = np.unique(np.r_[gp, gu])
    edges = np.r_[values[0] - 1, (values[:-1] + values[1:]) / 2, values[-1] + 1]
    hit_p = 1 - np.searchsorted(np.sort(gp), edges) / len(gp)
    hit_u = 1 - np.searchsorted(np.sort(gu), edges) / len(gu)
    risk = prior * (1 - hit_p) + np.maximum(hit_u - prior * hit_p, 0)
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    return float((edges[best[0]] + edges[best[-1]]) / 2)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model | None:
    """The model of the learning rows (remainder not 0); None without toxic ones."""
    ours = remainder(F.col("doc_id"), folds) != 0
    known = labels.where(ours & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not count["toxic"]:
        return None
    draw = F.xxhash64("doc_id")
    picked = known.where("toxic = 1").orderBy(draw, "doc_id").limit(MOST_TOXIC).select("doc_id")
    slim = docs.where(ours).select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = slim.count()
    # A hash threshold draws twice the wanted rows; the order of the hash cuts them to the bound.
    share = min(1.0, 2 * MOST_UNLABELLED / max(total, 1))
    drawn = slim.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    few = drawn.select("doc_id").distinct().orderBy(draw, "doc_id").limit(MOST_UNLABELLED)
    # An id may stand in many rows: one of its texts is learned from.
    def texts(ids: DataFrame) -> DataFrame:  # as many ids as the bounds at most
        return slim.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))

    toxic = _sample(texts(picked))
    # A bin in fewer toxic texts is no feature, so others need not say that they have it.
    unlabelled = _sample(texts(few), np.flatnonzero(toxic.counts() >= LEAST_TEXTS))
    if not toxic.size or not total:
        return None
    prior = min(max(count["toxic"] / count["n"], 1e-3), 0.9)
    return fit(toxic, unlabelled, prior)


def score(docs: DataFrame, model: Model | None, folds: int = 5) -> DataFrame:
    """SCHEMA rows of all ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text"):
                s = shared.value.score(part.column("text")) if shared.value else np.zeros(part.num_rows)
                cols = [part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    held = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(True))
    return docs.select(
        F.col("doc_id").cast("long"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows the model rejects; the columns stay.

    The text is scored where it lies, so no join by id is needed.
    """
    model = learn(docs, labels)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = part.column("text")
                yield part.filter(pa.array(shared.value.score(texts) < 0.5))

    return docs.mapInArrow(run, docs.schema)
