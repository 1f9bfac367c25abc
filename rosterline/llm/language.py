"""Language ID: string-kernel classification with Nystroem landmarks.

The kernel of two texts is the number of byte n-grams (n = 1 to 4, the blended
spectrum) present in both, divided by the root of the product of their numbers
of n-grams; n-grams are hashed to BINS.  Landmark texts of every language give
the Nystroem map, and a kernel ridge regression per language (one versus rest)
is fitted on it.  The kernel is linear in the presence vector, so landmarks, map
and regression fold into one BINS x languages matrix, and a batch of texts is
scored by one matrix product.

Learning takes at most MOST_TEXTS different texts of each language, and of all
languages MOST_IN_ALL, in the order of a hash of id and text; of any number of
languages each gives one text at least, so every language that occurs is learned.
The n-grams of the sample are found in the tasks, and the driver gets BINS bits of a
text, however long it is.  Scoring is one pass over all whole texts.

Cases: a null text, or one without a letter, is ``und`` with score 0; rows with
a null language or id are not learned from, and a null id counts as held out;
repeated rows are scored alike; with nothing to learn from all rows are ``und``;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.textgrams import byte_grams, lower_ascii, pieces_of, text_bytes
from rosterline.llm.toxicity import remainder

BIN_BITS = 14
ORDERS = (1, 2, 3, 4)
MOST_TEXTS, MOST_LANDMARKS, MOST_IN_ALL = 300, 60, 60_000
RIDGE, SHARPNESS = 1e-3, 8.0
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def gram_presence(texts: pa.Array) -> np.ndarray:
    """0/1 matrix: which hashed n-gram occurs in which text."""
    raw, off = text_bytes(texts)
    raw = lower_ascii(raw)
    out = np.zeros((len(texts), 1 << BIN_BITS), np.float32)
    flat = out.reshape(-1)
    for n in ORDERS:
        doc, code = byte_grams(raw, off, n, BIN_BITS, salt=n)
        flat[(doc << BIN_BITS) | code] = 1
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


@dataclass
class Model:
    languages: list[str]
    matrix: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _unit(gram_presence(texts)) @ self.matrix


def fit(texts: pa.Array, langs: list[str]) -> Model:
    return fit_presence(np.packbits(gram_presence(texts).astype(bool), axis=1), langs)


def fit_presence(bits: np.ndarray, langs: list[str]) -> Model:
    """The model of packed presence rows."""
    languages = sorted(set(langs))
    number = {x: i for i, x in enumerate(languages)}
    y = np.asarray([number[x] for x in langs])
    most = max(1, min(MOST_LANDMARKS, 200 * MOST_LANDMARKS // len(languages)))
    seen = dict.fromkeys(range(len(languages)), 0)
    marks = []
    for i, c in enumerate(y):  # the first texts of each language
        if seen[c] < most:
            seen[c] += 1
            marks.append(i)

    def rows(which) -> np.ndarray:
        return _unit(np.unpackbits(bits[which], axis=1).astype(np.float32))

    marked = rows(marks)
    values, vectors = np.linalg.eigh((marked @ marked.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    gram, right = 0.0, 0.0
    for at in range(0, len(bits), 256):
        phi = (rows(slice(at, at + 256)) @ marked.T) @ root
        target = np.where(y[at : at + 256, None] == np.arange(len(languages)), 1.0, -1.0)
        gram, right = gram + phi.T @ phi, right + phi.T @ target
    weights = np.linalg.solve(gram + RIDGE * len(bits) * np.eye(gram.shape[0]), right)
    return Model(languages, (marked.T @ (root @ weights)).astype(np.float32))


def _packed_presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces_of(batch, "text"):
            for at in range(0, part.num_rows, 512):  # bounds the presence matrix
                some = part.slice(at, 512)
                bits = np.packbits(gram_presence(some.column("text")).astype(bool), axis=1)
                grams = pa.array([b.tobytes() for b in bits], pa.binary())
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("lang", "draw", "place")), grams], names=["lang", "draw", "place", "grams"])


def learn(docs: DataFrame, folds: int = 4, held: int = 2) -> Model | None:
    """The model of the learning rows (remainder not ``held``); None without any."""
    ours = docs.where(
        (remainder(F.col("doc_id"), folds) != held) & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    thin = ours.select("lang", "draw").distinct()  # repeated rows count once
    languages = thin.select("lang").distinct().count()
    if not languages:
        return None
    quota = max(1, min(MOST_TEXTS, MOST_IN_ALL // languages))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = thin.withColumn("place", first).where(F.col("place") <= quota)
    # MOST_IN_ALL rows at most, or one a language: no larger than the model itself.
    sample = ours.join(F.broadcast(drawn), ["lang", "draw"]).mapInArrow(_packed_presence, "lang string, draw long, place int, grams binary")
    got = sample.dropDuplicates(["lang", "draw"]).orderBy("place", "lang").select("lang", "grams").toArrow()
    bits = np.frombuffer(b"".join(got.column("grams").to_pylist()), np.uint8).reshape(got.num_rows, -1)
    return fit_presence(bits, got.column("lang").to_pylist())


def predict(docs: DataFrame, model: Model | None, folds: int = 4, held: int = 2) -> DataFrame:
    """SCHEMA rows of all ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                yield from some(part)

    def some(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, part.num_rows, 512):  # bounds the presence matrix
            rows = part.slice(at, 512)
            if shared.value is None:
                names, best = np.full(rows.num_rows, "und", object), np.zeros(rows.num_rows)
            else:
                s = shared.value.scores(rows.column("text")).astype(float)
                e = np.exp(SHARPNESS * (s - s.max(1, keepdims=True)))
                names = np.asarray(shared.value.languages, object)[s.argmax(1)]
                best = e.max(1) / e.sum(1)
                mute = ~np.asarray(rows.column("letters").to_pylist(), bool)
                names[mute], best[mute] = "und", 0.0
            cols = [rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(remainder(F.col("doc_id"), folds) == held, F.lit(True)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters"),
    ).mapInArrow(run, SCHEMA)
