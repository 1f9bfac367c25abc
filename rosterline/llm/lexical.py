"""Ranked lexical search: term at a time with a limit on accumulators.

Every document is ranked for every item of a query table by the summed weight of
the terms they share (whole numbers, see ``weights`` and ``_impacts``).

1. One pass counts, for the terms of the items alone, the documents that hold
   them, and for all documents their number and terms.
2. A second pass deals documents out by partition.  Each task takes its documents
   in chunks, makes the chunk's postings of the items' terms, and processes an
   item's terms from the rarest to the most frequent.  A document gets an
   accumulator when a term first touches it.  Once the largest contributions that
   the terms still to come have in this chunk cannot add up to the score that the
   k-th best document has so far, no accumulator is made any more; those that exist
   are brought to their exact score.
3. The k best of each task and item are merged by a ranking in two steps, so that
   no task gets what all tasks have found for an item.

Terms are compared by their bytes, not by hashes.  Items travel to the tasks in
blocks of about BLOCK_BYTES of text, each block with two passes of its own.

Cases: a null or empty text has no terms; an item without terms, or whose terms no
document holds, has no rows; equal rows of the item table are one item, an id with
several texts is ranked for each of them; repeated documents are ranked each, null
ids after all others at equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import written
from rosterline.llm.textgrams import lower_ascii, pieces_of, text_bytes

#: Bytes of item texts in a block, bytes of documents in a chunk.
BLOCK_BYTES, CHUNK_BYTES = 8 << 20, 16 << 20
#: Groups of tasks whose best documents are merged first.
MERGES = 64


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(text index, term) of every maximal run of ASCII letters, digits and code points from 0x80 on."""
    raw, off = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    low = lower_ascii(raw)
    inside = ((low >= 48) & (low <= 57)) | ((low >= 97) & (low <= 122)) | (low >= 128)
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside & ~(np.r_[False, inside[:-1]] & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.r_[inside[1:], False] & ~edge[1:])) + 1
    doc = np.searchsorted(off, start, "right") - 1
    ends = np.r_[0, np.cumsum(end - start)].astype(np.int64)
    data = pa.py_buffer(low[inside].tobytes())
    return doc, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.tobytes()), data])


def _codes(terms: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Number of each term in the vocabulary, or -1."""
    return pc.fill_null(pc.index_in(terms, vocabulary), -1).to_numpy().astype(np.int64)


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64)


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Items:
    """A block of items: ids and texts, their distinct terms, and by item the terms' numbers."""

    ids: list[int | None]
    texts: list[str | None]
    terms: pa.Array
    own: list[np.ndarray]


def _items(rows: list) -> Items:
    doc, terms = terms_of(pa.array([r["text"] for r in rows], pa.string()))
    terms = terms.dictionary_encode()
    code = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.searchsorted(doc, np.arange(len(rows) + 1))
    own = [np.unique(code[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return Items([r["item_id"] for r in rows], [r["text"] for r in rows], terms.dictionary, own)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The distinct (item_id, text) of ``items``, read to the driver block by block."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    rows = written(rows, "items")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_BYTES
        if got:
            yield _items(got)


# ---------------------------------------------------------------------------
# Statistics of all documents
# ---------------------------------------------------------------------------


def statistics(docs: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and the documents that hold each of the items' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(items.terms)  # a block's terms
    known = len(items.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(known + 2, np.int64)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                doc, terms = terms_of(part.column("text"))
                total[known] += len(np.unique(doc))
                total[known + 1] += len(doc)
                code = _codes(terms, shared.value)
                have = code >= 0
                pair = np.unique(doc[have] * known + code[have])
                total[:known] += np.bincount(pair % known, minlength=known)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "total"])

    holding = np.zeros(known + 2, np.int64)
    summed = docs.select("text").mapInArrow(count, "term long, total long").groupBy("term").agg(F.sum("total").alias("total"))
    for r in summed.collect():  # one row for a term of the block
        holding[r["term"]] = r["total"]
    return int(holding[known]), int(holding[known + 1]), holding[:known]


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------


@dataclass
class Postings:
    """Of a chunk, by term: documents (rising) and weighted contributions."""

    cut: np.ndarray
    doc: np.ndarray
    gain: np.ndarray
    most: np.ndarray
    size: int

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.cut[term], self.cut[term + 1]
        return self.doc[a:b], self.gain[a:b]


def accumulate(lists: Postings, terms: np.ndarray, k: int, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): all that may be among the k best, with exact scores.

    ``terms`` go from the rarest on; ``reached`` are the scores of documents of
    earlier chunks (k at most).
    """
    bound = np.r_[np.cumsum(lists.most[terms][::-1])[::-1], 0]
    score = np.zeros(lists.size, np.int64)
    touched, at = 0, 0
    while at < len(terms):
        if bound[at] == 0:
            break
        if touched + len(reached) >= k:
            known = np.concatenate([score[score > 0], reached])
            if len(known) >= k and bound[at] < np.partition(known, -k)[-k]:
                break
        doc, gain = lists.of(terms[at])
        score[doc] += gain
        touched += len(doc)
        at += 1
    alive = np.flatnonzero(score)
    total = score[alive]
    if len(alive):
        for term in terms[at:]:
            doc, gain = lists.of(term)
            if len(doc):
                place = np.minimum(np.searchsorted(doc, alive), len(doc) - 1)
                total += np.where(doc[place] == alive, gain[place], 0)
    return alive, total


def _postings(texts: list[pa.Array], vocabulary: pa.Array, weight: np.ndarray, documents: int, length: int) -> Postings:
    """``length``: all terms of all documents."""
    known, rows = len(vocabulary), 0
    docs, codes, counts = [], [], []
    for column in texts:
        doc, terms = terms_of(column)
        code = _codes(terms, vocabulary)
        n = np.bincount(doc, minlength=len(column))
        counts.append(n)
        have = code >= 0
        docs.append(doc[have] + rows)
        codes.append(code[have])
        rows += len(column)
    n, doc, code = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (counts, docs, codes))
    pair, tf = np.unique(code * max(rows, 1) + doc, return_counts=True)
    code, doc = pair // max(rows, 1), pair % max(rows, 1)
    m = 50 + (50 * n * documents) // max(length, 1)
    gain = weight[code] * _impacts(tf, m[doc])
    cut = np.searchsorted(code, np.arange(known + 1))
    most = np.zeros(known, np.int64)
    np.maximum.at(most, code, gain)
    return Postings(cut, doc, gain, most, rows)


def _search(items, weight: np.ndarray, holding: np.ndarray, documents: int, length: int, k: int):
    """(item, doc_id, score) of the k best documents of a task for each item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Items = items.value
        order = np.lexsort((np.arange(len(holding)), holding))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ranked = [own[np.argsort(place[own])] for own in block.own]
        none = np.zeros(0, np.int64)
        best = [(none, none, none) for _ in ranked]  # score, without id, id

        def take(parts: list[pa.RecordBatch]) -> None:
            lists = _postings([p.column("text") for p in parts], block.terms, weight, documents, length)
            ids = pa.concat_arrays([p.column("doc_id") for p in parts])
            without = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            number = pc.fill_null(ids, 0).to_numpy()
            for i, terms in enumerate(ranked):
                doc, total = accumulate(lists, terms, k, best[i][0])
                if len(doc):
                    old = best[i]
                    joint = np.r_[old[0], total], np.r_[old[1], without[doc]], np.r_[old[2], number[doc]]
                    first = np.lexsort((joint[2], joint[1], -joint[0]))[:k]
                    best[i] = tuple(x[first] for x in joint)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in pieces_of(batch, "text"):
                held.append(part)
                if sum(p.nbytes for p in held) >= CHUNK_BYTES:
                    take(held)
                    held = []
        if held:
            take(held)
        for i, (score, without, number) in enumerate(best):
            if len(score):
                ids = pa.array(number, mask=without.astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), i)), ids, pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _best(rows: DataFrame, k: int, *groups) -> DataFrame:
    by = Window.partitionBy("item", *groups).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        documents, length, holding = statistics(texts, block)
        weight = weights(documents, holding)
        run = _search(spark.sparkContext.broadcast(block), weight, holding, documents, length, k)
        near = texts.mapInArrow(run, "item long, doc_id long, score long")
        merged = _best(near.withColumn("merge", F.spark_partition_id() % MERGES), k, "merge")
        ranked = _best(merged.drop("merge", "rank"), k)
        names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        part = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        found = found.unionByName(part)
    return found


def search_sql(k: int = 50) -> str:
    """DuckDB SQL of ``search`` for tables ``documents`` and ``benchmark``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = f"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{run}')"
    return f"""
WITH listed AS (
  SELECT row_number() OVER () AS place, doc_id, {words} AS terms FROM documents WHERE text IS NOT NULL
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(coalesce(sum(len(terms)), 0) AS BIGINT) AS n_terms FROM listed
), wanted AS (
  SELECT DISTINCT item_id, text, unnest({words}) AS term FROM benchmark
), held AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM listed) t
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weighted AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term) d, totals
), scored AS (
  SELECT item_id, text, place, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS score
  FROM wanted JOIN held USING (term) JOIN weighted USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {k}
"""
