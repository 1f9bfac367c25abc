"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are grouped by size (powers of two of their distinct shingles).  A
short item inside a long document has a tiny Jaccard similarity with it, so for
each size class the document is cut into segments a few times as long as the
class's items, overlapping by one item: a copied item lies whole in a segment
and fills a known share of it.  Segments and items get MinHash signatures of one
hash pass (each bin keeps its least value), with PERMUTATIONS independent ones;
any equal bin makes the item a candidate of the document.  A few shingles can all
lose their bins, so items of under EXACT_BELOW shingles are looked up by each of
their shingles instead and none is missed; a larger one shares at least seven,
each of which is its bin's least with a chance of over 3/4 in each pass, so it is
missed with a probability of about 1e-9 at most.  Candidates are
verified by exact containment: the share of the item's distinct five-word
shingles that occur anywhere in the whole document.

The items are a stated query set: they are read in blocks of bounded size, each
of which is sent to all tasks and held against all documents in one pass.

Words are runs of bytes other than white space, A-Z lower-cased.  Cases: null or
empty texts, of items or documents, match nothing; a text of fewer than five
words is its whole sequence as one shingle; repeated rows match alike; empty
tables give no rows; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.textgrams import Words, mix, pieces_of, shingle_sets, windows, words_of

WORDS_PER_SHINGLE, LEAST_CONTAINMENT = 5, 0.8
#: Bytes of item text in a block, segment length in items, bins per segment shingle, signatures.
BLOCK_BYTES, SEGMENT_ITEMS, BINS_PER_SHINGLE, PERMUTATIONS = 32 << 20, 4, 2, 2
#: Smaller items are looked up by all their shingles.
EXACT_BELOW = 8
#: Bins per shingle up to which a dense array takes the bins' least values.
DENSE_BINS = 16
_FILTER_BITS = 22
SCHEMA = "doc_id long, item_id long, shared_shingles long, item_shingles long, containment double"


@dataclass
class SizeClass:
    """Signatures of the items of one size: sorted (permutation, value), and the item of each."""

    largest: int
    values: list[np.ndarray]
    items: list[np.ndarray]
    maybe: list[np.ndarray]  # bit filter over the low bits of values


@dataclass
class Items:
    ids: list
    sets: list[np.ndarray]
    classes: list[SizeClass]
    small: SizeClass  # all shingles of the items under EXACT_BELOW


def _signature(group: np.ndarray, value: np.ndarray, n_groups: int, bins: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, least value) of every bin of every group that has one."""
    h = mix(value + np.uint64(salt * 0x9E3779B9 + 1))
    at = group * bins + (h >> np.uint64(40)).astype(np.int64) % bins
    if n_groups * bins > DENSE_BINS * len(at):  # few shingles for so many bins
        order = np.lexsort((h, at))
        at, h = at[order], h[order]
        new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
        return at[new] // bins, h[new]
    least = np.full(n_groups * bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(least, at, h)
    has = np.flatnonzero(least != np.uint64(0xFFFFFFFFFFFFFFFF))
    return has // bins, least[has]


def _bins(largest: int) -> int:
    return max(64, largest * SEGMENT_ITEMS * BINS_PER_SHINGLE)


def _add(to: SizeClass, values: np.ndarray, items: np.ndarray) -> None:
    order = np.argsort(values, kind="stable")
    maybe = np.zeros(1 << _FILTER_BITS, bool)
    maybe[(values & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    to.values.append(values[order])
    to.items.append(items[order])
    to.maybe.append(maybe)


def _hits(c: SizeClass, salt: int, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(doc, item) rows of the values that the class has."""
    near = c.maybe[salt][(value & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]
    doc, value = doc[near], value[near]
    lo, hi = np.searchsorted(c.values[salt], value, "left"), np.searchsorted(c.values[salt], value, "right")
    times = hi - lo
    where = np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())
    return np.stack([np.repeat(doc, times), c.items[salt][where]], 1)


def index_items(ids: list, texts: pa.Array, n: int) -> Items:
    doc, value = shingle_sets(words_of(texts, lower=True), n)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [value[a:b] for a, b in zip(cut[:-1], cut[1:])]
    size = np.diff(cut)
    classes, small = [], SizeClass(EXACT_BELOW - 1, [], [], [])
    owner = np.repeat(np.arange(len(texts)), size)
    few = size[owner] < EXACT_BELOW
    _add(small, value[few], owner[few])
    for power in sorted({int(s).bit_length() for s in size if s >= EXACT_BELOW}):
        own = np.flatnonzero((size >= 1 << (power - 1)) & (size < 1 << power))
        largest = int(size[own].max())
        found = SizeClass(largest, [], [], [])
        group = np.repeat(np.arange(len(own)), size[own])
        flat = np.concatenate([sets[i] for i in own])
        for salt in range(PERMUTATIONS):
            g, v = _signature(group, flat, len(own), _bins(largest), salt)
            _add(found, v, own[g])
        classes.append(found)
    return Items(ids, sets, classes, small)


def _placed_shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place in the doc, hash) of every shingle, repeats too."""
    at, value = windows(words, n)
    doc = words.doc[at]
    place = at - words.first()[doc]
    count = np.diff(words.first())
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        d, v = shingle_sets(words, n)
        mine = np.isin(d, short)
        doc, place, value = np.r_[doc, d[mine]], np.r_[place, np.zeros(mine.sum(), np.int64)], np.r_[value, v[mine]]
    return doc, place, value


def candidates(words: Words, items: Items, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, item) that share a shingle (small items) or a bin of a segment's signature."""
    doc, place, value = _placed_shingles(words, n)
    pairs = [_hits(items.small, 0, doc, value)]
    for c in items.classes:
        length, step = c.largest * SEGMENT_ITEMS, c.largest * (SEGMENT_ITEMS - 1)
        segment = place // step
        early = (segment > 0) & (place % step < length - step)  # also at the end of the segment before
        per_doc = np.zeros(words.n_docs + 1, np.int64)
        np.maximum.at(per_doc, doc + 1, segment + 1)
        base = np.cumsum(per_doc)
        first = base[doc] + segment
        group = np.r_[first, first[early] - 1]
        both = np.r_[value, value[early]]
        owner = np.repeat(np.arange(words.n_docs), per_doc[1:])
        for salt in range(PERMUTATIONS):
            g, v = _signature(group, both, int(base[-1]), _bins(c.largest), salt)
            pairs.append(_hits(c, salt, owner[g], v))
    found = np.unique(np.concatenate(pairs), axis=0)
    return found[:, 0], found[:, 1]


def matches(texts: pa.Array, items: Items, n: int, least: float) -> Iterator[tuple[int, int, int, int]]:
    """(doc, item, shared, item size) of the verified candidates."""
    words = words_of(texts, lower=True)
    docs, found = candidates(words, items, n)
    if not len(docs):
        return
    d, v = shingle_sets(words, n)
    cut = np.searchsorted(d, np.arange(words.n_docs + 1))
    for i, j in zip(docs.tolist(), found.tolist()):
        mine, own = v[cut[i] : cut[i + 1]], items.sets[j]
        at = np.minimum(np.searchsorted(mine, own), len(mine) - 1)
        shared = int((mine[at] == own).sum())
        if shared >= least * len(own) - 1e-9:
            yield i, j, shared, len(own)


def _blocks(bench: DataFrame, n: int) -> Iterator[Items]:
    """The test items, indexed, in blocks of about BLOCK_BYTES of text."""
    slim = bench.select("item_id", "text").where("text is not null")
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    for b in range(blocks):
        got = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        if got.num_rows:
            got = got.combine_chunks()
            yield index_items(got.column("item_id").to_pylist(), got.column("text").chunk(0), n)


def find(docs: DataFrame, bench: DataFrame, n: int = WORDS_PER_SHINGLE, least: float = LEAST_CONTAINMENT) -> DataFrame:
    """SCHEMA rows: every document and test item with at least ``least`` containment."""
    spark = docs.sparkSession
    schema = pa.schema([(f.split()[0], pa.float64() if f.endswith("double") else pa.int64()) for f in SCHEMA.split(", ")])
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    out = spark.createDataFrame([], SCHEMA)

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces_of(batch, "text"):
                    items, ids = shared.value, part.column("doc_id")
                    rows = [
                        (ids[i].as_py(), items.ids[j], s, m, s / m)
                        for i, j, s, m in matches(part.column("text"), items, n, least)
                    ]
                    cols = zip(*rows) if rows else [()] * len(schema)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        return run

    for items in _blocks(bench, n):
        out = out.unionByName(slim.mapInArrow(search(spark.sparkContext.broadcast(items)), SCHEMA))
    return out


def drop_contaminated(docs: DataFrame, bench: DataFrame, n: int = WORDS_PER_SHINGLE, least: float = LEAST_CONTAINMENT) -> DataFrame:
    """``docs`` without the rows that contain a test item; the columns stay."""
    spark, out = docs.sparkSession, docs

    def keep(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces_of(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    for i, *_ in matches(part.column("text"), shared.value, n, least):
                        clean[i] = False
                    yield part.filter(pa.array(clean))

        return run

    for items in _blocks(bench, n):
        out = out.mapInArrow(keep(spark.sparkContext.broadcast(items)), docs.schema)
    return out


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingles_sql(source: str, row: str, n: int) -> str:
    """DuckDB: distinct (row, shingle) of ``source``, fewer words as one shingle."""
    return f"""SELECT DISTINCT {row}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END) AS s
        FROM (SELECT {row}, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {source} WHERE text IS NOT NULL)"""


def find_sql(docs: str = "documents", n: int = WORDS_PER_SHINGLE, least: float = LEAST_CONTAINMENT) -> str:
    return f"""
WITH d AS (SELECT *, row_number() OVER () AS r FROM {docs}), b AS (SELECT *, row_number() OVER () AS q FROM benchmark),
ds AS ({shingles_sql("d", "r", n)}), bs AS ({shingles_sql("b", "q", n)}),
size AS (SELECT q, count(*) AS m FROM bs GROUP BY q),
hit AS (SELECT r, q, count(*) AS c FROM ds JOIN bs USING (s) GROUP BY r, q)
SELECT d.doc_id, b.item_id, c::BIGINT AS shared_shingles, m::BIGINT AS item_shingles, c::DOUBLE / m AS containment
FROM hit JOIN size USING (q) JOIN d USING (r) JOIN b USING (q) WHERE c >= {least} * m - 1e-9"""
