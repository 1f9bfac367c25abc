"""Embedding near-dedup by a pivot-permutation index.

Two vectors link when their labels are equal and their cosine, in double
precision, is ``least_cosine`` or more.

1. Equal vectors of a label form a class; the index and the verification run over
   classes, and counts weigh them by their copies.
2. PIVOTS reference points are drawn from a fixed sample of SAMPLE classes, each
   apart from all others, so a dense group of vectors gets one pivot and not many.
   A class is described by its NEAREST nearest pivots in order of distance; every
   class is described and indexed.
3. Inverted lists: a class is posted under the pivots of its description, with the
   pivots numbered from the rarest on.  Two classes that share SHARED pivots have
   one of their NEAREST - SHARED + 1 lowest ones in common, so only these postings
   are made.  A pair counts in the list of its lowest shared pivot alone.
4. A list of a label may hold a large share of all rows.  It is cut into blocks of
   about BLOCK_ROWS postings, and each two blocks meet in a task of their own,
   where shared pivots are counted by popcounts, then the pairs that share enough
   are verified on the vectors themselves.
5. What leaves a task is one row for each linked class of the two blocks: the
   copies that it links with, and the least class it is connected with there.
   Pairs are never listed.  The latter rows are the edges of the components.

The search is approximate only in step 3: a link whose ends share fewer than
SHARED of their nearest pivots is missed (README has the measured recall).

Cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a label, link with nothing; vectors of different lengths do not
link; repeated rows are one class; a null id joins its class, and the id of a
component is null only if all its ids are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import written
from rosterline.llm.components import components

#: Reference points, the classes they are drawn from, and the largest cosine of two of them.
PIVOTS, SAMPLE, PIVOT_COSINE = 256, 4096, 0.8
#: Pivots of a description, and how many of them a candidate shares.
NEAREST, SHARED = 12, 5
#: Postings of one block of an inverted list.
BLOCK_ROWS = 2048
#: Pairs whose shared pivots are counted, and that are verified, in one step.
STEP_PAIRS = 1 << 20
_WORDS = PIVOTS // 64
_POSTING = "label long, pivot int, node long, copies long, vector binary, bits binary"


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    zero = F.forall(vector, lambda c: c == 0)
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & ~zero


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small entries."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _fitted(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """Vectors of any lengths cut or filled up with zeros, for the description alone."""
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        u = _units(v[None, :])[0][:dims]
        row[: len(u)] = u
    return out


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


# ---------------------------------------------------------------------------
# Classes, pivots, descriptions
# ---------------------------------------------------------------------------


def classes_of(rows: DataFrame) -> DataFrame:
    """One written row per distinct usable vector of a label; k1 and k2 name it."""
    grouped = rows.where("usable").groupBy("label", "k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("vector").alias("vector")
    )
    return written(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")


def choose_pivots(classes: DataFrame) -> np.ndarray:
    """At most PIVOTS unit vectors, in the order of a hash, no two closer than PIVOT_COSINE."""
    drawn = classes.select("vector", "k1", "k2").orderBy("k1", "k2").limit(SAMPLE).collect()  # SAMPLE vectors at most
    vectors = [np.array(r["vector"], float) for r in drawn]
    lengths = [len(v) for v in vectors]
    sample = _fitted(vectors, max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 1)
    chosen: list[np.ndarray] = []
    for v in sample:
        if len(chosen) < PIVOTS and v.any() and (not chosen or (np.array(chosen) @ v).max() < PIVOT_COSINE):
            chosen.append(v)
    return np.array(chosen).reshape(-1, sample.shape[1])


def _nearest(vectors: list[np.ndarray], pivots: np.ndarray) -> np.ndarray:
    """The NEAREST pivots of each vector, nearest first, ties by number."""
    cosine = _fitted(vectors, pivots.shape[1]) @ pivots.T
    return np.argsort(-cosine, axis=1, kind="stable")[:, :NEAREST]


def _frequencies(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pivots), np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_nearest(_lists(batch.column("vector")), pivots).ravel(), minlength=len(pivots))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pivot", "total"])

    return run


def _post(pivots: np.ndarray):
    """Postings of every class; ``pivots`` go from the rarest on."""
    schema = pa.schema([("label", pa.int64()), ("pivot", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()), ("bits", pa.binary())])
    near = min(NEAREST, len(pivots))
    lists = near - min(SHARED, near) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = _lists(part.column("vector"))
                own = np.sort(_nearest(vectors, pivots), axis=1)
                held = np.zeros((len(own), PIVOTS), bool)
                np.put_along_axis(held, own, True, axis=1)
                packed = np.packbits(held, axis=1, bitorder="little")
                rows = pa.array(np.repeat(np.arange(len(own)), lists))
                raw = pa.array([np.ascontiguousarray(v).tobytes() for v in vectors], pa.binary())
                bits = pa.array([b.tobytes() for b in packed], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label").take(rows), pa.array(own[:, :lists].ravel().astype(np.int32)),
                        part.column("node").take(rows), part.column("copies").take(rows), raw.take(rows), bits.take(rows),
                    ],
                    schema=schema,
                )

    return run


def postings(classes: DataFrame) -> DataFrame:
    """_POSTING rows of all classes, written."""
    pivots = choose_pivots(classes)
    if len(pivots):
        counts = np.zeros(len(pivots), np.int64)
        near = classes.select("vector").mapInArrow(_frequencies(pivots), "pivot long, total long")
        for r in near.groupBy("pivot").agg(F.sum("total").alias("total")).collect():  # PIVOTS rows
            counts[r["pivot"]] = r["total"]
        pivots = pivots[np.argsort(counts, kind="stable")]
    return written(classes.select("label", "node", "copies", "vector").mapInArrow(_post(pivots), _POSTING), "postings")


# ---------------------------------------------------------------------------
# Blocks of inverted lists
# ---------------------------------------------------------------------------


def _dealt(posted: DataFrame) -> DataFrame:
    """Postings with the pairs of blocks (first, second) that they take part in."""
    lists = posted.groupBy("label", "pivot").agg(F.count(F.lit(1)).alias("_n"))
    blocks = lists.select("label", "pivot", F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return (
        posted.join(blocks, ["label", "pivot"])
        .select("label", "pivot", "node", "copies", "vector", "bits", own.alias("_own"), other)
        .select(
            "label", "pivot", F.least("_own", "_other").alias("first"), F.greatest("_own", "_other").alias("second"),
            (F.col("_own") > F.col("_other")).alias("late"), "node", "copies", "vector", "bits",
        )
    )


def _linked(a: list, b: list | None, pivot: int, least_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked pairs between two blocks, or within one (i < j)."""
    own = b is None
    b = a if own else b
    bits_a, bits_b = (np.frombuffer(b"".join(r[3] for r in x), np.uint64).reshape(len(x), _WORDS) for x in (a, b))
    below = np.array([(1 << min(64, max(0, pivot - 64 * w))) - 1 for w in range(_WORDS)], np.uint64)
    unit_a = _by_length([r[2] for r in a])
    unit_b = unit_a if own else _by_length([r[2] for r in b])
    length_a, length_b = (np.array([len(r[2]) for r in x]) for x in (a, b))
    need = min(SHARED, int(np.bitwise_count(bits_a[0]).sum()))
    step = max(1, STEP_PAIRS // len(b))
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(a), step):
        some = bits_a[at : at + step]
        shared = np.zeros((len(some), len(b)), np.uint8)
        for w in range(_WORDS):
            shared += np.bitwise_count(some[:, w, None] & bits_b[None, :, w])
        i, j = np.nonzero(shared >= need)
        i += at
        if own:
            i, j = i[i < j], j[i < j]
        fits = (length_a[i] == length_b[j]) & ~((bits_a[i] & bits_b[j] & below).any(axis=1))
        i, j = i[fits], j[fits]
        for cut in range(0, len(i), STEP_PAIRS // 16):
            p, q = i[cut : cut + STEP_PAIRS // 16], j[cut : cut + STEP_PAIRS // 16]
            near = np.einsum("nd,nd->n", unit_a[p], unit_b[q]) >= least_cosine
            found_i.append(p[near])
            found_j.append(q[near])
    return np.concatenate(found_i), np.concatenate(found_j)


def _by_length(raw: list[bytes]) -> np.ndarray:
    """Unit vectors, filled up with zeros to the longest."""
    vectors = [np.frombuffer(r, np.float64) for r in raw]
    out = np.zeros((len(vectors), max(map(len, vectors))))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return _units(out)


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least place that each place is connected with."""
    root = np.arange(size)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root
        root = least


def _meet(least_cosine: float):
    """(node, links, root) of the linked classes of each two blocks of a list."""
    keys, columns = ("label", "pivot", "first", "second"), ("node", "copies", "vector", "bits")

    def groups(batches: Iterator[pa.RecordBatch]):
        key, sides = None, ([], [])
        for batch in batches:
            wide = [batch.column(c).to_pylist() for c in (*keys, "late", *columns)]
            for label, pivot, first, second, late, *row in zip(*wide):
                if key != (label, pivot, first, second):
                    if key:
                        yield key, sides
                    key, sides = (label, pivot, first, second), ([], [])
                sides[late].append(row)
        if key:
            yield key, sides

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, pivot, first, second), (a, b) in groups(batches):
            if first == second:
                a, b = sorted(a + b), None
                i, j = _linked(a, None, pivot, least_cosine)
                rows = a
            elif a and b:
                a, b = sorted(a), sorted(b)
                i, j = _linked(a, b, pivot, least_cosine)
                j, rows = j + len(a), a + b
            else:
                continue
            if not len(i):
                continue
            node, copies = (np.array([r[c] for r in rows], np.int64) for c in (0, 1))
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            some = np.flatnonzero(links)
            root = _roots(len(rows), i, j)[some]
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root])], names=["node", "links", "root"])

    return run


def linked_classes(classes: DataFrame, least_cosine: float) -> DataFrame:
    """(node, links, root): per list and class, the copies it links with and a class it is connected with, written."""
    keys = ("label", "pivot", "first", "second")
    dealt = _dealt(postings(classes)).repartition(*keys).sortWithinPartitions(*keys)
    return written(dealt.mapInArrow(_meet(least_cosine), "node long, links long, root long"), "met")


def near_duplicates(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", least_cosine: float = 0.98
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vector = F.col(vector_column).cast("array<double>")
    named = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), vector.alias("vector"),
        (_usable(vector) & F.col(label_column).isNotNull()).alias("usable"),
        F.xxhash64(vector).alias("k1"), F.xxhash64(F.lit(1), vector).alias("k2"),
    )
    classes = classes_of(named)
    met = linked_classes(classes, least_cosine)
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")))
    whole = (
        classes.select("label", "k1", "k2", "node", "copies", "least")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = whole.groupBy("root").agg(F.min("least").alias("component"))
    by_class = whole.join(least, "root").select(
        "label", "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component"
    )
    usable = named.where("usable").select("id", "label", "k1", "k2").join(by_class, ["label", "k1", "k2"]).select("id", "links", "component")
    alone = named.where("NOT usable OR usable IS NULL").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return usable.unionByName(alone).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
