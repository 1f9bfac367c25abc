"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its word shingles (tokens).  Equal sets form a class;
the join runs between classes, one set for all copies.

1. Order.  A count sketch over all documents (a fixed number of cells) orders
   tokens by frequency; any fixed order is exact, a good one is fast.
2. Prefixes.  Two sets that link share at least k of their first
   size - ceil(t size) + k tokens.  For k = 2 a shared rare token of these longer
   prefixes is found through the token alone; if all that is shared is frequent,
   at least one pair of frequent tokens is, and only such pairs are indexed.
   Sets above COMBINED_SIZE, whose prefixes would give too many pairs, use k = 1;
   sets near the border are indexed both ways, so no link is lost.
3. Candidates.  Most keys belong to one document, or to one component only, and bring
   nobody together.  So thin rows (key, set, component) are counted first, and whole
   index rows are made for the keys that different components share.  These meet by
   key and pass filters that never reject a link: size, position, and the distance of
   256-bit parity maps, then of 1024-bit ones.  Sets that share many keys would meet
   at each; a key carries the tokens before it, and two sets with the same one have
   met before, so a pair comes out about once.
4. Verification compares the whole sets of the candidates, block by block.
5. Links between classes give components; a component's id is its least doc_id.

Components need a spanning forest, not every link, and in a cluster of near copies
the links grow with the square of its size.  So ROUNDS rounds of hubs go before step 3:
classes that share one of HASHES min-hashes are held against a few hubs of that
bucket alone, the pairs verified, and what links is contracted.  The join then asks only for pairs whose ends still lie in different
components.  A link inside a component changes nothing, so the result is the same;
``count_links`` leaves the rounds out and counts the links of every class.

Tokens are 64-bit hashes of shingles.  Words are runs of bytes other than white
space, A-Z lower-cased.

Cases: a null or empty text has the empty set and is linked with nothing; fewer
words than a shingle are one shingle; repeated rows are one class; rows with a
null id join their class, and the id of a component is null only if all its ids
are; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import written
from rosterline.llm.components import components
from rosterline.llm.textgrams import mix, pieces_of, shingle_sets, words_of

CELL_BITS, SKETCH_BLOCKS = 20, 64
#: Largest set whose prefix is indexed by pairs of frequent tokens.
COMBINED_SIZE = 400
#: Bits of the parity map that candidates are held against before their sets are read.
MAP_BITS = 1024
#: Words of the smaller parity map that index rows carry.
MAPS = ("b0", "b1", "b2", "b3")
#: Min-hashes of a set, by which it meets hubs, and random orders whose ends are a bucket's hubs.
HASHES, ORDERS = 4, 2
#: Rounds of hubs, each with orders of its own, and tokens before a key that tell whether a pair met before.
ROUNDS, TAILS = 2, 4
#: Bytes of sets in a block of pairs to verify.
BLOCK_BYTES = 4 << 20
LEAST_BLOCKS = 16


# ---------------------------------------------------------------------------
# Token order
# ---------------------------------------------------------------------------


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def token_counts(texts: DataFrame, n: int) -> np.ndarray:
    """Number of documents by cell of the token hash; the size is fixed.

    Each task sums its documents and passes on one compressed vector in blocks;
    the blocks are summed as they stream through their task.
    """
    block = (1 << CELL_BITS) // SKETCH_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for part in pieces_of(batch, "text"):
                _, tokens = shingle_sets(words_of(part.column("text"), lower=True), n)
                total += np.bincount(_cells(tokens), minlength=1 << CELL_BITS)
        if total.any():
            parts = [zlib.compress(total[i * block : (i + 1) * block].tobytes(), 1) for i in range(SKETCH_BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array(parts)], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(zlib.decompress(c), np.int64)
                sums[b] = sums[b] + own if b in sums else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
            names=["block", "counts"],
        )

    rows = texts.select("text").mapInArrow(count, "block int, counts binary").repartition(SKETCH_BLOCKS, "block")
    total = np.zeros(1 << CELL_BITS, np.int64)
    for r in rows.mapInArrow(add, "block int, counts binary").collect():  # SKETCH_BLOCKS rows
        total[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return np.minimum(total, (1 << 31) - 1).astype(np.int32)


# ---------------------------------------------------------------------------
# Sets, signatures and keys
# ---------------------------------------------------------------------------


def _prefix(size: int, percent: int) -> int:
    """Tokens of the longer prefix (k = 2)."""
    return min(size, size - -(-percent * size // 100) + 2)


def _keys(tokens: np.ndarray, rare: int, size: int, percent: int, name: int):
    """(key, place, tail, tail2, tail3, tail4) of one set's prefix, whose first ``rare`` tokens are rare.

    ``place`` is the token's position + 1, or 0 for a pair of frequent tokens.  The
    tails of a single token are the four tokens before it: two sets that share any of
    them share an earlier key, so the join skips them here.  For a pair ``tail`` and
    ``tail2`` are the two tokens before its second one, behind its first; one that is
    shared makes an earlier pair with the first.  ``tail3`` and ``tail4`` are the two
    before its first; one that is shared is an earlier key or makes an earlier pair.
    Without such a token a tail is the set's own name.
    """
    padded = np.r_[np.full(TAILS, name, np.int64), tokens]
    p = len(tokens)
    columns = [[tokens[:0]] for _ in range(2 + TAILS)]

    def add(*new: np.ndarray) -> None:
        for to, x in zip(columns, new, strict=True):
            to.append(x)

    def before(at: np.ndarray, back: int) -> np.ndarray:
        return padded[at + TAILS - back]

    def single(start: int, stop: int) -> None:
        at = np.arange(start, stop)
        add(tokens[at], at + 1, *(before(at, back) for back in range(1, TAILS + 1)))

    if size <= COMBINED_SIZE:
        single(0, rare)
        i, j = np.triu_indices(p - rare, 1)
        i, j = i + rare, j + rare
        both = np.sort(np.stack([tokens[i], tokens[j]]).view(np.uint64), axis=0)
        key = mix(both[0] * np.uint64(3) + mix(both[1])).view(np.int64)
        between = (np.where(j - i > back, before(j, back), name) for back in (1, 2))
        add(key, np.zeros(len(i), np.int64), *between, before(i, 1), before(i, 2))
    if 100 * size >= percent * COMBINED_SIZE:
        short = p - 1 if p < size or size - -(-percent * size // 100) + 2 == size else p
        start = rare if size <= COMBINED_SIZE else 0  # the rare ones are there already
        single(start, max(short, start))
    return tuple(np.concatenate(x) for x in columns)


_SET = f"doc_id long, t1 long, size long, k1 long, k2 long, {' long, '.join(MAPS)} long, rare int, tokens array<long>, map binary, least array<long>"


def _describe(n: int, percent: int, counts, frequent: float):
    """One row of _SET for every text."""
    names = [c.split()[0] for c in _SET.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text"):
                yield some(part)

    def some(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, tokens = shingle_sets(words_of(part.column("text"), lower=True), n)
        rows = part.num_rows
        size = np.bincount(doc, minlength=rows)
        sums = []
        for salt in (1, 2):
            total = np.zeros(rows, np.uint64)
            np.add.at(total, doc, mix(tokens + np.uint64(salt)))
            sums.append(total.view(np.int64))
        small = 64 * len(MAPS)
        odd = np.bincount(doc * small + ((tokens >> np.uint64(16)) & np.uint64(small - 1)).astype(np.int64), minlength=rows * small) & 1
        bits = np.packbits(odd.astype(bool)).view(np.int64).reshape(rows, len(MAPS))
        where = doc * MAP_BITS + ((tokens >> np.uint64(30)) & np.uint64(MAP_BITS - 1)).astype(np.int64)
        wide = np.packbits((np.bincount(where, minlength=rows * MAP_BITS) & 1).astype(bool)).tobytes()
        step = MAP_BITS // 8
        maps = pa.array([wide[i * step : (i + 1) * step] for i in range(rows)], pa.binary())
        least = np.full((rows, HASHES), -1, np.int64)
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else doc
        for h in range(HASHES):
            if len(doc):
                least[doc[begin], h] = np.minimum.reduceat(mix(tokens ^ mix(np.array([h + 11], np.uint64))), begin).view(np.int64)
        low = pa.FixedSizeListArray.from_arrays(pa.array(least.ravel()), HASHES).cast(pa.list_(pa.int64()))
        count = counts.value[_cells(tokens)]
        order = np.argsort((doc << 32) | count, kind="stable")  # ties by hash, as the sets are sorted
        tokens, count = tokens[order], count[order]
        cut = np.searchsorted(doc, np.arange(rows + 1))
        length = np.minimum(size, size - -(-percent * size // 100) + 2)
        inside = np.arange(len(tokens)) - cut[doc] < length[doc]
        rare = np.bincount(doc[inside & (count <= frequent)], minlength=rows)
        ends = pa.array(np.r_[0, np.cumsum(length)].astype(np.int32))
        prefix = pa.ListArray.from_arrays(ends, pa.array(tokens[inside].view(np.int64)))
        flat = [pa.array(x) for x in (size, *sums, *np.ascontiguousarray(bits.T), rare.astype(np.int32))]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("t1"), *flat, prefix, maps, low], names=names)

    return run


_THIN = ("key", "name", "root")
_WIDE = ("key", "name", "sp", *MAPS, "tail", "tail2", "tail3", "tail4", "root")


def _index(percent: int, whole: bool):
    """Index rows: _THIN ones of every key of a class, or _WIDE ones of its keys in ``shared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield some(batch.slice(at, 256))

    def lists(part: pa.RecordBatch, column: str) -> list[np.ndarray]:
        flat, ends = part.column(column).flatten().to_numpy(), np.r_[0, np.cumsum(part.column(column).value_lengths().to_numpy())]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def some(part: pa.RecordBatch) -> pa.RecordBatch:
        size, name, rare, root = (part.column(c).to_numpy() for c in ("size", "k1", "rare", "root"))
        got = [
            _keys(tokens, int(rare[i]), int(size[i]), percent, int(name[i]))
            for i, tokens in enumerate(lists(part, "tokens"))
        ]
        if whole:
            met = [np.isin(x[0], keys) for x, keys in zip(got, lists(part, "shared"))]
            got = [tuple(column[m] for column in x) for x, m in zip(got, met)]
        own = np.repeat(np.arange(part.num_rows), [len(x[0]) for x in got])
        key, place, *tails = (np.concatenate(x) for x in zip(*got))
        cols = [key, name[own], root[own]]
        if whole:
            cols[2:2] = [(size[own] << 32) + place, *(part.column(c).to_numpy()[own] for c in MAPS), *tails]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=_WIDE if whole else _THIN)

    return run


def _longs(names: tuple) -> str:
    return ", ".join(f"{c} long" for c in names)


def _whole_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text"):
                doc, tokens = shingle_sets(words_of(part.column("text"), lower=True), n)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                sets = [tokens[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), pa.array(sets, pa.binary())], names=["k1", "k2", "tokens"]
                )

    return run


def _likely(percent: int):
    """Pairs whose parity maps differ in no more bits than their sets may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("x", "y"))
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            both = batch.column("both").to_numpy()
            need = (both * percent + 99 + percent) // (100 + percent)
            yield batch.select(["u", "v"]).filter(pa.array(apart <= both - 2 * need))

    return run


def _verify(percent: int):
    """Links of each block: its sets come first, then its pairs."""

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        if len(a) > len(b):
            a, b = b, a
        shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return 100 * shared >= percent * (len(a) + len(b) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sets = None, {}
        for batch in batches:
            out = []
            for own, name, other, tokens in zip(*(batch.column(c).to_pylist() for c in ("block", "name", "other", "tokens"))):
                if own != block:
                    block, sets = own, {}
                if tokens is not None:
                    sets.setdefault(name, []).append((other, np.frombuffer(tokens, np.uint64)))
                else:
                    for u2, a in sets[name]:
                        out += [(name, u2, other, v2) for v2, b in sets[other] if linked(a, b)]
            cols = zip(*out) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u1", "u2", "v1", "v2"])

    return run


# ---------------------------------------------------------------------------
# The join
# ---------------------------------------------------------------------------


def _text_name(text: Column) -> Column:
    return F.xxhash64(text)


def describe(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The written _SET rows of all ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), _text_name(text).alias("t1"), text.alias("text"))
    counts = token_counts(texts, n)
    frequent = 2 * float(counts.mean()) + 64
    return written(texts.mapInArrow(_describe(n, percent, spark.sparkContext.broadcast(counts), frequent), _SET), "sets")


def classes_of(sets: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: its node, keys, least id, and the row that stands for it."""
    return sets.where("size > 0").groupBy("k1", "k2").agg(
        *(F.first(c).alias(c) for c in ("size", *MAPS, "rare", "tokens", "map", "least")), F.min("doc_id").alias("least_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1")).alias("rep"),
    ).withColumn("node", F.xxhash64("k1", "k2"))


def _apart(a: str, b: str) -> Column:
    """Bits in which the smaller parity maps of two rows differ."""
    return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in MAPS), F.lit(0))


def _needed(both: Column, percent: int) -> Column:
    """Tokens that two linked sets of ``both`` tokens in all share at least."""
    return F.floor((both * percent + (99 + percent)) / (100 + percent))


def hub_pairs(classes: DataFrame, percent: int, turn: int = 0) -> DataFrame:
    """Distinct (u, v), u < v: classes and the hubs of their min-hash buckets, if their
    roots differ and their sizes and maps allow a link.

    A bucket's hubs are the first and the last class in each of ORDERS random orders of
    its own, so a cluster that shares several buckets meets many different hubs: a
    class that links with a share q of its cluster is missed by all with (1 - q)^hubs.
    """
    rows = classes.select(F.posexplode("least").alias("salt", "hash"), F.struct(F.col("k1").alias("name"), "size", *MAPS, "root").alias("own"))
    orders = [F.struct(F.xxhash64("own.name", "salt", F.lit(i)).alias("order"), F.col("own")) for i in range(turn * ORDERS, (turn + 1) * ORDERS)]
    ends = [end(o).getField("own") for o in orders for end in (F.min, F.max)]
    hubs = rows.groupBy("salt", "hash").agg(F.array(*ends).alias("hubs"), F.count(F.lit(1)).alias("classes")).where("classes > 1")
    met = rows.join(hubs.drop("classes"), ["salt", "hash"]).select("own", F.explode(F.array_distinct("hubs")).alias("hub"))
    both = F.col("own.size") + F.col("hub.size")
    return met.where(
        (F.col("own.root") != F.col("hub.root"))
        & (100 * F.least("own.size", "hub.size") >= percent * F.greatest("own.size", "hub.size"))
        & (_apart("own", "hub") <= both - 2 * _needed(both, percent))
    ).select(F.least("own.name", "hub.name").alias("u"), F.greatest("own.name", "hub.name").alias("v")).distinct()


def _any_same(of_a: tuple, of_b: tuple | None = None) -> Column:
    return reduce(or_, [F.col(f"a.{x}") == F.col(f"b.{y}") for x in of_a for y in of_b or of_a])


def candidate_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """Distinct (u, v), u < v, of class names (k1) that may link and whose ``root`` differs."""
    needed = ("k1", "size", "rare", "tokens", "root")
    thin = classes.select(*needed).mapInArrow(_index(percent, False), _longs(_THIN))
    # Counts are summed before the shuffle, and the semi-join may split a hot key.
    roots = thin.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    meeting = thin.select("key", F.col("name").alias("k1")).join(roots.select("key"), "key", "left_semi")
    shared = written(meeting.groupBy("k1").agg(F.collect_list("key").alias("shared")), "shared")
    rows = classes.select(*needed, *MAPS).join(shared, "k1").mapInArrow(_index(percent, True), _longs(_WIDE))
    a, b = rows.alias("a"), rows.alias("b")
    size_a, size_b = F.shiftright("a.sp", 32), F.shiftright("b.sp", 32)
    place_a, place_b = (F.col(f"{x}.sp").bitwiseAND(F.lit((1 << 32) - 1)) for x in "ab")
    both = size_a + size_b
    need = _needed(both, percent)
    left = F.least(size_a - place_a, size_b - place_b) + 1
    tails = ("tail", "tail2", "tail3", "tail4")
    return a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.name") < F.col("b.name"))
        & (F.col("a.root") != F.col("b.root"))
        & (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b))
        & ~_any_same(tails[:2])
        & ~_any_same(tails[2:])
        & ((place_a == 0) | ~(_any_same(tails[:2], tails[2:]) | _any_same(tails[2:], tails[:2])))
        & ((place_a == 0) | (place_b == 0) | (left >= need))
        & (_apart("a", "b") <= both - 2 * need),
    ).select(F.col("a.name").alias("u"), F.col("b.name").alias("v")).distinct()


def links(docs: DataFrame, classes: DataFrame, met: DataFrame, n: int, percent: int) -> DataFrame:
    """(u1, u2, v1, v2): the pairs (u, v) of ``met`` that link, verified and written."""
    x = classes.select(F.col("k1").alias("u"), F.col("size").alias("_a"), F.col("map").alias("x"))
    y = classes.select(F.col("k1").alias("v"), F.col("size").alias("_b"), F.col("map").alias("y"))
    mapped = met.join(x, "u").join(y, "v").select("u", "v", (F.col("_a") + F.col("_b")).alias("both"), "x", "y")
    pairs = written(mapped.mapInArrow(_likely(percent), "u long, v long").distinct(), "pairs")
    named = written(pairs.select(F.explode(F.array("u", "v")).alias("k1")).distinct(), "named")
    wanted = classes.join(named, "k1", "left_semi").select(
        "k1", "k2", F.col("rep.doc_id").alias("_id"), F.col("rep.t1").alias("_t1")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), _text_name(text).alias("t1"), text.alias("text"))
    chosen = texts.join(wanted, (F.col("t1") == F.col("_t1")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    whole = chosen.select("k1", "k2", "text").mapInArrow(_whole_sets(n), "k1 long, k2 long, tokens binary")
    # A set is sent once to each block of pairs that needs it, not with each pair:
    # blocks lie in a square, so a set goes to one row and one column at most.
    tokens = classes.join(named, "k1", "left_semi").agg(F.sum("size")).first()[0] or 0
    side = math.isqrt(LEAST_BLOCKS + 8 * tokens // BLOCK_BYTES)
    block = (F.pmod(F.xxhash64("u"), F.lit(side)) * side + F.pmod(F.xxhash64("v"), F.lit(side))).alias("block")
    needed = pairs.select(block, F.explode(F.array("u", "v")).alias("k1")).distinct()
    sets = needed.join(whole, "k1").select("block", F.lit(0).alias("kind"), F.col("k1").alias("name"), F.col("k2").alias("other"), "tokens")
    asked = pairs.select(block, F.lit(1).alias("kind"), F.col("u").alias("name"), F.col("v").alias("other"), F.lit(None).cast("binary").alias("tokens"))
    rows = sets.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind")
    return written(rows.mapInArrow(_verify(percent), "u1 long, u2 long, v1 long, v2 long").distinct(), "links")


def _ends(found: DataFrame) -> DataFrame:
    return found.select(F.xxhash64("u1", "u2").alias("u"), F.xxhash64("v1", "v2").alias("v"))


def _rooted(classes: DataFrame, edges: DataFrame) -> DataFrame:
    return classes.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))


def join_components(docs: DataFrame, n: int = 5, percent: int = 80, count_links: bool = False) -> DataFrame:
    """doc_id, t1, n_shingles, component_id and root of every row, and n_links (linked classes) if asked for."""
    if not 50 < percent <= 100:
        raise ValueError("the share must be over 50 and at most 100 per cent")
    sets = describe(docs, n, percent)
    classes = written(classes_of(sets), "classes")
    apart = classes.withColumn("root", F.col("node"))
    if count_links:
        edges = _ends(links(docs, classes, candidate_pairs(apart, percent), n, percent))
    else:
        edges = None
        for turn in range(ROUNDS + 1):
            rooted = apart if edges is None else _rooted(classes, edges)
            met = hub_pairs(rooted, percent, turn) if turn < ROUNDS else candidate_pairs(rooted, percent)
            found = _ends(links(docs, classes, met, n, percent))
            edges = found if edges is None else edges.unionByName(found)
    whole = _rooted(classes.select("k1", "k2", "node", "least_id"), edges)
    least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = whole.join(least, "root")
    if count_links:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        named = named.join(both.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("n_links")), "node", "left")
    has = F.col("size") > 0
    counted = [F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links")] if count_links else []
    own = named.select("k1", "k2", "root", "component_id", *(["n_links"] if count_links else []))
    return (
        sets.select("doc_id", "t1", "size", "k1", "k2").join(own, ["k1", "k2"], "left")
        .select(
            "doc_id", "t1", F.col("size").alias("n_shingles"),
            F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(has, F.col("root")).alias("root"), *counted,
        )
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component (the least id); rows without words all stay.

    The row travels in one struct, so its columns may have any names.  Of rows with
    the kept id and text that differ in other columns, the one of the least hash stays.
    """
    grouped = join_components(docs.select("doc_id", "text"), n, percent).where("root IS NOT NULL")
    best = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1")).alias("r"))
    kept = best.select(F.col("r.doc_id").alias("kept_id"), F.col("r.t1").alias("kept_text"))
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
        _text_name(F.coalesce(F.col("text"), F.lit(""))).alias("name"),
        F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("worded"),
    )
    chosen = named.where("worded").join(kept, (F.col("name") == F.col("kept_text")) & F.col("id").eqNullSafe(F.col("kept_id")))
    one = chosen.groupBy("name", "id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*").unionByName(named.where("NOT worded").select("row.*"))
