"""Substring dedup: repeated runs of words, found by super-k-mer partitioning.

A window is WINDOW consecutive words of one text; its minimiser is the least hash
of the GRAM-word runs in it.  Consecutive windows with one minimiser form a
super-k-mer, a packed string of words that travels to the minimiser's bucket,
where the windows are sorted and equal neighbours counted by their words.

1. Each text gives its minimisers and how many places attain them (thin rows).
   Equal windows have equal minimisers at different places, so a minimiser with
   one place in the corpus cannot hide a repeat; only the others' super-k-mers
   travel on.
2. Texts that occur in several rows need no search of their own: all their
   windows are repeated.  One row stands for them in the search of others.
3. Super-k-mers go to their buckets.  Those of a hot minimiser (more than
   HOT_PLACES) would make one large bucket; their windows go as 128-bit hashes
   instead, are counted with partial sums before the shuffle and joined back by a
   join that can split a hot key.
4. The repeated places return to their texts; words covered by a repeated window
   are removed, all judged on the input.

Texts are named by two 64-bit hashes, so equal ids and repeated rows do no harm.

Cases: a null or empty text has no words and the checksum of the empty string;
texts shorter than a window keep all words; repeated rows make each other's
windows repeated; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import written
from rosterline.llm.textgrams import Words, pieces_of, text_bytes, windows, words_of

WINDOW, GRAM = 35, 8
#: Places of a minimiser beyond which its windows are counted one by one: what one
#: bucket may hold in a task's memory (some 18 windows a place).
HOT_PLACES = 25_000
#: Rows of a bucket beyond which windows are compared by 128-bit hashes, not words.
LONG_BUCKET = 2000
#: Bytes of text that one step handles: numpy takes some 50 times as many, in every worker.
STEP_BYTES = 1 << 18
_NAME = ["k1", "k2"]
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """best(x[i : i + n]) for every i, by doubling."""
    width, out = 1, x
    while 2 * width <= n:
        out = best(out[:-width], out[width:])
        width *= 2
    rest = n - width
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def minimisers(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, minimiser) of every window, then (place, value) of the runs that attain one."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(words.hash) < window:
        return (*none, *none)
    at, value = windows(words, gram)
    runs = np.full(len(words.hash), _TOP)
    runs[at] = value
    reach = window - gram + 1
    least = _sliding(runs, reach, np.minimum)[: len(words.hash) - window + 1]
    start = np.flatnonzero(words.doc[: len(least)] == words.doc[window - 1 :])
    # A run attains the minimum of a window around it iff it equals the largest
    # of the minima of all windows that contain it.
    own = np.zeros(len(runs) + reach - 1, np.uint64)
    own[start + reach - 1] = least[start]
    place = np.flatnonzero((_sliding(own, reach, np.maximum)[: len(runs)] == runs) & (runs != _TOP))
    return start, least[start], place, runs[place]


def _hash(window: bytes) -> bytes:
    return hashlib.blake2b(window, digest_size=16).digest()


def _slim(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text"),
    )


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(minimiser, k1, k2, places) of every text."""
    for batch in batches:
        for part in pieces_of(batch, "text", STEP_BYTES):
            words = words_of(part.column("text"))
            *_, place, value = minimisers(words)
            doc = words.doc[place]
            order = np.lexsort((value, doc))
            doc, value = doc[order], value[order]
            new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])]) if len(doc) else doc
            count = np.diff(np.r_[new, len(doc)])
            rows = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[new].view(np.int64)), part.column("k1").take(rows), part.column("k2").take(rows), pa.array(count)],
                names=["minimiser", "k1", "k2", "places"],
            )


def _travel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of cold shared minimisers, and hashed windows of hot ones."""
    schema = pa.schema([(n, pa.int64()) for n in ("minimiser", "second", "k1", "k2", "start")] + [("packed", pa.binary())])

    def rows(part: pa.RecordBatch):
        words = words_of(part.column("text"))
        start, value, *_ = minimisers(words)
        raw, off = text_bytes(part.column("text"))
        raw = raw.tobytes()
        cut = np.searchsorted(words.doc[start], np.arange(words.n_docs + 1))
        first = words.first()
        for i, (k1, k2, shared, hot) in enumerate(zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "shared", "hot")))):
            own = value[cut[i] : cut[i + 1]].view(np.int64)
            if not len(own):
                continue
            begin = start[cut[i] : cut[i + 1]] - first[i]
            state = np.isin(own, np.asarray(shared, np.int64)).astype(int) + np.isin(own, np.asarray(hot or [], np.int64))
            edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            text = raw[off[i] : off[i + 1]].split()
            for a, b in zip(edge, np.r_[edge[1:], len(own)]):
                lo, hi = int(begin[a]), int(begin[b - 1])
                if state[a] == 1:
                    yield int(own[a]), None, k1, k2, lo, b" ".join(text[lo : hi + WINDOW])
                elif state[a] == 2:
                    for p in range(lo, hi + 1):
                        name = _hash(b" ".join(text[p : p + WINDOW]))
                        yield *(int(x) for x in np.frombuffer(name, np.int64)), k1, k2, p, None

    for batch in batches:
        for part in pieces_of(batch, "text", STEP_BYTES):
            got = list(rows(part))
            cols = zip(*got) if got else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated places in rows sorted by minimiser: sort the windows, compare neighbours."""
    names = ("minimiser", "k1", "k2", "start", "packed")

    def stream():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    def repeated(rows) -> Iterator[tuple[int, int, int]]:
        rows = list(rows)
        if len(rows) > LONG_BUCKET:
            yield from _repeated_hashes(rows)
            return
        found = []
        for _, k1, k2, start, packed in rows:
            words = packed.split(b" ")
            for i in range(len(words) - WINDOW + 1):
                found.append((b" ".join(words[i : i + WINDOW]), k1, k2, start + i))
        found.sort()
        found = [f for f, _ in groupby(found)]  # rows that stand for one text give the same place
        for i, (w, *place) in enumerate(found):
            if (i and found[i - 1][0] == w) or (i + 1 < len(found) and found[i + 1][0] == w):
                yield place

    out = []
    for _, rows in groupby(stream(), key=lambda r: r[0]):
        out += repeated(rows)
        if len(out) >= 50_000:
            yield _places(out)
            out = []
    yield _places(out)


def _repeated_hashes(rows: list) -> Iterator[tuple[int, int, int]]:
    """The same for a long bucket: windows as five whole numbers each, in flat arrays."""
    hashes, places = bytearray(), array("q")
    for _, k1, k2, start, packed in rows:
        words = packed.split(b" ")
        for i in range(len(words) - WINDOW + 1):
            hashes += _hash(b" ".join(words[i : i + WINDOW]))
            places.extend((k1, k2, start + i))
    place = np.frombuffer(places, np.int64).reshape(-1, 3)
    found = np.hstack([np.frombuffer(hashes, np.int64).reshape(-1, 2), place])
    del hashes, places, place
    found = found[np.lexsort(found.T[::-1])]
    found = found[np.r_[True, (found[1:] != found[:-1]).any(axis=1)]]
    same = (found[1:, :2] == found[:-1, :2]).all(axis=1)
    for row in found[np.r_[False, same] | np.r_[same, False], 2:]:
        yield row.tolist()


def _places(rows: list) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["k1", "k2", "start"])


def _apply(with_text: bool):
    """Counts and checksum of the words that stay, and those words if asked for."""
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
    if with_text:
        kinds["kept_text"] = pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, "text", STEP_BYTES):
                raw, off = text_bytes(part.column("text"))
                raw, rows = raw.tobytes(), []
                for i, (doc_id, copies, starts) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "copies", "starts")))):
                    words = raw[off[i] : off[i + 1]].split()
                    gone = 0
                    if copies > 1 and len(words) >= WINDOW:
                        gone, words_left = len(words), []
                    elif starts:
                        cover = np.zeros(len(words) + 1, np.int32)
                        np.add.at(cover, np.asarray(starts), 1)
                        np.add.at(cover, np.asarray(starts) + WINDOW, -1)
                        covered = np.cumsum(cover)[:-1] > 0
                        gone, words_left = int(covered.sum()), [w for w, c in zip(words, covered) if not c]
                    else:
                        words_left = words
                    kept = b" ".join(words_left)
                    rows.append((doc_id, len(words), gone, hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))

    return run


def repeated_places(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(k1, k2, start) of every window that starts elsewhere too, for texts of one row and for those that stand for copies."""
    thin = texts.mapInArrow(_thin, "minimiser long, k1 long, k2 long, places long")
    shared = thin.groupBy("minimiser").agg(F.sum("places").alias("_all")).where("_all > 1")
    lists = (
        thin.join(shared, "minimiser")
        .groupBy(_NAME)
        .agg(
            F.collect_set("minimiser").alias("shared"),
            F.collect_set(F.when(F.col("_all") > HOT_PLACES, F.col("minimiser"))).alias("hot"),
        )
        .join(names, _NAME)
    )
    travelling = written(
        texts.join(lists, _NAME)
        .where(F.col("doc_id").eqNullSafe(F.col("stand_in")))
        .select("text", *_NAME, "shared", "hot")
        .mapInArrow(_travel, "minimiser long, second long, k1 long, k2 long, start long, packed binary"),
        "superkmers",
    )
    cold = travelling.where("packed IS NOT NULL").repartition("minimiser").sortWithinPartitions("minimiser")
    hot = travelling.where("packed IS NULL").select("minimiser", "second", *_NAME, "start").distinct()
    often = hot.groupBy("minimiser", "second").count().where("count > 1").select("minimiser", "second")
    return cold.mapInArrow(_bucket, "k1 long, k2 long, start long").unionByName(
        hot.join(often, ["minimiser", "second"], "left_semi").select(*_NAME, "start")
    )


def dedup(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs`` (doc_id, text); kept_text if asked for."""
    texts = _slim(docs)
    names = texts.groupBy(_NAME).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("stand_in"))
    starts = repeated_places(texts, names).groupBy(_NAME).agg(F.collect_list("start").alias("starts"))
    return (
        texts.join(names.join(starts, _NAME, "left").select(*_NAME, "copies", "starts"), _NAME)
        .select("doc_id", "text", "copies", "starts")
        .mapInArrow(_apply(with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
    )
