"""Packing: hierarchical multi-length packing of tokenised documents.

Every document becomes its token ids plus an end id.  Whole context windows are
cut off first; what remains of a document is routed to the smallest context
size (tier) that holds it.  Each tier is then packed: a window of the tier takes
one of its documents and the gap behind it is filled from the shorter tiers,
whole documents first, cutting the last one so that the window is exactly full.
Windows have a power-of-two length and need no padding; what is left when a
task ends forms at most one padded window.  Sequences are dealt to step groups
of one tier that hold the same number of tokens each; the padded windows come
behind the full ones of their tier, so that they fall into its last groups.

The work is one pass over the scan's partitions, without a shuffle of pieces, and
the pool of waiting documents is bounded in tokens.  The pieces are written, and
the sequences of each tier numbered across tasks from counts per task.  Sequence ids hold the partition number
and a running number, so a task that is run again gives the same rows.

Cases: a null or empty text is a document of the end id alone; repeated rows are
separate documents; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import written
from rosterline.llm.textgrams import pieces_of

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
#: Tokens that wait for a window before the pool is packed.
POOL_TOKENS = 2_000_000
#: Distinct chunks of text whose ids a task keeps.
CACHE_CHUNKS = 400_000

# A space between two non-space characters always begins a new pre-token, so
# the chunks on both sides can be encoded alone.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = (",", ".")
_IRREGULAR = re.compile(r"(?<!\S) | (?!\S)")


class ChunkEncoder:
    """Token ids of texts, as little-endian 32-bit bytes.

    Texts are cut into chunks where the tokenizer's pre-tokens cannot span;
    each distinct chunk is encoded once and kept in a bounded cache.  With
    ``ranks`` (a path and a pattern: the same vocabulary as byte-pair ranks), new
    chunks are encoded through it, which takes less time for short strings;
    chunks with a special token's string always go to the tokenizer itself.
    """

    def __init__(self, tokenizer_path: str, ranks: tuple[str, str] | None):
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(tokenizer_path)
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._quick = _from_ranks(*ranks) if ranks else None
        self._head: dict[str, bytes] = {}
        self._rest: dict[str, bytes] = {}

    def _ids(self, chunk: str) -> bytes:
        if self._quick and not any(s in chunk for s in self._special):
            return array("I", self._quick(chunk)).tobytes()
        return array("I", self._tok.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _learn(self, cache: dict[str, bytes], wanted: set[str], prefix: str) -> None:
        new = wanted.difference(cache)
        if len(cache) + len(new) > CACHE_CHUNKS:
            cache.clear()
            new = wanted
        for w in new:
            # A mark behind letters is a pre-token of its own.
            if w[-1:] in _MARKS and w[:-1].isalpha():
                stem = w[:-1]
                if stem not in cache:
                    cache[stem] = self._ids(prefix + stem)
                if w[-1] not in self._head:
                    self._head[w[-1]] = self._ids(w[-1])
                cache[w] = cache[stem] + self._head[w[-1]]
            elif w not in cache:
                cache[w] = self._ids(prefix + w)

    def forget(self) -> None:
        """Drop what was learned; a worker process outlives its tasks."""
        self._head.clear()
        self._rest.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [_CUT.split(t) if _IRREGULAR.search(t) else t.split(" ") for t in texts]
        self._learn(self._rest, set().union(*(c[1:] for c in cut)), " ")
        self._learn(self._head, {c[0] for c in cut}, "")
        rest, head = self._rest.__getitem__, self._head
        return [head[c[0]] + b"".join(map(rest, c[1:])) for c in cut]


def _from_ranks(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(tokenizer_path: str, ranks: tuple[str, str] | None = None) -> ChunkEncoder:
    """One encoder per Python worker and tokenizer file."""
    key = (tokenizer_path, ranks)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(*key)
    return _ENCODERS[key]


class Packer:
    """Turns documents into rows of SCHEMA; state is bounded by POOL_TOKENS."""

    def __init__(self, tiers: tuple[int, ...], partition: int, step_windows: int):
        self.tiers = tuple(sorted(tiers))
        self.window = self.tiers[-1]
        self.step_tokens = self.window * step_windows
        self.base = partition << 32
        self.sequences = 0
        self.filled = dict.fromkeys(self.tiers, 0)  # tokens given to step groups
        self.pools: dict[int, deque] = {t: deque() for t in self.tiers}
        self.waiting = 0
        self.rows: list[tuple] = []
        self.places: list[tuple[int, bool]] = []  # of each row's sequence: number in its tier, padded

    def add(self, doc_id, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            self._emit(self.window, [(doc_id, start, ids[4 * start : 4 * (start + self.window)], total)])
            start += self.window
        if start < total:
            left = total - start
            tier = next(t for t in self.tiers if t >= left)
            piece = (doc_id, start, ids[4 * start :], total)
            if left == tier:
                self._emit(tier, [piece])
            else:
                self.pools[tier].append(piece)
                self.waiting += left
                if self.waiting >= POOL_TOKENS:
                    self._pack()

    def finish(self) -> None:
        self._pack()
        # The rest is shorter than what fills its windows: join it and cut
        # windows of falling length; below the smallest tier one is padded.
        rest = deque(p for t in reversed(self.tiers) for p in self.pools[t])
        left = sum(len(p[2]) // 4 for p in rest)
        for tier in reversed(self.tiers):
            while left >= tier:
                self._emit(tier, self._take(rest, tier))
                left -= tier
        if left:
            self._emit(self.window, self._take(rest, left))
        self.waiting = 0

    def _pack(self) -> None:
        """Fill windows tier by tier, longest first; what cannot fill one waits on."""
        short = sum(len(p[2]) // 4 for p in self.pools[self.tiers[0]])
        for i in range(len(self.tiers) - 1, 0, -1):
            tier, pool = self.tiers[i], self.pools[self.tiers[i]]
            while pool:
                gap = tier - len(pool[0][2]) // 4
                content = [pool[0]]
                took: list[tuple[int, tuple]] = []
                for t in reversed(self.tiers[:i]):  # whole documents that fit
                    while self.pools[t] and len(self.pools[t][0][2]) // 4 <= gap:
                        p = self.pools[t].popleft()
                        took.append((t, p))
                        gap -= len(p[2]) // 4
                filler = next((t for t in self.tiers[:i] if self.pools[t]), None)
                if gap and filler is None:  # nothing left to cut: put all back
                    for t, p in reversed(took):
                        self.pools[t].appendleft(p)
                    break
                pool.popleft()
                content += [p for _, p in took]
                if gap:
                    doc_id, start, ids, total = self.pools[filler].popleft()
                    content.append((doc_id, start, ids[: 4 * gap], total))
                    tail = (doc_id, start + gap, ids[4 * gap :], total)
                    home = next(t for t in self.tiers if t >= len(tail[2]) // 4)
                    self.pools[home].appendleft(tail)
                self._emit(tier, content)
        tier, pool = self.tiers[0], self.pools[self.tiers[0]]
        short = sum(len(p[2]) // 4 for p in pool)
        while short >= tier:
            self._emit(tier, self._take(pool, tier))
            short -= tier
        self.waiting = sum(len(p[2]) // 4 for q in self.pools.values() for p in q)

    @staticmethod
    def _take(pool: deque, n: int) -> list[tuple]:
        """n tokens from the front of the pool, cutting the last piece."""
        out = []
        while n:
            doc_id, start, ids, total = pool.popleft()
            have = len(ids) // 4
            if have > n:
                pool.appendleft((doc_id, start + n, ids[4 * n :], total))
                ids, have = ids[: 4 * n], n
            out.append((doc_id, start, ids, total))
            n -= have
        return out

    def _emit(self, tier: int, pieces: list[tuple]) -> None:
        sequence, offset = self.base + self.sequences, 0
        self.sequences += 1
        step = self.base + (self.filled[tier] // self.step_tokens) * len(self.tiers) + self.tiers.index(tier)
        place = (self.filled[tier] // tier, sum(len(p[2]) // 4 for p in pieces) < tier)
        self.filled[tier] += tier
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, sequence, offset, tier, step))
            self.places.append(place)
            offset += n


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    ranks: tuple[str, str] | None = None,
    end_id: int = 1,
    tiers: tuple[int, ...] = (256, 512, 1024, 2048),
    step_windows: int = 16,
) -> DataFrame:
    """Pieces of all documents (doc_id, text) and their place in sequences.

    ``tier`` is the length of the sequence's window, ``step_group`` the group of
    sequences of one tier that together hold ``step_windows`` longest windows; in
    all, the last group of each tier is shorter, and padded windows are in the
    last groups of the longest tier only.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("context sizes must be powers of two")
    end = np.asarray([end_id], "<u4").tobytes()
    kinds = {"tier": pa.int32(), "_padded": pa.bool_()}
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    placed = f"{SCHEMA}, _place long, _padded boolean"
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in [*names, "_place", "_padded"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, ranks)
        packer = Packer(tiers, TaskContext.get().partitionId(), step_windows)

        def rows() -> pa.RecordBatch:
            got = [(*row, *place) for row, place in zip(packer.rows, packer.places)]
            packer.rows, packer.places = [], []
            cols = list(zip(*got)) if got else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts)):
                    packer.add(doc_id, ids + end)
            yield rows()
        enc.forget()
        packer.finish()
        yield rows()

    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, placed)
    # The counts and the places come from the same written rows.
    pieces = written(pieces, "packing").withColumn("_part", F.shiftright("sequence_id", 32))
    keys = ["tier", "_padded", "_part"]
    counts = pieces.where("offset = 0").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_sequences"), F.min("_place").alias("_first")
    )
    # One row per task, tier and kind of window: bounded by the cluster's settings.
    before = Window.partitionBy("tier").orderBy("_padded", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_first", F.coalesce(F.sum("_sequences").over(before), F.lit(0).cast("long")).alias("_offset"))
    ordered = sorted(tiers)
    index = F.array_position(F.array(*map(F.lit, ordered)), F.col("tier")) - 1
    group = F.floor((F.col("_offset") + F.col("_place") - F.col("_first")) * F.col("tier") / F.lit(ordered[-1] * step_windows))
    return (
        pieces.join(F.broadcast(offsets), keys)
        .withColumn("step_group", (group * len(ordered) + index).cast("long"))
        .select(*names)
    )
