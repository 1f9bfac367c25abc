"""Sharding: documents ordered along a Hilbert curve and cut into equal runs.

Several metadata dimensions are quantised to a few bits each; the curve index of
the cell orders the rows, so each run of rows covers a compact box of every
dimension and file statistics prune on any of them.  Runs hold equal numbers of
rows (at most one apart).

Native: column expressions only.  The curve index folds one bit of each
dimension at a time through a table of curve orientations made by rule.  Rows
are ranked without a single-task window: a range partitioning on (index, text
hash, id) splits hot cells and hot texts, each partition is sorted, and its rows
get the partition's offset plus their place in it.

``write_shards`` stores whole documents by shard in curve order.  Categories are hashed
to cells, whose order is not that of the names, so the cells are stored as well, and
``category_filter`` asks for both: then file statistics prune on every dimension.

Cases: nulls in a dimension form a cell of their own; a null text has size 1 and
the checksum of the empty text; repeated rows are separate rows; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import written

BITS = 5
#: Rows of one file of written shards.
ROWS_PER_FILE = 1_000_000


def _orientation_table(dims: int) -> tuple[list[int], list[int]]:
    """For every state (entry corner, main direction) and cell: rank along the
    curve and next state, by the Gray-code rule of the Hilbert curve."""
    size, mask = 1 << dims, (1 << dims) - 1

    def left(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & mask

    gray = [i ^ (i >> 1) for i in range(size)]
    rank_of = {g: i for i, g in enumerate(gray)}
    rank, following = [], []
    for entry in range(size):
        for direction in range(dims):
            for cell in range(size):
                turned = left(cell ^ entry, dims - (direction + 1) % dims)
                w = rank_of[turned]
                corner = 0 if w == 0 else gray[2 * ((w - 1) // 2)]
                ones = 0 if w == 0 else (w if w % 2 else w - 1)
                axis = 0
                while ones & 1:
                    ones, axis = ones >> 1, axis + 1
                next_entry = entry ^ left(corner, direction + 1)
                next_direction = (direction + axis % dims + 1) % dims
                rank.append(w)
                following.append(next_entry * dims + next_direction)
    return rank, following


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Curve index of a cell given by integer columns of ``bits`` bits each."""
    dims = len(cells)
    rank, following = _orientation_table(dims)
    ranks = F.array(*map(F.lit, rank))
    states = F.array(*map(F.lit, following))

    def step(acc: Column, bit: Column) -> Column:
        digit = F.lit(0)
        for d, cell in enumerate(cells):
            one = F.call_function("shiftright", cell.cast("int"), bit).bitwiseAND(F.lit(1))
            digit = digit + one * F.lit(1 << d)
        at = acc["state"] * F.lit(1 << dims) + digit + F.lit(1)
        return F.struct(
            F.element_at(states, at).alias("state"),
            (acc["index"] * F.lit(1 << dims).cast("long") + F.element_at(ranks, at)).alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, step)["index"]


def category_cell(column: str, bits: int = BITS) -> Column:
    """A category hashed to a cell; null is a category."""
    return F.pmod(F.crc32(F.coalesce(F.col(column), F.lit("\0")).cast("binary")), F.lit(1 << bits))


def category_filter(column: str, value: str | None, bits: int = BITS) -> Column:
    """Rows of written shards with ``value`` (null too), by the cell's statistics and the name."""
    cell = zlib.crc32(("\0" if value is None else value).encode()) % (1 << bits)
    return (F.col(f"{column}_cell") == cell) & (F.col(column).isNull() if value is None else F.col(column) == value)


def size_cell(size: Column, bits: int = BITS) -> Column:
    """Powers of two of a positive size."""
    return F.least(F.floor(F.log2(size.cast("double")) * 2 * (1 << bits) / 64), F.lit((1 << bits) - 1))


def hilbert_shards(
    docs: DataFrame,
    dimensions: dict[str, Column],
    shards: int,
    payload: dict[str, Column],
    tie_break: list[Column],
) -> DataFrame:
    """``payload`` columns plus curve_index, shard and slot of every row."""
    cells = list(dimensions.values())
    thin = docs.select(
        *[c.alias(n) for n, c in payload.items()],
        hilbert_index(cells).alias("curve_index"),
        *[c.alias(f"_tie{i}") for i, c in enumerate(tie_break)],
    )
    order = ["curve_index", *[f"_tie{i}" for i in range(len(tie_break))]]
    ranged = thin.repartitionByRange(*order).sortWithinPartitions(*order)
    # The partition number and the place in it are written with the rows, so
    # the counts and the ranks come from the same dealing out.
    number = F.monotonically_increasing_id()
    placed = written(
        ranged.withColumn("_part", F.shiftright(number, 33))
        .withColumn("_place", number.bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(*order[1:]),
        "hilbert",
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the sort: bounded by the cluster's settings.
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_rows").over(running), F.lit(0).cast("long")).alias("_offset"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    ranked = placed.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_offset") + F.col("_place"))
    shard = F.expr(f"cast(_rank * {shards} div _total as int)")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        *payload, "curve_index", "shard", (F.col("_rank") - first).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int, rows_per_file: int = ROWS_PER_FILE) -> None:
    """All ``docs`` with size, lang_cell, source_cell, curve_index and slot as Parquet at
    ``path``: a folder a shard, in it files of runs of the curve, as many as its rows need.

    An input column of one of these names is kept as ``<name>_of_input``.
    """
    added = ("size", "lang_cell", "source_cell", "curve_index", "shard", "slot")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    taken = {n.lower() for n in docs.columns}
    payload = {}
    for n in docs.columns:
        kept = n
        while kept.lower() in added or (kept != n and kept.lower() in taken):
            kept += "_of_input"
        payload[kept] = F.col(f"`{n}`")
    cells = {f"{n}_cell": category_cell(n).cast("int") for n in ("lang", "source")}
    placed = hilbert_shards(
        docs,
        {"lang": category_cell("lang"), "source": category_cell("source"), "size": size_cell(size)},
        shards,
        payload | cells | {"size": size},
        [F.xxhash64(text), F.col("doc_id")],
    )
    # Ranges of (shard, slot) follow the rows, so a shard takes as many tasks and
    # files as it has rows, and a file holds one run of the curve.
    tasks = max(shards, -(-docs.count() // rows_per_file))
    dealt = placed.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.option("maxRecordsPerFile", 2 * rows_per_file).partitionBy("shard").parquet(path)
