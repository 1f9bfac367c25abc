"""Document fingerprints: homomorphic multiset hash of a text's sentences.

A text is cut into sentence-sized pieces (runs up to a line break or the end of a
sentence; marks that begin a line or the text are a piece of their own).  Each
piece is hashed to a wide vector, and the vectors are summed lane by lane, the
strong ones modulo 2^60.  The sum does not depend on the order, and a piece is
added or removed by adding or subtracting its vector:

* four strong lanes of 60 bits (from SHA-256) decide equality,
* 48 narrow lanes take small entries of the same hash, and a counter takes the
  number of pieces; centred, they are a linear sketch, so the squared distance of
  two sums estimates how many pieces the texts don't share.  A lane is a whole
  number that no text is long enough to wrap; the text form shows it modulo 2^15.

Native: within a block of BLOCK_PIECES pieces, which cannot overflow 15 bits, four
narrow lanes travel in one 60-bit number and are added at once; the blocks' lanes
are added as numbers of their own; everything is column expressions.  The only
shuffle deals the documents to ranges of ids, where a window pairs each with the
next; ranges come from quantiles, and the first row of a range is copied to the
range before it, so no task sees more than its range.

Cases: a null text is empty; a text without pieces has the zero vector; equal
ids are ordered by text, nulls last; a single document is its own next; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "[^\\n.!?]+[.!?]*|[.!?]+"
CHUNKS, SHIFTS, FIELDS = 4, (0, 4, 8), (0, 15, 30, 45)
_FULL = (1 << 60) - 1
_NIBBLES = sum(15 << f for f in FIELDS)
LANES = CHUNKS * len(SHIFTS) * len(FIELDS)
_WORDS = CHUNKS * (1 + len(SHIFTS)) + 1
#: Pieces whose entries of 15 at most fit a lane of 15 bits.
BLOCK_PIECES = 0x7FFF // 15
#: Rows of a range of ids, and ranges at most.
RANGE_ROWS, MOST_RANGES = 2048, 10_000


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def fingerprint(text: Column) -> Column:
    """array<long>: number of pieces, strong lanes, narrow lanes."""
    hashes = F.transform(
        F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)),
        lambda piece: F.sha2(piece, 256),
    )
    chunks = F.transform(
        hashes,
        lambda h: F.array(*[F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(CHUNKS)]),
    )

    def step(acc: Column, c: Column) -> Column:
        out = [acc[0] + 1]
        out += [(acc[1 + i] + c[i]).bitwiseAND(_long(_FULL)) for i in range(CHUNKS)]
        for i in range(CHUNKS):
            for j, s in enumerate(SHIFTS):
                entry = F.shiftright(c[i], s).bitwiseAND(_long(_NIBBLES))
                out.append(acc[1 + CHUNKS + i * len(SHIFTS) + j] + entry)
        return F.array(*out)

    def blocks(pieces: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(BLOCK_PIECES))
        none = F.array(*[_long(0)] * _WORDS)
        return F.transform(starts, lambda at: F.aggregate(F.slice(pieces, at, F.lit(BLOCK_PIECES)), none, step))

    def add(acc: Column, b: Column) -> Column:
        out = [acc[0] + b[0]]
        out += [(acc[1 + i] + b[1 + i]).bitwiseAND(_long(_FULL)) for i in range(CHUNKS)]
        for k in range(LANES):
            word = b[1 + CHUNKS + k // len(FIELDS)]
            lane = F.shiftright(word, FIELDS[k % len(FIELDS)]).bitwiseAND(_long(0x7FFF))
            out.append(acc[1 + CHUNKS + k] + lane)
        return F.array(*out)

    # The array around the chunks binds them to a name, so that they are made once.
    sums = F.transform(F.array(chunks), blocks)[0]
    return F.aggregate(sums, F.array(*[_long(0)] * (1 + CHUNKS + LANES)), add)


def as_text(f: Column) -> Column:
    """The vector as upper-case hex, 15 digits a number, four narrow lanes modulo 2^15 in one."""
    out = [f[i] for i in range(1 + CHUNKS)]
    for k in range(1 + CHUNKS, 1 + CHUNKS + LANES, len(FIELDS)):
        lanes = [F.shiftleft(f[k + j].bitwiseAND(_long(0x7FFF)), s) for j, s in enumerate(FIELDS)]
        out.append(lanes[0] + lanes[1] + lanes[2] + lanes[3])
    return F.array_join(F.transform(F.array(*out), lambda x: F.lpad(F.hex(x), 15, "0")), "-")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal vectors, else 1 - |a-b|^2 / (|a|^2 + |b|^2), 0 at least."""
    lanes = F.sequence(F.lit(2 + CHUNKS), F.lit(1 + CHUNKS + LANES))

    def norm(value) -> Column:
        # Doubles: squares of the longest texts' lanes exceed a long; below 2^53 they are exact.
        return F.aggregate(lanes, F.lit(0.0), lambda acc, i: acc + value(i).cast("double") * value(i).cast("double"))

    def own(v: Column):
        return lambda i: F.element_at(v, i) * 2 - v[0] * 15

    def between(i: Column) -> Column:
        return (F.element_at(a, i) - F.element_at(b, i)) * 2 - (a[0] - b[0]) * 15

    both = norm(own(a)) + norm(own(b))
    graded = F.greatest(F.lit(0.0), F.lit(1.0) - norm(between) / F.nullif(both, F.lit(0.0)))
    return F.when(a == b, 1.0).otherwise(F.coalesce(graded, F.lit(0.0)))


def _ranges(docs: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """``docs`` with its id range (higher ids first: larger), and the largest id of each range."""
    from pyspark.ml.feature import Bucketizer

    rows = docs.count()
    n = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    cuts: list[float] = []
    if n > 1:
        found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000)).first()[0]
        cuts = sorted({float(x) for x in found or []})
    keyed = docs.withColumn("_x", F.col("doc_id").cast("double"))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        keyed = Bucketizer(inputCol="_x", outputCol="_range", splits=splits, handleInvalid="keep").transform(keyed)
        keyed = keyed.withColumn("_range", F.when(F.col("_x").isNull(), -1).otherwise(F.col("_range").cast("int")))
    else:
        keyed = keyed.withColumn("_range", F.when(F.col("_x").isNull(), -1).otherwise(0))
    tops = keyed.groupBy("_range").agg(F.max("doc_id").alias("top")).collect()  # MOST_RANGES + 1 rows at most
    return keyed.drop("_x"), sorted(((r["_range"], r["top"]) for r in tops), reverse=True)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, own vector, and text and vector of the next document (ids falling)."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed, tops = _ranges(slim)
    # The first rows of each range go to the range before it as well, as markers.
    after = [(tops[(i + 1) % len(tops)][1], tops[i][0]) for i in range(len(tops))]
    marks = spark.createDataFrame(after, "_top long, _to int")
    copies = keyed.join(F.broadcast(marks), F.col("doc_id").eqNullSafe(F.col("_top")))
    rows = keyed.withColumn("_mark", F.lit(False)).unionByName(
        copies.select("doc_id", "text", F.col("_to").alias("_range"), F.lit(True).alias("_mark"))
    )
    rows = rows.withColumn("vector", fingerprint(F.col("text")))
    order = Window.partitionBy("_range").orderBy("_mark", F.desc_nulls_last("doc_id"), F.desc("text"))
    return (
        rows.withColumn("next", F.lead(F.struct("text", "vector")).over(order))
        .where(~F.col("_mark"))
        .select("doc_id", "text", "vector", F.col("next.text").alias("next_text"), F.col("next.vector").alias("next_vector"))
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness."""
    chars = F.length("text")
    cut = F.floor(chars / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), chars - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    both = with_next(docs).withColumn("n_chars", chars.cast("long")).withColumn("edited", edited)
    both = both.withColumn("edited_vector", fingerprint(F.col("edited")))
    return both.select(
        "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


# ---------------------------------------------------------------------------
# The same in DuckDB SQL
# ---------------------------------------------------------------------------


def compare_edited_sql(table: str = "documents") -> str:
    def chunk(i: int) -> str:
        return f"('0x' || substr(sha256(u), {1 + 15 * i}, 15))::BIGINT"

    words = ["count(u)::BIGINT"]
    words += [f"(coalesce(sum(c{i}), 0) % {_FULL + 1})::BIGINT" for i in range(CHUNKS)]
    lanes = []
    for i in range(CHUNKS):
        for s in SHIFTS:
            own = [f"coalesce(sum((c{i} >> {f + s}) & 15), 0)::BIGINT" for f in FIELDS]
            lanes += own
            words.append(" + ".join(f"(({x} % 32768) << {f})" for x, f in zip(own, FIELDS)))
    hexed = " || '-' || ".join(f"lpad(to_hex(w[{i + 1}]), 15, '0')" for i in range(_WORDS))

    def norm(expr: str) -> str:
        return f"list_sum(list_transform(range(1, {LANES + 1}), lambda i: ({expr})::DOUBLE * ({expr})::DOUBLE))"

    def near(b: str) -> str:
        both = f"({norm('2 * a.l[i] - 15 * a.w[1]')} + {norm(f'2 * {b}.l[i] - 15 * {b}.w[1]')})"
        apart = norm(f"2 * (a.l[i] - {b}.l[i]) - 15 * (a.w[1] - {b}.w[1])")
        return f"CASE WHEN a.w = {b}.w AND a.l = {b}.l THEN 1.0::DOUBLE WHEN {both} = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - {apart}::DOUBLE / {both}::DOUBLE) END"

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {table}),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, t DESC) AS rn, count(*) OVER () AS n FROM d),
e AS (SELECT x.doc_id, x.t, x.rn, x.n, x.rn % x.n + 1 AS nxt,
        substr(x.t, 1, (length(x.t) - length(x.t) // 2)::BIGINT) || substr(y.t, 1, (length(x.t) // 2)::BIGINT) AS ed
      FROM o x JOIN o y ON y.rn = x.rn % x.n + 1),
s AS (SELECT rn, 0 AS side, t AS v FROM e UNION ALL SELECT rn, 1, ed FROM e),
p AS (SELECT rn, side, unnest(regexp_extract_all(v, '{PIECE}')) AS u FROM s),
c AS (SELECT rn, side, u, {", ".join(f"{chunk(i)} AS c{i}" for i in range(CHUNKS))} FROM p),
g AS (SELECT s.rn, s.side, [{", ".join(words)}] AS w, [{", ".join(lanes)}] AS l
      FROM s LEFT JOIN c ON c.rn = s.rn AND c.side = s.side GROUP BY s.rn, s.side),
f AS (SELECT *, {hexed} AS h FROM g)
SELECT e.doc_id, length(e.t)::BIGINT AS n_chars, sha256(e.ed) AS edited_sha256, a.h AS fingerprint, b.h AS edited_fingerprint,
       {near("b")} AS near_edited, {near("z")} AS near_next
FROM e JOIN f a ON a.rn = e.rn AND a.side = 0 JOIN f b ON b.rn = e.rn AND b.side = 1
       JOIN f z ON z.rn = e.nxt AND z.side = 0"""
