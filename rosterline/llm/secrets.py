"""Secret scans: base secrets, and weaker parts linked when they complete each other.

Base spans are taken as they stand: assignments, access identifiers and long hex
runs.  A credential often comes in several parts, none of which says much alone:
an identifier, an opaque secret and an endpoint.  Such weak parts are joined with
all parts of the same document whose interval lies within ``SCOPE`` code points,
and reported only when the complementary parts co-occur:

* ``ident`` (a user or client name) next to any secret,
* ``opaque`` (a long mixed run) next to any identifier,
* ``endpoint`` (a service address) next to both.

Native: regular expressions give matches and the text between them, whose lengths
give the positions.  The interval join runs on the arrays of one row, because a
scope never leaves its document: the matches of a kind do not overlap, so they are
in order by start and by end, and the first one that ends behind a point is found by
halving.  There is no shuffle, and the time of a row grows with its spans, not with
their pairs.

Cases: a null text is empty; an empty text has no spans and the checksum of the
empty string; repeated rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points between two parts of one credential at most.
SCOPE = 200
#: What stands in a redacted text for a span.
MASK = "[SECRET]"


def any_case(word: str) -> str:
    """A pattern for the word's ASCII letters in either case, alike in all engines."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
_OWNERS = "|".join(map(any_case, ("username", "user", "login", "client_?id")))
_SERVICES = "|".join(("https?", "ftp", "postgres", "postgresql", "mysql", "mongodb", "redis", "amqp"))
_GIVEN = "[\"']?\\x20*[:=]\\x20*[\"']?"

#: kind -> (pattern, group whose length counts, least length); in the order of spans that start together.
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (f"({_NAMES}){_GIVEN}([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]{32,}", 0, 32),
    "ident": (f"({_OWNERS}){_GIVEN}([A-Za-z0-9_.@-]+)", 2, 3),
    "opaque": ("[A-Za-z0-9+/]{40,}", 0, 40),
    "endpoint": (f"({_SERVICES})://([^\\x20\\x09-\\x0D\"'<>]+)", 2, 4),
}
BASE = ("assign", "access", "hex")
#: Items of a growing array that are copied when one is added.
PIECE = 256
#: Code points of the blocks that a text is cut into, in two steps.
_LARGE, _BLOCK = 1 << 20, 1 << 13
_SPAN = "array<struct<start:int,end:int>>"


def _spans(text: Column, kind: str) -> Column:
    """Intervals (code points, end exclusive) of the kind's matches, by start."""
    pattern, group, least = KINDS[kind]
    none = F.array().cast(_SPAN)
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["before"])
        end = start + F.coalesce(F.length(part["match"]), F.lit(0))
        kept = F.coalesce(F.length(part["value"]) >= least, F.lit(False))
        return F.struct(end.alias("at"), *_grown(acc, kept, F.struct(start.alias("start"), end.alias("end")), none))

    start = F.struct(F.lit(0).alias("at"), none.alias("some"), F.array().cast(f"array<{_SPAN}>").alias("done"))
    found = F.aggregate(parts, start, step, lambda a: F.concat(F.flatten(a["done"]), a["some"]))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _grown(acc: Column, kept: Column, item: Column, none: Column) -> list[Column]:
    """``some`` and ``done`` of a fold with ``item`` added: an array is copied when it
    grows, so full pieces of PIECE items are put aside."""
    full = F.size(acc["some"]) >= PIECE
    some = F.when(kept, F.array_append(F.when(full, none).otherwise(acc["some"]), item)).otherwise(acc["some"])
    done = F.when(kept & full, F.array_append(acc["done"], acc["some"])).otherwise(acc["done"])
    return [some.alias("some"), done.alias("done")]


def _let(value: Column, use) -> Column:
    """``use`` of a value that is made once: the array around it binds it to a name."""
    return F.transform(F.array(value), use)[0]


def _near(found: Column, kinds, reach: int):
    """Does a span of any of the kinds lie within ``reach`` code points of the span?"""

    def of(kind: str, s: Column) -> Column:
        parts = found[kind]

        def halve(lo: Column, bit: Column) -> Column:
            to = lo + F.call_function("shiftleft", F.lit(1), bit)
            early = F.get(parts, to - 1)["end"] <= s["start"] - reach  # null beyond the array
            return F.when(early, to).otherwise(lo)

        bits = F.sequence(F.floor(F.log2(F.greatest(F.size(parts), F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))
        first = F.aggregate(bits, F.lit(0), halve)
        return F.coalesce(F.get(parts, first)["start"] < s["end"] + reach, F.lit(False))

    return lambda s: reduce(or_, [of(k, s) for k in kinds])


def linked_spans(text: Column, scope: int = SCOPE) -> Column:
    """A struct of one array of spans per kind; weak kinds hold linked spans alone."""

    def freed(r: Column) -> Column:
        base = _near(r, BASE, 0)
        return F.struct(*[(r[k] if k in BASE else F.filter(r[k], lambda s: ~base(s))).alias(k) for k in KINDS])

    def linked(r: Column) -> Column:
        by_owner, by_secret = _near(r, ("access", "ident"), scope), _near(r, ("assign", "hex", "opaque"), scope)
        asked = {"ident": by_secret, "opaque": by_owner, "endpoint": lambda s: by_owner(s) & by_secret(s)}
        return F.struct(*[(F.filter(r[k], asked[k]) if k in asked else r[k]).alias(k) for k in KINDS])

    raw = F.struct(*[_spans(text, k).alias(k) for k in KINDS])
    return _let(_let(raw, freed), linked)


def _joined(kinds) -> Column:
    """kind:start:end of the kinds' spans, by start, then kind; comma-joined."""
    def named(i: int, kind: str):
        return lambda s: F.struct(s["start"].alias("s"), F.lit(i).alias("k"), s["end"].alias("e"), F.lit(kind).alias("n"))

    rows = F.concat(*[F.transform(F.col("found")[k], named(i, k)) for i, k in enumerate(kinds)])
    return F.array_join(
        F.transform(F.array_sort(rows), lambda r: F.concat_ws(":", r["n"], r["s"].cast("string"), r["e"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Counts, checksum and list of spans per row of ``docs`` (doc_id, text)."""
    found = docs.select("doc_id", linked_spans(F.coalesce("text", F.lit(""))).alias("found"))
    return found.select(
        "doc_id",
        *[F.size(F.col("found")[k]).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(BASE), 256).alias("base_sha256"),
        _joined(KINDS).alias("spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with MASK in place of ``spans``, which are in order and may overlap."""
    none = F.array().cast(_SPAN)

    def step(acc: Column, s: Column) -> Column:
        gap = F.struct(acc["at"].alias("start"), s["start"].alias("end"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), *_grown(acc, s["start"] >= acc["at"], gap, none))

    def ended(acc: Column) -> Column:
        last = F.struct(acc["at"].alias("start"), F.length(text).alias("end"))
        return F.concat(F.flatten(acc["done"]), acc["some"], F.array(last))

    begin = F.struct(F.lit(0).alias("at"), none.alias("some"), F.array().cast(f"array<{_SPAN}>").alias("done"))
    gaps = F.aggregate(spans, begin, step, ended)
    # A part of a text is found by counting from its start, so the text is cut into
    # blocks once, and parts are taken from the blocks.
    cuts = F.sequence(F.lit(0), F.floor(F.length(text) / _LARGE).cast("int"))
    large = F.transform(cuts, lambda i: F.substring(text, i * _LARGE + 1, F.lit(_LARGE)))
    small = F.sequence(F.lit(0), F.lit(_LARGE // _BLOCK - 1))
    blocks = F.flatten(F.transform(large, lambda t: F.transform(small, lambda j: F.substring(t, j * _BLOCK + 1, F.lit(_BLOCK)))))

    def part(b: Column):
        def of(g: Column) -> Column:
            start, last = g["start"], g["end"] - 1
            i, j = F.floor(start / _BLOCK).cast("int"), F.floor(last / _BLOCK).cast("int")
            one = F.substring(F.get(b, i), start % _BLOCK + 1, g["end"] - start)
            many = F.concat(
                F.substring(F.get(b, i), start % _BLOCK + 1, F.lit(_BLOCK)),
                F.array_join(F.slice(b, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                F.substring(F.get(b, j), F.lit(1), last % _BLOCK + 1),
            )
            return F.when(last < start, F.lit("")).when(i == j, one).otherwise(many)

        return of

    return _let(blocks, lambda b: F.array_join(F.transform(gaps, part(b)), MASK))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by MASK; n_chars follows.

    A text without spans stays as it is, also a null one.  The row travels in one
    struct, so its columns may have any names.
    """

    def told(all_spans: Column) -> Column:
        some = F.size(all_spans) > 0
        return F.struct(some.alias("changed"), F.when(some, _masked(F.col("text"), all_spans)).otherwise(F.col("text")).alias("text"))

    found = linked_spans(F.coalesce("text", F.lit("")))
    in_order = _let(found, lambda r: F.array_sort(F.concat(*[r[k] for k in KINDS])))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    done = packed.select("row", _let(in_order, told).alias("new"))
    out = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("new.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("new.changed"), F.length("new.text").cast(kind)).otherwise(out["n_chars"])
    return done.select(*[out[c].alias(c) for c in docs.columns])


# ---------------------------------------------------------------------------
# The same in DuckDB SQL
# ---------------------------------------------------------------------------


def _sql_spans(kind: str) -> str:
    pattern, group, least = KINDS[kind]
    p = pattern.replace("'", "''")
    return f"""list_transform(list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1), lambda i: {{
        's': (list_sum(list_transform(regexp_split_to_array(t, '{p}')[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}', 0)[1:i-1], lambda x: length(x))), 0))::BIGINT,
        'n': length(regexp_extract_all(t, '{p}', 0)[i]), 'v': length(regexp_extract_all(t, '{p}', {group})[i])}}),
        lambda m: m.v >= {least}), lambda m: {{'s': m.s, 'e': m.s + m.n}})"""


def _sql_near(parts: str, span: str, reach: int, p: str) -> str:
    return f"len(list_filter({parts}, lambda {p}: {p}.s < {span}.e + {reach} AND {span}.s < {p}.e + {reach})) > 0"


def _sql_joined(kinds) -> str:
    rows = " || ".join(
        f"list_transform(k_{k}, lambda r: {{'s': r.s, 'k': {i}, 'e': r.e, 'n': '{k}'}})" for i, k in enumerate(kinds)
    )
    return f"array_to_string(list_transform(list_sort({rows}), lambda r: r.n || ':' || r.s || ':' || r.e), ',')"


def scan_sql(table: str = "documents", scope: int = SCOPE) -> str:
    weak = ("ident", "opaque", "endpoint")
    return f"""
WITH raw AS (SELECT doc_id, coalesce(text, '') AS t FROM {table}),
found AS (SELECT doc_id, {", ".join(f"{_sql_spans(k)} AS k_{k}" for k in KINDS)} FROM raw),
free AS (SELECT * REPLACE ({", ".join(
        f"list_filter(k_{k}, lambda w: NOT ({_sql_near('(k_assign || k_access || k_hex)', 'w', 0, 'b')})) AS k_{k}" for k in weak)})
    FROM found),
linked AS (SELECT * REPLACE (
    list_filter(k_ident, lambda w: {_sql_near("(k_assign || k_hex || k_opaque)", "w", scope, "a")}) AS k_ident,
    list_filter(k_opaque, lambda w: {_sql_near("(k_access || k_ident)", "w", scope, "a")}) AS k_opaque,
    list_filter(k_endpoint, lambda w: {_sql_near("(k_access || k_ident)", "w", scope, "a")}
        AND {_sql_near("(k_assign || k_hex || k_opaque)", "w", scope, "b")}) AS k_endpoint) FROM free)
SELECT doc_id, {", ".join(f"len(k_{k})::BIGINT AS n_{k}" for k in BASE)},
       sha256({_sql_joined(BASE)}) AS base_sha256, {_sql_joined(KINDS)} AS spans
FROM linked"""
