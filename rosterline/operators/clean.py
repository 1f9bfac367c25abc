"""Cleaning of raw (all-string) staffing, provider and claims rows.

ANSI mode stays on; every conversion that may meet bad text uses a ``try_*``
function so that bad values become NULL and the following filters drop the
row, instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.sources.files import SOURCE_FILE, select_by_header


_HOURS = "_hours"


def _to_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def _to_date(c: Column, fmt: str) -> Column:
    return F.try_to_date(F.trim(c), fmt)


def normalise_id(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c.cast("string"))


def drop_empty_rows(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Drop rows whose source columns are all NULL (provenance columns ignored)."""
    subset = [c for c in df.columns if c not in set(ignore or [])]
    return df.dropna(how="all", subset=subset)


def present_staffing(raw: DataFrame) -> DataFrame:
    """The staffing columns of the raw text, without all-empty rows."""
    df = select_by_header(raw, S.STAFFING_SOURCE_HEADERS, keep=[SOURCE_FILE])
    return drop_empty_rows(df, ignore=[SOURCE_FILE])


def type_staffing(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed columns (``STAFFING_SCHEMA`` order); bad values become NULL, no row goes.

    The provenance column and those in ``keep`` are carried along.
    """
    hours = S.hour_columns()
    out = [
        normalise_id(F.col("PROVNUM")).alias("provnum"),
        *[F.col(h).alias(n) for h, n in S.STAFFING_DIMENSIONS if n != "provnum"],
        _to_date(F.col(S.STAFFING_DATE[0]), S.STAFFING_DATE_FORMAT).alias("workdate"),
        _to_double(F.col(S.STAFFING_CENSUS[0])).alias("mdscensus"),
    ]
    kept = [F.col(c) for c in [SOURCE_FILE, *(keep or [])] if c in df.columns]
    # The hours are converted in one loop: an expression each makes a method of more
    # than the 8000 bytes that the JVM compiles, and every row is interpreted.
    numbers = F.transform(F.array(*[F.col(h) for h, _ in hours]), _to_double).alias(_HOURS)
    names = [n for _, n in S.STAFFING_DIMENSIONS] + ["workdate", "mdscensus"]
    return df.select(*out, numbers, *kept).select(
        *names, *[F.get(_HOURS, F.lit(k)).alias(n) for k, (_, n) in enumerate(hours)], *kept
    )


def staffing_defects() -> dict[str, Column]:
    """Why a typed row is dropped; a row may have several reasons."""
    return {
        "blank_id": F.coalesce(F.length("provnum") == 0, F.lit(True)),
        "bad_date": F.col("workdate").isNull(),
        "missing_census": F.col("mdscensus").isNull(),
        "negative_census": F.coalesce(F.col("mdscensus") < 0, F.lit(False)),
    }


def valid_condition() -> Column:
    """No defect.  Stated as plain conjuncts: the optimizer's constraint propagation
    grows quickly over a negated disjunction of expressions under this many aliases."""
    return (
        F.col("provnum").isNotNull()
        & (F.length("provnum") > 0)
        & F.col("workdate").isNotNull()
        & F.col("mdscensus").isNotNull()
        & (F.col("mdscensus") >= 0)
    )


def valid_staffing(typed: DataFrame) -> DataFrame:
    """Rows without a defect.  Negative hours and zero-census days stay."""
    return typed.where(valid_condition())


def clean_staffing(raw: DataFrame) -> DataFrame:
    """Raw daily staffing text -> curated typed rows.

    Drops: all-empty rows; blank or missing facility id; unparseable work date;
    missing or negative census.
    """
    return valid_staffing(type_staffing(present_staffing(raw)))


def _typed(c: Column, t: str) -> Column:
    if t == "double":
        return _to_double(c)
    if t == "int":
        # '521' and '521.0' -> 521; text -> NULL
        return _to_double(c).try_cast("int")
    if t == "date":
        return F.coalesce(*[_to_date(c, fmt) for fmt in S.CLAIMS_DATE_FORMATS])
    return c


def _select_typed(raw: DataFrame, layout: list[tuple[str, str, str]]) -> DataFrame:
    df = select_by_header(raw, [h for h, _, _ in layout])
    return df.select(*[_typed(F.col(f"`{h}`"), t).alias(n) for h, n, t in layout])


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keep one row per key: the first in ``order_by`` order (ascending, NULLs first).

    Implemented as ``min(struct(order..., row))`` per key.  A struct with strings
    makes this a sort-based aggregate: each task sorts its input once and passes
    on one row per key, so a hot key is small after the shuffle, where a window
    would sort all of it in one task.  Meant for dimension-sized tables.  With a
    total order the survivor is deterministic.
    """
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
        F.struct(*[F.col(c) for c in payload]).alias("_row"),
    )
    g = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return g.select(*keys, *[F.col(f"_first._row.{c}").alias(c) for c in payload])


def dedup_provider(provider: DataFrame) -> DataFrame:
    """One row per provider id.  Blank ids are dropped; among duplicates the
    row that sorts first over all columns survives (deterministic)."""
    p = provider.where(F.col("provider_id").isNotNull() & (F.length("provider_id") > 0))
    order = [c for c in p.columns if c != "provider_id"]
    return first_per_key(p, ["provider_id"], order).select(*provider.columns)


def clean_provider(raw: DataFrame) -> DataFrame:
    """Raw provider text -> curated provider rows, unique per id."""
    typed = _select_typed(raw, S.PROVIDER_COLUMNS)
    typed = typed.where(F.col("provider_id").isNotNull()).withColumn(
        "provider_id", normalise_id("provider_id")
    )
    return dedup_provider(typed)


def clean_claims(raw: DataFrame) -> DataFrame:
    """Raw claims text -> curated claims rows; rows without id or measure dropped."""
    typed = _select_typed(raw, S.CLAIMS_COLUMNS).withColumn(
        "provider_id", normalise_id("provider_id")
    )
    return typed.where(F.col("provider_id").isNotNull() & F.col("measure_code").isNotNull())
