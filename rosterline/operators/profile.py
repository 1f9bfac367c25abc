"""Validation summaries and the data profile, as wide aggregations.

The source pipeline counts, profiles and checks with many separate actions
(and a pandas pass over a sample).  Here each report is one ``DataFrame``
over the full table: counts share one aggregate, per-column checks are one
``agg`` followed by a wide-to-long reshape, and quantiles use the distributed
exact method in ``functions.quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.functions.metrics import any_of, guarded_pct, guarded_ratio, maybe_round, sum_of
from rosterline.functions.quantiles import quantiles, sketches
from rosterline.operators import clean as C
from rosterline.session import written_once
from rosterline.sources.files import select_by_header

QUARTILES = [0.25, 0.5, 0.75]
DESCRIBE_COLUMNS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


# ---------------------------------------------------------------------------
# Validation summaries of the staffing job
# ---------------------------------------------------------------------------


def rows_per_source_file(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows per input file, largest first."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows")).orderBy(
        F.col("rows").desc(), F.col(file_col)
    )


def dataset_summary(staffing: DataFrame) -> DataFrame:
    """Rows, distinct facilities, distinct dates, first and last date -- one pass."""
    return staffing.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("provnum").alias("facilities"),
        F.count_distinct("workdate").alias("dates"),
        F.min("workdate").alias("min_date"),
        F.max("workdate").alias("max_date"),
    )


def state_distribution(staffing: DataFrame) -> DataFrame:
    """Rows and distinct facilities per state."""
    return (
        staffing.groupBy("state")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("provnum").alias("facilities"))
        .orderBy(F.col("state").asc_nulls_last())
    )


def quarter_distribution(staffing: DataFrame) -> DataFrame:
    """Rows and distinct facilities per calendar year and quarter of the work date."""
    return (
        staffing.groupBy(F.year("workdate").alias("year"), F.quarter("workdate").alias("quarter"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("provnum").alias("facilities"))
        .orderBy("year", "quarter")
    )


def drop_reasons(raw: DataFrame) -> DataFrame:
    """One row: raw staffing rows that are empty, and rows with each defect."""
    text = select_by_header(raw, S.STAFFING_SOURCE_HEADERS)
    has = any_of([F.col(c).isNotNull() for c in text.columns])
    typed = C.type_staffing(text.withColumn("_has", has), keep=["_has"])
    # An all-empty row has no other reason: it is counted once.
    return typed.agg(
        F.count_if(~F.col("_has")).alias("dropped_empty"),
        *[F.count_if(F.col("_has") & c).alias(f"dropped_{n}") for n, c in C.staffing_defects().items()],
    )


def negative_hour_condition(df: DataFrame) -> F.Column:
    present = [c for c in S.HOUR_COLUMNS if c in df.columns]
    return any_of([F.col(c) < 0 for c in present])


def negative_hours(staffing: DataFrame) -> DataFrame:
    """Rows with any negative hour column (counted, never removed) and per-column counts."""
    present = [c for c in S.HOUR_COLUMNS if c in staffing.columns]
    return staffing.agg(
        F.count_if(negative_hour_condition(staffing)).alias("rows_with_negative_hours"),
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in present],
    )


def state_conflicts(staffing: DataFrame) -> DataFrame:
    """Facilities reported under more than one state (the facility view keeps
    the greatest state name for them)."""
    per = staffing.where(F.col("state").isNotNull()).groupBy("provnum").agg(
        F.count_distinct("state").alias("_states")
    )
    return per.agg(F.count_if(F.col("_states") > 1).alias("facilities_in_several_states"))


# ---------------------------------------------------------------------------
# Claims checks
# ---------------------------------------------------------------------------


def measure_distribution(claims: DataFrame) -> DataFrame:
    """Rows and available adjusted scores per measure."""
    return (
        claims.groupBy("measure_code", "measure_description", "resident_type")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("adjusted_score").alias("available_adjusted_scores"),
        )
        .orderBy("measure_code")
    )


def claims_cardinality(claims: DataFrame) -> DataFrame:
    return claims.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("provider_id").alias("facilities"),
        F.count_distinct("measure_code").alias("measures"),
    )


def duplicate_claim_keys(claims: DataFrame) -> DataFrame:
    """(provider, measure) keys that occur more than once; reported, not removed."""
    return (
        claims.groupBy("provider_id", "measure_code")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


# ---------------------------------------------------------------------------
# Profile (D3-D15, F7)
# ---------------------------------------------------------------------------


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Null count and percentage per column, highest first (one aggregate)."""
    cols = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    long = wide.select(
        "_rows",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
                    for i, c in enumerate(cols)
                ]
            )
        ).alias("_kv"),
    )
    pct = F.when(
        F.col("_rows") > 0,
        F.bround(F.col("_kv.null_count") / F.col("_rows") * F.lit(100.0), digits),
    )
    return long.select(
        "_kv.column_name", "_kv.null_count", pct.alias("null_percentage")
    ).orderBy(F.col("null_percentage").desc_nulls_last(), "column_name")


def cardinality(staffing: DataFrame) -> DataFrame:
    """Distinct facilities, states, counties and dates (NULLs not counted)."""
    return staffing.agg(
        F.count_distinct("provnum").alias("facilities"),
        F.count_distinct("state").alias("states"),
        F.count_distinct("county_fips").alias("counties"),  # names repeat across states
        F.count_distinct("workdate").alias("dates"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Fully duplicated rows beyond the first copy of each.

    Only 128-bit fingerprints are shuffled, whatever the width of a row.  Rows are
    compared column by column only where fingerprints are equal.
    """
    f1, f2, n = (_free_name(df, x) for x in ("_f1", "_f2", "_n"))
    named = df.withColumns({f1: _fingerprint(df, 0), f2: _fingerprint(df, 1)})
    again = named.groupBy(f1, f2).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(f1, f2)
    suspects = named.join(written_once(again, "repeated-fingerprints"), [f1, f2], "left_semi")
    g = suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))
    return g.agg(F.coalesce(F.sum(F.col(n) - 1), F.lit(0)).alias("duplicate_rows"))


def _free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def _fingerprint(df: DataFrame, salt: int) -> F.Column:
    """64 bits of all columns; where a value is NULL counts too."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    return F.xxhash64(F.lit(salt), nulls, *[F.col(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose business key was already seen (all but the first per key)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_key_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


def date_validation(staffing: DataFrame, period_start: str, period_end: str) -> DataFrame:
    """Invalid (NULL) dates, first / last date and rows outside the expected period."""
    d = F.col("workdate")
    lo, hi = F.lit(period_start).cast("date"), F.lit(period_end).cast("date")
    return staffing.agg(
        F.count_if(d.isNull()).alias("invalid_dates"),
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
        F.count_if((d < lo) | (d > hi)).alias("outside_period"),
    )


def describe_aggregates(columns: list[str], extra: dict | None = None) -> list[F.Column]:
    """First-pass aggregates of ``describe``: moments, sketches and ``extra`` of every column."""
    out = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        moments = {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        out += [e.alias(f"_d{i}_{n}") for n, e in moments.items()]
        out += [fn(v).alias(f"_d{i}_{n}") for n, fn in (extra or {}).items()]
    return out + sketches([F.col(c) for c in columns], QUARTILES)


def describe(
    df: DataFrame,
    columns: list[str],
    digits: int | None = None,
    extra: dict | None = None,
) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max -- one row per column.

    ``extra`` maps an output name to ``fn(value_column) -> aggregate``.  Two passes:
    one wide aggregate, then the quantiles' brackets (``functions.quantiles``); both
    run when this is called, and the result is a few local rows.
    """
    extra = extra or {}
    first = df.agg(*describe_aggregates(columns, extra)).first()
    found = quantiles(df, [F.col(c) for c in columns], QUARTILES, first)
    moments = ["count", "mean", "std", "min"]
    rows = [
        (c, *[first[f"_d{i}_{m}"] for m in moments], *found[i], first[f"_d{i}_max"], *[first[f"_d{i}_{n}"] for n in extra])
        for i, c in enumerate(columns)
    ]
    kinds = {"count": "bigint"} | {c: "double" for c in DESCRIBE_COLUMNS[1:]} | {n: "bigint" for n in extra}
    local = df.sparkSession.createDataFrame(rows, "column_name string, " + ", ".join(f"`{n}` {k}" for n, k in kinds.items()))
    stats = [maybe_round(F.col(c), digits).alias(c) for c in DESCRIBE_COLUMNS if c != "count"]
    return local.select("column_name", "count", *stats, *extra.keys())


def describe_census(staffing: DataFrame, digits: int | None = None) -> DataFrame:
    """Census description plus negative and zero census counts."""
    return describe(
        staffing, ["mdscensus"], digits,
        extra={
            "negative_census": lambda v: F.count_if(v < 0),
            "zero_census": lambda v: F.count_if(v == 0),
        },
    )


def describe_hours(staffing: DataFrame, digits: int | None = None) -> DataFrame:
    """RN / LPN / CNA hours described, with the negative count per column."""
    cols = [S.hrs(r) for r in S.DIRECT_ROLES]
    return describe(staffing, cols, digits, extra={"negative": lambda v: F.count_if(v < 0)})


def reconciliation_conditions(tolerance: float = S.RECONCILE_TOLERANCE) -> dict[str, F.Column]:
    """Per role: total hours differ from employee + contract hours by more than
    ``tolerance`` (NULL counted as 0)."""
    conds = {}
    for label, role in S.RECONCILED_ROLES:
        t, e, c = S.hrs(role), S.hrs(role, "_emp"), S.hrs(role, "_ctr")
        conds[label] = F.abs(sum_of([t]) - (sum_of([e]) + sum_of([c]))) > F.lit(tolerance)
    return conds


def reconciliation(staffing: DataFrame, tolerance: float = S.RECONCILE_TOLERANCE) -> DataFrame:
    """Days that do not reconcile, per role."""
    conds = list(reconciliation_conditions(tolerance).items())
    wide = staffing.agg(*[F.count_if(cond).alias(f"_m{i}") for i, (_, cond) in enumerate(conds)])
    return wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(label).alias("role"), F.col(f"_m{i}").alias("mismatches"))
                    for i, (label, _) in enumerate(conds)
                ]
            )
        ).alias("_kv")
    ).select("_kv.role", "_kv.mismatches")


IQR_COLUMNS = ["mdscensus", S.hrs("RN"), S.hrs("LPN"), S.hrs("CNA")]


def iqr_outliers(staffing: DataFrame, columns: list[str] = IQR_COLUMNS,
                 digits: int | None = None) -> DataFrame:
    """Tukey fences (Q1 - 1.5 IQR, Q3 + 1.5 IQR) and the count strictly outside.

    Two passes give the quartiles; the fences are literals of the third, which counts.
    """
    values = [F.col(c).cast("double") for c in columns]
    first = staffing.agg(*sketches(values, [0.25, 0.75])).first()
    quartiles = quantiles(staffing, values, [0.25, 0.75], first)
    rows, outside = [], []
    for c, v, (q1, q3) in zip(columns, values, quartiles):
        if q1 is not None:
            low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            rows.append((c, q1, q3, low, high))
            outside.append(F.count_if((v < F.lit(low)) | (v > F.lit(high))).alias(c))
    counted = staffing.agg(*outside).first() if outside else {}
    local = staffing.sparkSession.createDataFrame(
        [(*r, counted[r[0]]) for r in rows],
        "column_name string, q1 double, q3 double, lower_bound double, upper_bound double, outliers bigint",
    )
    return local.select(
        "column_name",
        *[maybe_round(F.col(c), digits).alias(c) for c in ["q1", "q3", "lower_bound", "upper_bound"]],
        "outliers",
    )


def profile_hprd(staffing: DataFrame) -> DataFrame:
    """Daily HPRD for the profile: census-guarded, hours NOT coalesced."""
    total = sum_of([S.hrs(r) for r in S.DIRECT_ROLES], coalesce_nulls=False)
    return staffing.select(
        guarded_ratio(S.hrs("RN"), "mdscensus").alias("rn_hprd"),
        guarded_ratio(S.hrs("LPN"), "mdscensus").alias("lpn_hprd"),
        guarded_ratio(S.hrs("CNA"), "mdscensus").alias("cna_hprd"),
        guarded_ratio(total, "mdscensus").alias("total_direct_hprd"),
    )


def describe_hprd(staffing: DataFrame, digits: int | None = None) -> DataFrame:
    hprd = profile_hprd(staffing)
    return describe(hprd, hprd.columns, digits)


def contract_pct_profile(staffing: DataFrame, digits: int | None = None) -> DataFrame:
    """Daily contract share (no coalescing, guarded total > 0) described, plus
    the count of values outside [0, 100]."""
    total = sum_of([S.hrs(r) for r in S.DIRECT_ROLES], coalesce_nulls=False)
    ctr = sum_of([S.hrs(r, "_ctr") for r in S.DIRECT_ROLES], coalesce_nulls=False)
    pct = staffing.select(guarded_pct(ctr, total).alias("contract_dependency_pct"))
    return describe(
        pct, ["contract_dependency_pct"], digits,
        extra={"invalid_pct": lambda v: F.count_if((v < 0) | (v > 100))},
    )


def profile_reports(staffing: DataFrame, period_start: str, period_end: str) -> dict[str, DataFrame]:
    """The data profile of typed staffing rows, report by report.

    The checks are fused: one scan makes all counts, moments and sketches, a second
    the quantiles of all described columns, a third counts beyond the fences they
    give.  Distinct and repeated keys need shuffles of their own: of facility days
    and of row fingerprints.  All reports but the last three are a few local rows.
    """
    spark = staffing.sparkSession
    total = sum_of([S.hrs(r) for r in S.DIRECT_ROLES], coalesce_nulls=False)
    contract = sum_of([S.hrs(r, "_ctr") for r in S.DIRECT_ROLES], coalesce_nulls=False)
    derived = {f"{r.lower()}_hprd": guarded_ratio(S.hrs(r), "mdscensus") for r in S.DIRECT_ROLES}
    derived |= {"total_direct_hprd": guarded_ratio(total, "mdscensus"), "contract_dependency_pct": guarded_pct(contract, total)}
    wide = staffing.withColumns(derived)
    columns = ["mdscensus", *[S.hrs(r) for r in S.DIRECT_ROLES], *derived]
    day, hours = F.col("workdate"), [c for c in S.HOUR_COLUMNS if c in staffing.columns]
    lo, hi = F.lit(period_start).cast("date"), F.lit(period_end).cast("date")
    roles = reconciliation_conditions()
    first = wide.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in staffing.columns],
        F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count_if((day < lo) | (day > hi)).alias("outside_period"),
        F.count_if(negative_hour_condition(staffing)).alias("rows_with_negative_hours"),
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in hours],
        *[F.count_if(c).alias(f"mismatch_{label}") for label, c in roles.items()],
        *describe_aggregates(columns, {"negative": lambda v: F.count_if(v < 0), "zero": lambda v: F.count_if(v == 0), "over_100": lambda v: F.count_if(v > 100)}),
    ).first()
    found = quantiles(wide, [F.col(c) for c in columns], QUARTILES, first)
    fences, outside = [], []
    for c in IQR_COLUMNS:
        q1, _, q3 = found[columns.index(c)]
        if q1 is not None:
            low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            fences.append((c, q1, q3, low, high))
            outside.append(F.count_if((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))).alias(c))
    beyond = staffing.agg(*outside).first() if outside else {}

    def table(rows: list, schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema)

    n = first["rows"]
    nulls = [(c, first[f"null_{c}"], round(100.0 * first[f"null_{c}"] / n, 2) if n else None) for c in staffing.columns]
    described = [
        (c, *[first[f"_d{i}_{m}"] for m in ("count", "mean", "std", "min")], *found[i], *[first[f"_d{i}_{m}"] for m in ("max", "negative", "zero", "over_100")])
        for i, c in enumerate(columns)
    ]
    doubles = "mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return {
        "null_profile": table(sorted(nulls, key=lambda r: (-(r[2] or 0.0), r[0])), "column_name string, null_count bigint, null_percentage double"),
        "date_validation": table(
            [(first["null_workdate"], first["min_date"], first["max_date"], first["outside_period"])],
            "invalid_dates bigint, min_date date, max_date date, outside_period bigint",
        ),
        "negative_hours": table(
            [("any", first["rows_with_negative_hours"]), *[(c, first[f"negative_{c}"]) for c in hours]], "column_name string, rows bigint"
        ),
        "reconciliation": table([(label, first[f"mismatch_{label}"]) for label in roles], "role string, mismatches bigint"),
        "describe": table(described, f"column_name string, count bigint, {doubles}, negative bigint, zero bigint, over_100 bigint"),
        "iqr_outliers": table(
            [(*r, beyond[r[0]]) for r in fences], "column_name string, q1 double, q3 double, lower_bound double, upper_bound double, outliers bigint"
        ),
        "cardinality": cardinality(staffing),
        "duplicate_keys": duplicate_keys(staffing, ["provnum", "workdate"]),
        "duplicate_rows": duplicate_rows(staffing),
    }


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows for eyeballing (``limit`` is the feature here)."""
    return df.limit(n)
