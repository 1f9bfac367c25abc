"""Map the driver's TPC-H-like tables onto the three source datasets.

The staffing, provider and claims datasets are not shipped with test data, so
the correctness gate derives them from ``lineitem``, ``supplier``, ``nation``,
``region`` and ``orders``.  Every derivation is a plain DataFrame plan over the
whole tables; nothing is sampled or capped.  The same derivations are written
independently in SQL for the DuckDB oracle (``rosterline.oracle``).

Mapping (one staffing facility = one supplier, one state = one nation):

* staffing day  = lineitem grouped by supplier and ship date
* provider      = supplier + nation + region, minus every 50th supplier
                  (``s_suppkey % 50 = 49``) so that some facilities stay unmatched
* claims        = lineitem grouped by supplier and line number; the line number
                  picks the measure, so several rows share one (facility, measure)
                  key and the duplicate-key report has something to find
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline import schemas as S

# Fixed values for the synthetic mapping.
FLAG_BY_ROLE = {"RN": "R", "LPN": "N", "CNA": "A"}  # return flag carrying each direct role
LINE_BY_ROLE = {"RNDON": 1, "NAtrn": 2, "RNadmin": 3, "LPNadmin": 4, "MedAide": 5}
NATRN_OFFSET = 2.0  # NA-trainee hours are quantity - 2, which plants negative hours
UNMATCHED_MODULUS, UNMATCHED_REMAINDER = 50, 49
MEASURE_BY_LINE_MOD4 = {0: 521, 1: 522, 2: 551, 3: 552}
MEASURE_TEXT = {
    521: "Percentage of short-stay residents who were rehospitalized after a nursing home admission",
    522: "Percentage of short-stay residents who had an outpatient emergency department visit",
    551: "Number of hospitalizations per 1000 long-stay resident days",
    552: "Number of outpatient emergency department visits per 1000 long-stay resident days",
}
SHORT_STAY = (521, 522)
FIVE_STAR = (521, 551)
MEASURE_PERIOD = "20230701-20240630"
PROCESSING_DATE = "2024-10-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _role_condition(role: str) -> Column:
    if role in FLAG_BY_ROLE:
        return F.col("l_returnflag") == F.lit(FLAG_BY_ROLE[role])
    return F.col("l_linenumber") == F.lit(LINE_BY_ROLE[role])


def _role_value(role: str) -> Column:
    if role == "NAtrn":
        return F.col("l_quantity") - F.lit(NATRN_OFFSET)
    return F.col("l_quantity")


def _suffix_condition(suffix: str) -> Column | None:
    if suffix == "_emp":
        return (F.col("l_linestatus") == "O") & (F.col("l_linenumber") < 7)
    if suffix == "_ctr":
        return F.col("l_linestatus") == "F"
    return None


def _hour_aggregates() -> list[Column]:
    out = []
    for role in S.STAFF_ROLES:
        for suffix in S.HOUR_SUFFIXES:
            cond = _role_condition(role)
            extra = _suffix_condition(suffix)
            if extra is not None:
                cond = cond & extra
            out.append(F.sum(F.when(cond, _role_value(role))).alias(S.hrs(role, suffix)))
    return out


def _with_dimensions(spark: SparkSession, sf_dir: str, rows: DataFrame, key: str) -> DataFrame:
    """``rows`` of suppliers with the staffing file's facility attributes.

    The two tables are joined one after the other: the planner knows the size of each,
    so it can broadcast them, but not that of their join.
    """
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    county = F.col("s_suppkey") % 23
    joined = rows.join(sup, F.col(key) == sup.s_suppkey, "inner").join(nat, sup.s_nationkey == nat.n_nationkey, "inner")
    return joined.select(
        *rows.columns,
        F.col("s_suppkey").cast("string").alias("provnum"),
        F.col("s_name").alias("provname"),
        F.concat(F.lit("City "), (F.col("s_suppkey") % 17).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.concat(F.lit("County "), county.cast("string")).alias("county_name"),
        F.lpad((F.col("s_nationkey") * 1000 + county).cast("string"), 5, "0").alias("county_fips"),
    )


#: Line items that one task groups into staffing days.
ROWS_PER_TASK = 250_000


def staffing_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated staffing rows (facility x day), typed as ``STAFFING_SCHEMA``.

    Nearly every line item is a day of its own, so partial sums are as many as the
    line items and several times as wide.  The line items themselves are dealt, once,
    by ranges of (nation, supplier, day): each task sums a bounded number of them
    without another shuffle, a hot supplier spreads over its many days, and the rows
    lie as the clustered table holds them.  Only the per-day rows are joined with the
    supplier dimension.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("workdate"),
        "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
    )
    # One nation a supplier, for the place alone: the join multiplies no line item.
    places = table(spark, sf_dir, "supplier").groupBy(F.col("s_suppkey").alias("l_suppkey")).agg(
        F.min("s_nationkey").alias("_nation"))
    tasks = max(1, -(-li.count() // ROWS_PER_TASK))  # Parquet footers only
    dealt = li.join(places, "l_suppkey").repartitionByRange(tasks, "_nation", "l_suppkey", "workdate")
    daily = dealt.groupBy("_nation", "l_suppkey", "workdate").agg(
        (
            F.sum("l_linenumber")
            * (F.lit(4) + F.col("l_suppkey") % 6)  # a grouping column: no buffer needed
            / F.lit(4.0)
            * F.when(F.max("l_linenumber") == 1, F.lit(0)).otherwise(F.lit(1))
        ).alias("mdscensus"),
        *_hour_aggregates(),
    )
    cy_qtr = F.concat(
        F.year("workdate").cast("string"), F.lit("Q"), F.quarter("workdate").cast("string")
    )
    return _with_dimensions(spark, sf_dir, daily, "l_suppkey").select(
        "provnum", "provname", "city", "state", "county_name", "county_fips",
        cy_qtr.alias("cy_qtr"), "workdate", "mdscensus", *S.HOUR_COLUMNS,
    )


def provider_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated provider rows, typed as ``PROVIDER_SCHEMA`` (one per facility)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    df = (
        sup.where(k % UNMATCHED_MODULUS != UNMATCHED_REMAINDER)
        .join(nat, sup.s_nationkey == nat.n_nationkey, "inner")
        .join(reg, F.col("n_regionkey") == reg.r_regionkey, "inner")
    )
    ownership = (
        F.when(k % 3 == 0, "For profit").when(k % 3 == 1, "Non profit").otherwise("Government")
    )
    return df.select(
        k.cast("string").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.concat(k.cast("string"), F.lit(" Main Street")).alias("provider_address"),
        F.concat(F.lit("City "), (k % 17).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.col("r_name").alias("county"),
        ownership.alias("ownership_type"),
        F.col("s_acctbal").alias("certified_beds"),
        (F.abs(F.col("s_acctbal")) / F.lit(100.0)).alias("avg_residents_per_day"),
        F.when(k % 4 == 0, "Medicaid").otherwise("Medicare and Medicaid").alias("provider_type"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(1.0) + k % 5).alias("overall_rating"),
        (F.lit(1.0) + (k * 7) % 5).alias("health_inspection_rating"),
        F.when(k % 13 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(1.0) + (k * 3) % 5).alias("qm_rating"),
        (F.lit(1.0) + k % 4).alias("staffing_rating"),
    )


def _measure_code(line: Column) -> Column:
    m = line % 4
    expr = None
    for r, code in MEASURE_BY_LINE_MOD4.items():
        expr = F.when(m == r, F.lit(code)) if expr is None else expr.when(m == r, F.lit(code))
    return expr


def quality_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated claims rows, typed as ``CLAIMS_SCHEMA``."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity")
    g = li.groupBy("l_suppkey", "l_linenumber").agg(
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("mean_qty"),
        F.max("l_quantity").alias("max_qty"),
        F.min("l_quantity").alias("min_qty"),
    )
    code = _measure_code(F.col("l_linenumber")).cast("int")
    desc = None
    for c, text in MEASURE_TEXT.items():
        desc = F.when(code == c, text) if desc is None else desc.when(code == c, text)
    return g.select(
        F.col("l_suppkey").cast("string").alias("provider_id"),
        code.alias("measure_code"),
        desc.alias("measure_description"),
        F.when(code.isin(*SHORT_STAY), "Short Stay").otherwise("Long Stay").alias("resident_type"),
        F.when(F.col("l_suppkey") % 9 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("mean_qty")).alias("adjusted_score"),
        F.col("max_qty").alias("observed_score"),
        F.col("min_qty").alias("expected_score"),
        F.when(code.isin(*FIVE_STAR), "Y").otherwise("N").alias("used_in_five_star"),
        F.lit(MEASURE_PERIOD).alias("measure_period"),
        F.lit(PROCESSING_DATE).cast("date").alias("processing_date"),
    )


def staffing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item grain staffing rows: several rows can share one facility-day,
    the situation the duplicate-row and duplicate-key checks look for."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("provnum"),
        F.to_date("l_shipdate").alias("workdate"),
        F.col("l_linenumber").cast("double").alias("mdscensus"),
        *[
            F.when(F.col("l_returnflag") == F.lit(flag), F.col("l_quantity")).alias(S.hrs(role))
            for role, flag in FLAG_BY_ROLE.items()
        ],
    )


# Defects planted in the raw-text rendition, keyed by day of month.
PADDED_ID_DAY, BLANK_ID_DAY, BAD_DATE_DAY = 1, 2, 3
NULL_CENSUS_DAY, NEGATIVE_CENSUS_DAY, BAD_HOURS_DAY, EMPTY_ROW_DAY = 4, 5, 6, 7
NEGATIVE_HOURS_DAY, OVER_CONTRACT_DAY = 8, 9
OVER_CONTRACT_HOURS = 1000.0
_DAY = "_day"


def staffing_raw_text(staffing: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``staffing_daily`` rows rendered the way the raw CSV carries them: every column
    a string under its source header, dates as ``yyyyMMdd``.

    Defects are planted by day of month: padded id (kept, trimmed), blank id,
    unparseable date, missing census, negative census (all dropped), text in an
    hour column (becomes NULL), an all-empty row (dropped), negative RN hours and
    RN contract hours above the total (both kept and counted).  Columns in ``keep`` are carried along.
    """
    # The ids are never negative; with them the day is computed once a row, not once more
    # for every column of a filter that is moved below it.
    d = staffing.withColumn(_DAY, F.when(F.monotonically_increasing_id() >= 0, F.dayofmonth("workdate")))
    dom = F.col(_DAY)

    def shown(c: Column) -> Column:
        return F.when(dom != EMPTY_ROW_DAY, c)

    provnum = (
        F.when(dom == PADDED_ID_DAY, F.concat(F.lit("  "), F.col("provnum"), F.lit(" ")))
        .when(dom == BLANK_ID_DAY, F.lit("   "))
        .otherwise(F.col("provnum"))
    )
    workdate = F.when(dom == BAD_DATE_DAY, F.lit("bad")).otherwise(
        F.date_format("workdate", "yyyyMMdd")
    )
    census = (
        F.when(dom == NULL_CENSUS_DAY, F.lit(None).cast("string"))
        .when(dom == NEGATIVE_CENSUS_DAY, F.lit("-1"))
        .otherwise(F.col("mdscensus").cast("string"))
    )
    hours = []
    for header, name in S.hour_columns():
        v = F.col(name).cast("string")
        if name == S.hrs("RN"):
            v = F.when(dom == BAD_HOURS_DAY, F.lit("x")).when(
                dom == NEGATIVE_HOURS_DAY, (-F.col(name)).cast("string")).otherwise(v)
        if name == S.hrs("RN", "_ctr"):
            v = F.when(dom == OVER_CONTRACT_DAY, F.lit(str(OVER_CONTRACT_HOURS))).otherwise(v)
        hours.append(shown(v).alias(header))
    dims = [shown(F.col(n)).alias(h) for h, n in S.STAFFING_DIMENSIONS if n != "provnum"]
    return d.select(
        shown(provnum).alias("PROVNUM"),
        *dims,
        shown(workdate).alias(S.STAFFING_DATE[0]),
        shown(census).alias(S.STAFFING_CENSUS[0]),
        *hours,
        *(keep or []),
    )


# Incremental-ingestion fixtures derived from ``orders``: one listed file per order.
LANDING_FOLDER = "landing"
OLD_TIME = "1900-01-01"


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows: folders, native documents and trashed entries are planted
    among the pending orders (status 'P')."""
    o = table(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    prio = F.col("o_orderpriority")
    mime = (
        F.when(pending & (prio == "5-LOW"), F.lit(S.FOLDER_MIME))
        .when(pending & (prio == "4-NOT SPECIFIED"), F.lit(S.NATIVE_DOC_PREFIX + "spreadsheet"))
        .otherwise(F.lit("text/csv"))
    )
    return o.select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.concat(F.lit("orders_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("name"),
        mime.alias("mime_type"),
        F.to_date("o_orderdate").cast("string").alias("modified_time"),
        prio.alias("source"),
        F.lit(LANDING_FOLDER).alias("parent"),
        (pending & (prio == "1-URGENT")).alias("trashed"),
    )


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State from an earlier run: two thirds of the orders, a fifth of them
    recorded with an old modification time."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 != 0)
    k = F.col("o_orderkey")
    name = F.concat(F.lit("orders_"), k.cast("string"), F.lit(".csv"))
    return o.select(
        k.cast("string").alias("file_id"),
        name.alias("name"),
        F.when(k % 5 == 0, F.lit(OLD_TIME))
        .otherwise(F.to_date("o_orderdate").cast("string"))
        .alias("modified_time"),
        F.col("o_orderpriority").alias("source"),
        F.concat_ws("/", F.col("o_orderpriority"), name).alias("target_key"),
    )


def copy_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy results: every 97th order fails."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        (F.col("o_orderkey") % 97 != 0).alias("ok"),
    )


def as_raw_text(df: DataFrame, layout: list[tuple[str, str, str]]) -> DataFrame:
    """Curated columns rendered as strings under their source headers."""
    return df.select(*[F.col(n).cast("string").alias(h) for h, n, _ in layout])


def provider_raw_text(provider: DataFrame) -> DataFrame:
    """Provider rows as the raw file carries them, with duplicate ids (padded, and
    with a name that sorts last) and rows without an id."""
    raw = as_raw_text(provider, S.PROVIDER_COLUMNS)
    key, name = S.PROVIDER_COLUMNS[0][0], S.PROVIDER_COLUMNS[1][0]
    again = raw.withColumn(key, F.concat(F.lit(" "), F.col(f"`{key}`"), F.lit(" "))).withColumn(name, F.lit("~ repeated"))
    blank = raw.withColumn(key, F.lit(None).cast("string"))
    return raw.unionByName(again).unionByName(blank)


def claims_raw_text(claims: DataFrame) -> DataFrame:
    """Claims rows as the raw file carries them: measure codes with a decimal, and
    rows whose id is missing or whose measure code is text."""
    raw = as_raw_text(claims, S.CLAIMS_COLUMNS)
    key, measure = S.CLAIMS_COLUMNS[0][0], S.CLAIMS_COLUMNS[1][0]
    pointed = raw.withColumn(measure, F.concat(F.col(f"`{measure}`"), F.lit(".0")))
    no_id = raw.withColumn(key, F.lit(None).cast("string"))
    no_code = raw.withColumn(measure, F.lit("n/a"))
    return pointed.unionByName(no_id).unionByName(no_code)


def quarter_folders(base: str) -> list[str]:
    return [f"{base}/quarter=q{q}" for q in (1, 2, 3, 4)]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_defective_csv(spark: SparkSession, staffing: DataFrame, provider: DataFrame, claims: DataFrame, out: str) -> dict:
    """Whole raw CSV inputs with planted defects: staffing in a folder a quarter.

    The staffing rows are rendered in one pass.  They come in tasks of bounded size
    (``staffing_daily``), which sort them by quarter before they are made text.
    """
    def put(df: DataFrame, path: str, folder: str | None = None) -> None:
        writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
        (writer.partitionBy(folder) if folder else writer).csv(path)

    dated = staffing.where("workdate IS NOT NULL").withColumn("quarter", F.concat(F.lit("q"), F.quarter("workdate")))
    text = staffing_raw_text(dated.sortWithinPartitions("quarter"), keep=["quarter"])
    tables = [(text, f"{out}/pbj", "quarter"), (provider_raw_text(provider), f"{out}/provider"), (claims_raw_text(claims), f"{out}/claims")]
    # Written side by side: the last tasks of one table leave no core idle.
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        for job in [pool.submit(put, *t) for t in tables]:
            job.result()
    folders = [f for f in quarter_folders(f"{out}/pbj") if _exists(spark, f)]
    if not folders:  # no row: a header alone
        folders = quarter_folders(f"{out}/pbj")[:1]
        put(text.drop("quarter").limit(0), folders[0])
    return {"pbj": folders, "provider": f"{out}/provider", "claims": f"{out}/claims"}


def write_raw_inputs(spark: SparkSession, sf_dir: str, out: str, staffing: DataFrame | None = None) -> dict:
    """Write the three raw CSV inputs of the batch pipeline under ``out``."""
    st = staffing if staffing is not None else staffing_daily(spark, sf_dir)
    paths = {"pbj": f"{out}/pbj", "provider": f"{out}/provider", "claims": f"{out}/claims"}
    staffing_raw_text(st).write.mode("overwrite").option("header", True).csv(paths["pbj"])
    as_raw_text(provider_info(spark, sf_dir), S.PROVIDER_COLUMNS).write.mode("overwrite").option(
        "header", True).csv(paths["provider"])
    as_raw_text(quality_claims(spark, sf_dir), S.CLAIMS_COLUMNS).write.mode("overwrite").option(
        "header", True).csv(paths["claims"])
    return paths
