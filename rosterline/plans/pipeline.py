"""The batch jobs: raw files -> curated tables -> enriched table -> views.

Order: (staffing || provider || claims) -> facility partials -> enrichment -> views,
summaries and profile.

The raw staffing files are parsed once, into a typed Parquet table of all rows with
their file and defects; counts, rows per file, malformed records, the curated table
and the profile read its columns.  The curated daily rows are scanned once for the
facility partials, from which the guards and all summaries follow, and once for the
enrichment join.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.functions.metrics import any_of
from rosterline.operators import clean as C
from rosterline.operators import enrich as E
from rosterline.operators import profile as P
from rosterline.operators.derive import with_daily_metrics
from rosterline.plans import views as V
from rosterline.sources import files, sinks
from rosterline.sources.files import select_by_header

PRESENT = "has_values"
DAY_ORDER = ["provnum", "workdate"]


@dataclass
class Paths:
    raw_staffing: str | list[str]
    raw_provider: str
    raw_claims: str
    out_base: str
    run_id: str
    # Quoted fields may contain newlines; False saves the pass that looks for them.
    multiline: bool = True
    # Each attempt of a run has directories of its own.
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def curated(self, name: str) -> str:
        return sinks.run_path(f"{self.out_base}/{name}", self.run_id, self.attempt)


@dataclass
class RunReport:
    counts: dict = field(default_factory=dict)
    coverage: dict = field(default_factory=dict)
    summaries: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)

    def timed(self, step: str, fn, *args, **kwargs):
        t0 = time.perf_counter()
        out = fn(*args, **kwargs)
        self.seconds[step] = round(time.perf_counter() - t0, 3)
        return out


def _observe(df: DataFrame, name: str, *exprs) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *exprs), obs


def _counts(*observations: Observation, names: list[str]) -> dict:
    """Observed counts; a plan that turned out empty reports none, which is 0."""
    out = dict.fromkeys(names, 0)
    for obs in observations:
        try:
            out |= {k: v or 0 for k, v in obs.get.items()}
        except Py4JJavaError as e:
            # The optimizer removed the whole plan, so nothing was observed.
            if "AssertionError" not in str(e.java_exception):
                raise
    return out


def stage_staffing(spark: SparkSession, raw_path: str | list[str], typed_path: str, multiline: bool = True) -> DataFrame:
    """The raw staffing files parsed once: every row typed, with its file, its text if
    malformed, and whether it has any value."""
    raw = files.read_csv(spark, raw_path, multiline=multiline, malformed=True)
    text = select_by_header(raw, S.STAFFING_SOURCE_HEADERS, keep=[files.SOURCE_FILE, files.MALFORMED])
    present = any_of([F.col(f"`{h}`").isNotNull() for h in S.STAFFING_SOURCE_HEADERS])
    typed = C.type_staffing(text.withColumn(PRESENT, present), keep=[files.MALFORMED, PRESENT])
    sinks.write_table(typed, typed_path)
    return spark.read.parquet(typed_path)


def run_staffing(
    spark: SparkSession, raw_path: str | list[str], out_path: str, multiline: bool = True
) -> dict:
    """Raw daily staffing CSV -> staffing metrics table partitioned by state.

    Reports the rows of every stage, the reasons for dropped rows and the malformed
    records; writes beside the table its typed rows (``_typed``), the rows per source
    file (``_files``) and the malformed records (``_malformed``).  No valid row is an
    error.
    """
    typed = stage_staffing(spark, raw_path, f"{out_path}_typed", multiline)
    present, valid = F.col(PRESENT), F.col(PRESENT) & C.valid_condition()
    blank_state = F.col("state").isNull() | (F.trim("state") == "")
    got = typed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count(files.MALFORMED).alias("malformed_rows"),
        F.count_if(present).alias("present_rows"),
        *[F.count_if(present & c).alias(f"dropped_{n}") for n, c in C.staffing_defects().items()],
        F.count_if(valid).alias("valid_rows"),
        F.count_if(valid & P.negative_hour_condition(typed)).alias("negative_hour_rows"),
        F.count_if(valid & blank_state).alias("default_partition_rows"),
    ).first().asDict()
    got["dropped_empty"] = got["raw_rows"] - got["present_rows"]
    sinks.write_table(P.rows_per_source_file(typed), f"{out_path}_files")
    broken = typed.where(F.col(files.MALFORMED).isNotNull())
    sinks.write_table(broken.select(files.SOURCE_FILE, files.MALFORMED), f"{out_path}_malformed")
    if not got["valid_rows"]:
        raise E.GuardError(f"no valid staffing row in {raw_path}: {got}")
    rows = typed.where(PRESENT).drop(files.SOURCE_FILE, files.MALFORMED, PRESENT)
    daily = with_daily_metrics(C.valid_staffing(rows)).withColumn("etl_processed_at", F.current_timestamp())
    sinks.write_clustered(daily, out_path, "state", DAY_ORDER)
    return got


def run_provider(spark: SparkSession, raw_path: str, out_path: str, multiline: bool = True) -> dict:
    raw = files.read_csv(spark, raw_path, with_source=False, multiline=multiline)
    raw, o_raw = _observe(raw, "provider_raw", F.count(F.lit(1)).alias("provider_raw_rows"))
    cur = C.clean_provider(raw)
    cur, o_out = _observe(cur, "provider_out", F.count(F.lit(1)).alias("provider_rows"))
    sinks.write_table(cur.withColumn("etl_processed_at", F.current_timestamp()), out_path)
    return _counts(o_raw, o_out, names=["provider_raw_rows", "provider_rows"])


def run_claims(spark: SparkSession, raw_path: str, out_path: str, multiline: bool = True) -> dict:
    raw = files.read_csv(spark, raw_path, with_source=False, multiline=multiline)
    raw, o_raw = _observe(raw, "claims_raw", F.count(F.lit(1)).alias("claims_raw_rows"))
    cur = C.clean_claims(raw)
    cur, o_out = _observe(cur, "claims_out", F.count(F.lit(1)).alias("claims_rows"))
    sinks.write_table(cur.withColumn("etl_processed_at", F.current_timestamp()), out_path)
    return _counts(o_raw, o_out, names=["claims_raw_rows", "claims_rows"])


def repeated_days(partials: DataFrame) -> int:
    """Rows of the daily table whose facility and day occurred before, from the facility partials."""
    days = partials.groupBy("provnum", "_chunk").agg(F.sum("_days").alias("rows"), F.bit_count(F.bit_or("_bits")).alias("days"))
    return days.agg(F.sum(F.col("rows") - F.col("days"))).first()[0] or 0


def run_enrichment(
    spark: SparkSession,
    staffing_path: str,
    provider_path: str,
    out_path: str,
    min_coverage: float = S.MIN_JOIN_COVERAGE_PCT,
    partials_path: str | None = None,
) -> dict:
    """Guarded left join of staffing days to providers, and the facility partials.

    Fails before writing when a facility and day repeat or coverage is below
    ``min_coverage``; fails after writing (the attempt is then never published) when
    the row count changed.
    """
    staffing = spark.read.parquet(staffing_path)
    provider = spark.read.parquet(provider_path).drop("etl_processed_at")
    partials_path = partials_path or f"{out_path}_partials"
    sinks.write_table(V.facility_partials(staffing), partials_path)
    partials = spark.read.parquet(partials_path)
    if repeated := repeated_days(partials):
        raise E.GuardError(f"{repeated} rows repeat a facility and day; nothing is published")
    sinks.write_table(E.unmatched_ids(partials, provider), f"{out_path}_unmatched")
    coverage = E.check_coverage(E.join_coverage(partials, provider), min_coverage)
    enriched = E.enrich_daily(staffing, provider).withColumn(
        "facility_metrics_processed_at", F.current_timestamp()
    )
    # A join that broadcasts the providers leaves the daily rows where the files had
    # them: clustered.  One that shuffles by facility loses that.
    shuffled = "SortMergeJoin" in enriched._jdf.queryExecution().executedPlan().toString()
    sinks.write_clustered(enriched, out_path, "state", DAY_ORDER, laid_out=not shuffled)
    expected, written = staffing.count(), spark.read.parquet(out_path).count()  # Parquet footers only
    E.check_row_count(expected, written)
    return {"coverage": coverage, "enriched_rows": written, "input_rows": expected}


def merged_partials(spark: SparkSession, out_base: str, own: dict[str, str]) -> DataFrame:
    """Facility partials of every complete run, ``own`` (run -> attempt) taking the place of theirs."""
    runs = own
    if spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_base}/commits").getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()
    ).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_base}/commits")):
        runs = sinks.committed(spark, out_base) | own
    paths = [sinks.run_path(f"{out_base}/facility_partials", r, a) for r, a in sorted(runs.items())]
    return spark.read.parquet(*paths)


def publish(
    spark: SparkSession, partials: DataFrame, provider_path: str, claims_path: str, metrics_path: str, views_base: str
) -> list[str]:
    """Write the views from the facility partials, then point every published name at its new version."""
    from rosterline.plans import sql_views

    provider, claims = (spark.read.parquet(p).drop("etl_processed_at") for p in (provider_path, claims_path))
    views = sql_views.write_views(spark, partials, provider, claims, views_base)
    sinks.publish_version(spark, "facility_metrics", metrics_path, S.FACILITY_METRICS_SCHEMA, "state")
    sinks.publish_version(spark, "quality_claims", claims_path, S.PUBLISHED_CLAIMS_SCHEMA)
    for name, (path, schema, partition_col) in views.items():
        sinks.publish_version(spark, name, path, schema, partition_col)
    return list(views)


PERIOD = ("2024-04-01", "2024-06-30")


def write_profile(spark: SparkSession, typed_path: str, out_base: str, period: tuple[str, str] = PERIOD) -> list[str]:
    """The data profile of the typed rows, a CSV report each."""
    reports = P.profile_reports(spark.read.parquet(typed_path).where(PRESENT).drop(files.MALFORMED, files.SOURCE_FILE, PRESENT), *period)
    for name, df in reports.items():
        sinks.write_report_csv(df, f"{out_base}/{name}")
    return list(reports)


def validation_summaries(spark: SparkSession, staffing_path: str) -> dict[str, list]:
    """Dataset, state and quarter summaries from the written table (small results)."""
    t = spark.read.parquet(staffing_path)
    return {
        "dataset": [r.asDict() for r in P.dataset_summary(t).collect()],
        "states": [r.asDict() for r in P.state_distribution(t).collect()],
        "quarters": [r.asDict() for r in P.quarter_distribution(t).collect()],
        # One row per file, which grows with the input: the table is named, its
        # number of files and their rows are counted.
        "files": [spark.read.parquet(f"{staffing_path}_files").agg(
            F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first().asDict()
            | {"table": f"{staffing_path}_files"}],
        "state_conflicts": [r.asDict() for r in P.state_conflicts(t).collect()],
    }


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Total size of the raw input files (listing metadata only)."""
    paths = [path] if isinstance(path, str) else list(path)
    total = 0
    for p in paths:
        total += files.list_files(spark, p).agg(F.sum("length")).first()[0] or 0
    return int(total)


def run_all(spark: SparkSession, paths: Paths, tune: bool = False, history: bool = False) -> RunReport:
    """All jobs in order.  With ``tune`` the session's split and shuffle sizes
    are set from the staffing input's size first (``session.scale_conf``).

    With ``history`` the views cover every complete run under ``out_base``, one
    reporting period each: only this run's daily rows are scanned, the others come
    in by their facility partials.  A rerun of a period takes its earlier one's place.
    """
    rep = RunReport()
    if tune:
        from rosterline.session import apply_scale_conf

        rep.counts["conf"] = apply_scale_conf(spark, input_bytes(spark, paths.raw_staffing))
    staffing_out = paths.curated("staffing_metrics")
    provider_out = paths.curated("provider_info")
    claims_out = paths.curated("quality_claims")
    metrics_out = paths.curated("facility_metrics")
    # The three curated jobs are independent branches: submit them together so
    # Spark can schedule their tasks side by side.
    with ThreadPoolExecutor(max_workers=3) as pool:
        jobs = {
            "staffing": pool.submit(rep.timed, "staffing", run_staffing, spark,
                                    paths.raw_staffing, staffing_out, paths.multiline),
            "provider": pool.submit(rep.timed, "provider", run_provider, spark,
                                    paths.raw_provider, provider_out, paths.multiline),
            "claims": pool.submit(rep.timed, "claims", run_claims, spark, paths.raw_claims, claims_out,
                                  paths.multiline),
        }
        for name, job in jobs.items():
            rep.counts[name] = job.result()
    partials_out = paths.curated("facility_partials")
    enr = rep.timed("enrichment", run_enrichment, spark, staffing_out, provider_out, metrics_out,
                    partials_path=partials_out)
    rep.coverage = enr["coverage"]
    rep.counts["enrichment"] = {k: v for k, v in enr.items() if k != "coverage"}
    partials = spark.read.parquet(partials_out)
    if history:
        partials = merged_partials(spark, paths.out_base, {paths.run_id: paths.attempt})
    rep.timed("publish", publish, spark, partials, provider_out, claims_out, metrics_out, paths.curated("views"))
    sinks.append_commit(spark, paths.out_base, paths.run_id, paths.attempt)
    rep.summaries = rep.timed("summaries", validation_summaries, spark, staffing_out)
    rep.summaries["profile"] = rep.timed(
        "profile", write_profile, spark, f"{staffing_out}_typed", paths.curated("profile"))
    return rep


def views_from_tables(spark: SparkSession, staffing_path: str, provider_path: str,
                      claims_path: str) -> dict[str, DataFrame]:
    """The DataFrame views over curated tables (aggregate first, then enrich)."""
    daily = spark.read.parquet(staffing_path).drop("etl_processed_at")
    provider = spark.read.parquet(provider_path).drop("etl_processed_at")
    claims = spark.read.parquet(claims_path).drop("etl_processed_at")
    fac = V.facility_summary(daily, provider)
    return {
        "facility_summary": fac,
        "state_summary": V.state_summary(daily, provider),
        "facility_analytics": V.facility_analytics(fac, V.quality_pivot(claims)),
    }
