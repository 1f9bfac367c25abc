"""Incremental file ingestion as table operations.

The source pipeline walks a drive listing in a Python loop and keeps a JSON
state file ``{file_id: {name, modifiedTime, source, key}}``.  Here both are
DataFrames -- ``listing`` (one row per listed file) and ``manifest`` (one row
per file already ingested) -- and every step is a join or an aggregate, so a
listing of millions of files is classified by the cluster, not the driver.

Status rules (per file id):

* folders are ignored entirely (not counted);
* no manifest row -> NEW; manifest ``modified_time`` differs (``!=``, an older
  time counts too, NULL-safe) -> MODIFIED; else SKIPPED;
* a NEW / MODIFIED native document (cannot be downloaded) -> SKIPPED and is
  not recorded, so it is looked at again next run;
* a copy that failed -> FAILED and not recorded, so it is retried next run.

A Structured Streaming file source is not a substitute: it never re-reads a
file rewritten under the same path, which is exactly the MODIFIED case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline import schemas as S
from rosterline.session import ensure_checkpoint_dir

NEW, MODIFIED, SKIPPED, FAILED = "NEW", "MODIFIED", "SKIPPED", "FAILED"
TOTAL_LABEL = "TOTAL"

class IngestionError(RuntimeError):
    """At least one file failed to copy; the run must be reported as failed."""


class KeyCollisionError(IngestionError):
    """Two files would be copied to one target key; nothing was copied."""


def empty_manifest(spark: SparkSession) -> DataFrame:
    """First run: no state yet."""
    return spark.createDataFrame([], S.MANIFEST_SCHEMA)


def snapshot(df: DataFrame) -> DataFrame:
    """Freeze ``df`` with a reliable checkpoint in the shared checkpoint folder.

    A listing is re-read whenever a lazy plan re-executes -- the file reader
    takes file status at scan time -- so one run must classify, copy and record
    against one snapshot of it.  Copy outcomes are frozen the same way so that
    the copy step runs exactly once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def listing_from_folder(spark: SparkSession, path: str, source: str, glob: str = "*") -> DataFrame:
    """Snapshot listing of a lake folder (path = file id, no contents read)."""
    from rosterline.sources.files import list_files

    files = list_files(spark, path, glob)
    return snapshot(files.select(
        F.col("path").alias("file_id"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.lit("text/csv").alias("mime_type"),
        F.col("modificationTime").cast("string").alias("modified_time"),
        F.lit(source).alias("source"),
        # the folder the file really lies in: the scan recurses
        F.regexp_replace("path", "/[^/]*$", "").alias("parent"),
        F.lit(False).alias("trashed"),
    ))


def in_folder(listing: DataFrame, folder: str | None = None) -> DataFrame:
    """Files directly in ``folder`` that are not trashed."""
    out = listing.where(~F.coalesce(F.col("trashed"), F.lit(False)))
    if folder is not None:
        out = out.where(F.col("parent") == F.lit(folder))
    return out


def target_key(prefix: F.Column | str, name: F.Column | str) -> F.Column:
    """Object key ``prefix/name`` of the copied file."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    n = F.col(name) if isinstance(name, str) else name
    return F.concat_ws("/", p, n)


def classify(
    listing: DataFrame,
    manifest: DataFrame,
    folder_mime: str = S.FOLDER_MIME,
    native_prefix: str = S.NATIVE_DOC_PREFIX,
) -> DataFrame:
    """Status of every listed non-folder file against the manifest.

    Adds ``status`` (NEW / MODIFIED / SKIPPED) and ``copy`` (True when the file
    must be copied: NEW or MODIFIED and not a native document).
    """
    files = listing.where(
        F.col("mime_type").isNull() | (F.col("mime_type") != F.lit(folder_mime))
    )
    prior = manifest.select(
        F.col("file_id").alias("_mid"), F.col("modified_time").alias("_prev_time")
    )
    j = files.join(prior, files["file_id"] == prior["_mid"], "left")
    changed = ~F.col("_prev_time").eqNullSafe(F.col("modified_time"))
    status = (
        F.when(F.col("_mid").isNull(), F.lit(NEW))
        .when(changed, F.lit(MODIFIED))
        .otherwise(F.lit(SKIPPED))
    )
    native = F.coalesce(F.col("mime_type").startswith(native_prefix), F.lit(False))
    return (
        j.withColumn("status", status)
        .withColumn("copy", (F.col("status") != F.lit(SKIPPED)) & ~native)
        .drop("_mid", "_prev_time")
    )


def key_collisions(classified: DataFrame, prefix_col: str = "source") -> DataFrame:
    """Target keys that two different file ids would write (same name)."""
    keyed = classified.where("copy").withColumn("target_key", target_key(F.col(prefix_col), "name"))
    return (
        keyed.groupBy("target_key")
        .agg(F.count_distinct("file_id").alias("file_ids"))
        .where(F.col("file_ids") > 1)
    )


def check_no_collisions(classified: DataFrame) -> None:
    """Raise ``KeyCollisionError`` before anything is copied over another file."""
    found = key_collisions(classified).orderBy("target_key").take(5)
    if found:
        raise KeyCollisionError(f"several files share a target key: {[r['target_key'] for r in found]}")


def results(classified: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Final per-file status after the copy step.

    ``outcomes`` has ``file_id`` and ``ok`` for the files that were attempted.
    """
    o = outcomes.select(F.col("file_id").alias("_oid"), F.col("ok").alias("_ok"))
    j = classified.join(o, classified["file_id"] == o["_oid"], "left")
    final = (
        F.when(~F.col("copy"), F.lit(SKIPPED))
        .when(F.coalesce(F.col("_ok"), F.lit(False)), F.col("status"))
        .otherwise(F.lit(FAILED))
    )
    return j.withColumn("final_status", final).drop("_oid", "_ok")


def next_manifest(manifest: DataFrame, finished: DataFrame, prefix_col: str = "source") -> DataFrame:
    """Upsert the files copied successfully; everything else keeps its old row."""
    return _upserted(manifest, changed_rows(finished, prefix_col))


def changed_rows(finished: DataFrame, prefix_col: str = "source") -> DataFrame:
    """Manifest rows of the files copied successfully."""
    return finished.where(F.col("final_status").isin(NEW, MODIFIED)).select(
        "file_id",
        "name",
        "modified_time",
        "source",
        target_key(F.col(prefix_col), "name").alias("target_key"),
    )


def _upserted(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    kept = manifest.join(rows.select("file_id"), "file_id", "left_anti")
    return kept.unionByName(rows)


def summary(finished: DataFrame) -> DataFrame:
    """new / modified / skipped / failed per source, plus a TOTAL row."""
    fs = F.col("final_status")
    g = finished.rollup("source").agg(
        F.grouping("source").alias("_total"),
        F.count_if(fs == NEW).alias("new"),
        F.count_if(fs == MODIFIED).alias("modified"),
        F.count_if(fs == SKIPPED).alias("skipped"),
        F.count_if(fs == FAILED).alias("failed"),
    )
    return g.select(
        F.when(F.col("_total") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("source")).alias("source"),
        "new", "modified", "skipped", "failed",
    )


def check_no_failures(summary_df: DataFrame) -> dict:
    """Raise ``IngestionError`` when the TOTAL row reports failed files."""
    total = summary_df.where(F.col("source") == TOTAL_LABEL).first()
    row = total.asDict() if total else {"new": 0, "modified": 0, "skipped": 0, "failed": 0}
    if row["failed"]:
        raise IngestionError(f"{row['failed']} file(s) failed to ingest")
    return row


def run_ingestion(
    spark: SparkSession,
    listing: DataFrame,
    manifest_base: str,
    sources: list[str],
    copy,
    folder: str | None = None,
) -> DataFrame:
    """Ingest each source in turn and checkpoint the manifest after each one.

    ``copy(files)`` receives the files to copy (``copy`` is true) and returns
    ``(file_id, ok)`` outcomes -- for a lake this is the job that reads the
    NEW / MODIFIED paths.  After every source its changed rows are appended to
    the manifest, which is read back, so a crash loses at most one source's work
    and the next source starts from stored state (lineage is cut there).
    Raises ``IngestionError`` at the end when any file failed.
    """
    if not sources:
        raise ValueError("run_ingestion needs at least one source")
    listing = snapshot(listing)
    manifest = read_manifest(spark, manifest_base)
    finished = []
    for src in sources:
        files = in_folder(listing.where(F.col("source") == F.lit(src)), folder)
        classified = classify(files, manifest)
        check_no_collisions(classified)
        fin = snapshot(results(classified, copy(classified.where("copy"))))
        append_changes(changed_rows(fin), manifest_base)
        manifest = read_manifest(spark, manifest_base)
        finished.append(fin)
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    summ = summary(out)
    check_no_failures(summ)
    return summ


# ---------------------------------------------------------------------------
# Manifest storage: a log of states, each a folder that is never written again.
#
# A state is a snapshot (all rows) or a delta (the rows that changed since the state
# before).  The manifest is the last snapshot with the later deltas laid over it, so a
# run writes as many rows as files changed.  When the deltas have grown to a share of
# the snapshot, or are many, they are compacted into a new snapshot.  A folder counts
# once it has its commit marker; one without it is a write that failed, and its number
# is used again.
# ---------------------------------------------------------------------------

VERSION, DELTA = "manifest_version", "manifest_delta"

#: Snapshots that stay on disk: the one being read and a few to go back to.
KEPT_VERSIONS = 5
#: Deltas at most, and rows of deltas for a row of the snapshot, before they are
#: compacted; fewer rows than COMPACT_ROWS are left alone.
MOST_DELTAS, DELTA_SHARE, COMPACT_ROWS = 32, 0.5, 10_000
_NUMBER = "_state"


def _states(spark: SparkSession, base: str) -> dict[int, str]:
    """Committed states (number -> VERSION or DELTA), from the folder listing alone.

    Only a folder that does not exist is a first run; any other error is raised.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    found = {}
    for status in fs.listStatus(path):
        kind, _, number = status.getPath().getName().partition("=")
        if status.isDirectory() and kind in (VERSION, DELTA):
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found[int(number)] = kind
    return dict(sorted(found.items()))


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of all committed states."""
    return list(_states(spark, base))


def _version_path(base: str, version: int, kind: str = VERSION) -> str:
    return f"{base}/{kind}={version}"


def _snapshot_and_deltas(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame | None]:
    """The last snapshot, and the rows of the deltas after it with their numbers."""
    states = _states(spark, base)
    last = max((n for n, kind in states.items() if kind == VERSION), default=-1)
    rows = empty_manifest(spark) if last < 0 else spark.read.schema(S.MANIFEST_SCHEMA).parquet(_version_path(base, last))
    paths = [_version_path(base, n, DELTA) for n in states if n > last]
    if not paths:
        return rows, None
    schema = T.StructType([*S.MANIFEST_SCHEMA.fields, T.StructField(_NUMBER, T.LongType())])
    return rows, spark.read.schema(schema).parquet(*paths)


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The manifest as of the last committed state; empty on the first run.

    Only the deltas are aggregated; the snapshot meets their ids in one anti join.
    """
    rows, deltas = _snapshot_and_deltas(spark, base)
    if deltas is None:
        return rows
    names = S.MANIFEST_SCHEMA.names
    latest = deltas.groupBy("file_id").agg(F.max_by(F.struct(*names), _NUMBER).alias("_row")).select("_row.*")
    return _upserted(rows, latest.select(*names)).select(*names)


def append_changes(changes: DataFrame, base: str) -> int:
    """Write changed manifest rows as the next state; compact the log when it has grown."""
    spark = changes.sparkSession
    states = _states(spark, base)
    number = max(states, default=-1) + 1
    changes.select(*S.MANIFEST_SCHEMA.names, F.lit(number).cast("long").alias(_NUMBER)).write.mode("overwrite").parquet(
        _version_path(base, number, DELTA)
    )
    rows, deltas = _snapshot_and_deltas(spark, base)  # counts come from Parquet footers
    many = sum(1 for kind in states.values() if kind == DELTA) >= MOST_DELTAS
    if len(states) and (many or deltas.count() > max(DELTA_SHARE * rows.count(), COMPACT_ROWS)):
        write_manifest(read_manifest(spark, base), base)
    return number


def write_manifest(manifest: DataFrame, base: str) -> int:
    """Write the manifest as a snapshot, the next state, and return its number.

    A new folder never touches the states being read, so a failed write leaves
    them intact.  Snapshots beyond KEPT_VERSIONS go, with all states before them.
    """
    spark = manifest.sparkSession
    states = _states(spark, base)
    version = max(states, default=-1) + 1
    manifest.write.mode("overwrite").parquet(_version_path(base, version))
    snapshots = [n for n, kind in states.items() if kind == VERSION] + [version]
    oldest = snapshots[-KEPT_VERSIONS:][0] if len(snapshots) > KEPT_VERSIONS else -1
    for n, kind in states.items():
        if n < oldest:
            path = spark._jvm.org.apache.hadoop.fs.Path(_version_path(base, n, kind))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return version
