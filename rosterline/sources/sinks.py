"""Parquet sinks and catalog registration.

* Partitioned writes use the ``rebalance`` hint on the partition column: AQE
  then sizes the write tasks and splits a state that holds a large share of
  the rows into several files, instead of one task per state.
* Daily tables are clustered: ranges of (state, facility, day), cut by sampled
  row counts, so that a facility lies in one file (or two at a border) of its
  state, whatever its state's size; sorted within the file, with Bloom filters on
  the facility id.  A look-up of one facility opens that file's row group alone.
* Every attempt of a run writes new directories (``.../run_id=<id>/attempt=<a>``),
  and only then are the published names pointed at them.  A write replaces all of
  its own directory (static overwrite), so no partition of an earlier one stays.
* A published name is a view over the table of one attempt.  Replacing the view is
  one change of the catalog: a reader sees the whole old version or the whole new one.
* A NULL or blank partition value is written as ``__HIVE_DEFAULT_PARTITION__``
  and reads back as NULL; partition values are read back as strings because
  partition-column type inference is switched off in the session.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables of earlier versions that stay registered for readers that began on them.
KEPT_VERSIONS = 1


def run_path(base: str, run_id: str, attempt: str | None = None) -> str:
    path = os.path.join(base, f"run_id={run_id}")
    return os.path.join(path, f"attempt={attempt}") if attempt else path


def _replacing(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def write_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """Parquet, replacing ``path``, one directory per value of ``partition_col``."""
    _replacing(df.hint("rebalance", partition_col)).partitionBy(partition_col).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_col: str, cluster: list[str], laid_out: bool = False) -> None:
    """Parquet, replacing ``path``: a directory per ``partition_col``, in it files of ranges of ``cluster``.

    ``laid_out`` says that the rows come in tasks that already hold such ranges: they
    are sorted in their tasks and nothing is shuffled.
    """
    order = [partition_col, *cluster]
    dealt = df if laid_out else df.repartitionByRange(*order)
    writer = _replacing(dealt.sortWithinPartitions(*order)).partitionBy(partition_col)
    options = {f"parquet.bloom.filter.enabled#{cluster[0]}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    writer.options(**options).parquet(path)


def shuffles_join(df: DataFrame) -> bool:
    """Whether the plan joins by a shuffle, which loses the ranges its rows were dealt in."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, replacing ``path``, unpartitioned."""
    _replacing(df).parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with header: one file while it is small.

    AQE joins the parts of a small result; a large report keeps several files.
    """
    df.hint("rebalance").write.mode("overwrite").option("header", "true").csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_col: str | None = None
) -> None:
    """Catalog table over a Parquet location with the given columns.

    The columns are fixed, not read from the files, so a run with other columns
    cannot change the table; in a persistent catalog every session sees it.
    ``MSCK REPAIR TABLE`` registers the partition folders, which a bare DDL
    would not.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    part = f" PARTITIONED BY ({partition_col})" if partition_col else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING PARQUET{part} LOCATION '{path}'")
    if partition_col:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def publish_version(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_col: str | None = None
) -> None:
    """Points the published ``name`` at the Parquet files at ``path``, in one step at the end.

    The files become a table of their own, with its partitions; then the view ``name``
    is replaced.  If anything fails before that, readers keep the old version.
    """
    table = f"{name}__{uuid.uuid4().hex[:12]}"
    register_external_table(spark, table, path, schema, partition_col)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a table of that name from before views were published
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('rosterline.table' = '{table}') AS SELECT * FROM {table}")
    _forget_versions(spark, name, table)


def _forget_versions(spark: SparkSession, name: str, current: str) -> None:
    """Unregisters old versions but for the latest KEPT_VERSIONS; external files stay."""
    created = {}
    for t in spark.catalog.listTables(pattern=f"{name}__*"):
        if t.name != current and t.tableType == "EXTERNAL":
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}").where("col_name = 'Created Time'").collect()
            created[t.name] = _instant(rows[0]["data_type"]) if rows else ""
    old = sorted(created, key=lambda n: (created[n], n))
    for n in old[: max(0, len(old) - KEPT_VERSIONS)]:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def _instant(text: str) -> str:
    """'Fri Dec 04 05:39:00 UTC 2026' in an order that sorts."""
    months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    part = text.split()
    return f"{part[-1]}-{months.index(part[1]):02d}-{part[2]} {part[3]}" if len(part) == 6 and part[1] in months else text


def append_commit(spark: SparkSession, base: str, run_id: str, attempt: str) -> None:
    """Records that an attempt of a run is complete: one appended file, never a rewrite."""
    row = spark.createDataFrame([(run_id, attempt)], "run_id string, attempt string")
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{base}/commits")


def committed(spark: SparkSession, base: str) -> dict[str, str]:
    """The latest complete attempt of every run: one entry a period."""
    log = spark.read.schema("run_id string, attempt string, committed_at timestamp").parquet(f"{base}/commits")
    return {r["run_id"]: r["attempt"] for r in log.groupBy("run_id").agg(F.max_by("attempt", "committed_at").alias("attempt")).collect()}


def null_partition_rows(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows whose partition value is NULL or blank (they land in the default partition)."""
    c = F.col(partition_col)
    return df.agg(F.count_if(c.isNull() | (F.trim(c) == "")).alias("default_partition_rows"))
