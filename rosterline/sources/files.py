"""Raw file sources: header-named, all-string CSV scans.

Column types are never inferred (an inferred ``015009`` becomes the integer
15009 and cannot be recovered) and a ``StructType`` is never handed to the CSV
reader (it binds by position, not by header name).  Every column is read as a
string, selected by header name -- case-insensitively -- and converted by the
cleaning step with ``try_*`` functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.sources.records import MALFORMED, read_records

CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    # Check every file's header against the first one: files whose column
    # order differs fail instead of silently swapping values.
    "enforceSchema": "false",
    # Malformed lines become NULL fields (dropped by the cleaning filters)
    # instead of failing a large job.
    "mode": "PERMISSIVE",
}

SOURCE_FILE = "source_file"


def read_csv(
    spark: SparkSession, path: str | list[str], with_source: bool = True, multiline: bool = True, malformed: bool = False
) -> DataFrame:
    """All-string CSV scan of a file, a directory or a list of files, each read by many tasks.

    ``multiline`` allows quoted fields with embedded newlines (``sources.records``);
    without it the files hold one record a line, which saves a pass that only counts.
    ``malformed`` adds the text of records with another number of fields.
    """
    columns = spark.read.options(**CSV_OPTIONS).csv(path).columns
    if not columns:
        return spark.read.options(**CSV_OPTIONS).csv(path)
    if multiline:
        df = read_records(spark, path, columns, malformed)
        return df if with_source else df.drop(SOURCE_FILE)
    fields = [T.StructField(c, T.StringType()) for c in columns]
    reader = spark.read.options(**CSV_OPTIONS | {"multiLine": "false"})
    if malformed:
        fields.append(T.StructField(MALFORMED, T.StringType()))
        reader = reader.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", MALFORMED)
    df = reader.csv(path)
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")) if with_source else df


def read_csv_each(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with different layouts: one scan per file, combined by column name."""
    frames = [read_csv(spark, p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def select_by_header(df: DataFrame, headers: list[str], keep: list[str] | None = None) -> DataFrame:
    """Select ``headers`` by name, ignoring case; a missing header becomes a NULL string.

    Columns named in ``keep`` (e.g. the provenance column) are carried along.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for h in headers:
        src = by_lower.get(h.lower())
        if src == h:
            # No alias: constraints over many aliased columns multiply in the optimizer.
            cols.append(F.col(f"`{src}`"))
        else:
            cols.append((F.col(f"`{src}`") if src else F.lit(None).cast("string")).alias(h))
    for k in keep or []:
        if k in df.columns:
            cols.append(F.col(k))
    return df.select(*cols)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File listing of a lake folder: path, modification time and size only.

    ``binaryFile`` with a projection that omits ``content`` does not read the
    file bodies.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )
