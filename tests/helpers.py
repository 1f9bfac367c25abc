"""Small builders for literal test frames."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession

from rosterline import schemas as S


def staffing_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Curated staffing rows; unspecified columns are NULL."""
    names = [f.name for f in S.STAFFING_SCHEMA.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, S.STAFFING_SCHEMA)


def provider_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [f.name for f in S.PROVIDER_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.PROVIDER_SCHEMA)


def claims_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [f.name for f in S.CLAIMS_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.CLAIMS_SCHEMA)


def write_csv(path: str, header: list[str], rows: list[list]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])
    return path
