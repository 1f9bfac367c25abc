"""Work and memory that must not grow faster than the input."""

import datetime as dt
import os
import re

import pytest

from helpers import write_csv
from rosterline import schemas as S
from rosterline.operators import clean as C
from rosterline.plans import registry
from rosterline.sources import files, sinks
from rosterline.sources import testmap as M


@pytest.fixture()
def tables(spark, tmp_dir):
    """Line items of 40 suppliers over 30 days; supplier 7 comes twice, one line item has no supplier."""
    day = dt.datetime(1996, 1, 1)
    items = [(i, 1 + i % 3, float(i % 7), "RNA"[i % 3], "OF"[i % 2], day + dt.timedelta(days=i // 40 % 30), i % 40)
             for i in range(2400)]
    items.append((2400, 1, 1.0, "R", "O", None, 3))
    items.append((2401, 1, 1.0, "R", "O", day, None))
    spark.createDataFrame(
        items, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp, l_suppkey long").repartition(4).write.parquet(f"{tmp_dir}/lineitem.parquet")
    suppliers = [(k, f"Supplier {k}", k % 5) for k in range(40)] + [(7, "Supplier 7 again", 4), (99, "No nation", None)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey long").write.parquet(
        f"{tmp_dir}/supplier.parquet")
    spark.createDataFrame([(k, f"NATION_{k}") for k in range(5)], "n_nationkey long, n_name string").write.parquet(
        f"{tmp_dir}/nation.parquet")
    return tmp_dir


def test_staffing_days_are_summed_in_tasks_of_bounded_size(spark, tables, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_TASK", 300)
    daily = M.staffing_daily(spark, tables)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    # The line items are shuffled, once, and no partial sums of them are.
    assert plan.count("rangepartitioning") == 1
    assert not sinks.shuffles_join(daily)
    assert not re.search(r"Exchange hashpartitioning\(l_suppkey#\d+L?, workdate", plan)
    parts = daily.rdd.glom().map(lambda rows: [(r["provnum"], r["workdate"]) for r in rows]).collect()
    assert len(parts) == 9
    assert max(map(len, parts)) < 600
    seen = [set(p) for p in parts]
    assert sum(map(len, seen)) == len(set().union(*seen))  # no facility and day in two tasks


def test_staffing_days_keep_all_suppliers_and_line_items(spark, tables, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_TASK", 300)
    rows = M.staffing_daily(spark, tables).collect()
    # 40 suppliers of 30 days, a day without date, and the days of the supplier that comes twice.
    assert len(rows) == 40 * 30 + 1 + 30
    assert sum(r["provnum"] == "3" and r["workdate"] is None for r in rows) == 1
    assert {r["provname"] for r in rows if r["provnum"] == "7"} == {"Supplier 7", "Supplier 7 again"}
    quantity = sum(sum(r[S.hrs(x)] or 0 for x in ("RN", "LPN", "CNA")) for r in rows if r["provname"] != "Supplier 7 again")
    assert quantity == sum(i % 7 for i in range(2400)) + 1


def test_curated_staffing_is_written_as_it_was_dealt(spark, tables, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_TASK", 300)
    dealt = []
    write = sinks.write_clustered
    monkeypatch.setattr(registry, "write_clustered", lambda *a, **k: (dealt.append(k), write(*a, **k)))
    assert registry.Inputs(spark, tables).staffing().count() == 40 * 30 + 1 + 30
    assert dealt == [{"laid_out": True}]


def _method_sizes(df, capsys) -> list[int]:
    capsys.readouterr()
    df.explain(mode="codegen")
    return [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


def test_typing_is_code_that_the_jvm_compiles(spark, tables, capsys):
    text = M.staffing_raw_text(registry.Inputs(spark, tables).staffing())
    monitor = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = _method_sizes(C.type_staffing(C.present_staffing(text)), capsys)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", monitor)
    assert sizes and max(sizes) < 8000


def test_a_record_is_parsed_once(spark, tmp_dir):
    header = S.STAFFING_SOURCE_HEADERS
    full = {"PROVNUM": " 15009 ", "STATE": "AL", "WorkDate": "20240401", "MDScensus": "50", "Hrs_RN": " 1.5", "Hrs_CNA": "x"}
    rows = [[full.get(h) for h in header], [None] * len(header), [None if h == "PROVNUM" else full.get(h) for h in header]]
    path = write_csv(os.path.join(tmp_dir, "raw", "a.csv"), header, rows)
    cleaned = C.clean_staffing(files.read_csv(spark, path))
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("from_csv") == 1
    got = cleaned.collect()
    assert len(got) == 1
    assert (got[0]["provnum"], got[0]["workdate"], got[0]["mdscensus"]) == ("15009", dt.date(2024, 4, 1), 50.0)
    assert (got[0]["hrs_rn"], got[0]["hrs_cna"], got[0]["hrs_rn_emp"]) == (1.5, None, None)
