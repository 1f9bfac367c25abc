"""Raw CSV reading and cleaning: the edge rows of FIXTURES.md section 3."""

import os

import pytest
from helpers import write_csv
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.operators import clean as C
from rosterline.operators import profile as P
from rosterline.operators.derive import with_daily_metrics
from rosterline.sources import files

HEADER = S.STAFFING_SOURCE_HEADERS


def _row(**kw):
    base = {h: None for h in HEADER}
    base.update({"PROVNUM": "100", "STATE": "TX", "WorkDate": "20240401", "MDScensus": "10"})
    base.update(kw)
    return [base[h] for h in HEADER]


def _read_clean(spark, path):
    return C.clean_staffing(files.read_csv(spark, path))


def test_ids_dates_census_rules(spark, tmp_dir):
    rows = [
        [None] * len(HEADER),  # 1: all empty -> dropped
        _row(PROVNUM="015009"),  # 2: leading zero kept
        _row(PROVNUM="  200 "),  # 2: trimmed
        _row(PROVNUM="   "),  # 3: blank -> dropped
        _row(PROVNUM="300", WorkDate="bad"),  # 4
        _row(PROVNUM="301", WorkDate="20240230"),  # 4: impossible date
        _row(PROVNUM="302", WorkDate=""),  # 4
        _row(PROVNUM="400", MDScensus=""),  # 5: NULL census -> dropped
        _row(PROVNUM="401", MDScensus="-1"),  # 5: negative -> dropped
        _row(PROVNUM="402", MDScensus="0"),  # 5: zero kept
    ]
    p = write_csv(os.path.join(tmp_dir, "pbj", "a.csv"), HEADER, rows)
    out = {r.provnum: r for r in _read_clean(spark, p).collect()}
    assert set(out) == {"015009", "200", "402"}
    assert out["402"].mdscensus == 0.0
    assert out["015009"].workdate.isoformat() == "2024-04-01"


def test_null_policy_and_negative_hours(spark, tmp_dir):
    rows = [
        _row(PROVNUM="6", Hrs_LPN="5", Hrs_CNA="5"),  # 6: RN NULL
        _row(PROVNUM="7", Hrs_RN="0", Hrs_LPN="0", Hrs_CNA="0"),  # 7: all zero
        _row(PROVNUM="8", Hrs_RN="4", Hrs_NAtrn="-1"),  # 8: negative kept
        _row(PROVNUM="9", Hrs_RN="x", Hrs_CNA="2"),  # 9: text -> NULL
        _row(PROVNUM="5", MDScensus="0", Hrs_RN="3"),  # zero census -> ratios NULL
    ]
    p = write_csv(os.path.join(tmp_dir, "pbj", "a.csv"), HEADER, rows)
    daily = with_daily_metrics(_read_clean(spark, p))
    out = {r.provnum: r for r in daily.collect()}
    assert out["6"].rn_hprd is None and out["6"].total_direct_hprd == 1.0
    assert out["7"].contract_dependency_pct is None and out["7"].total_direct_hours == 0.0
    assert out["8"].hrs_natrn == -1.0
    assert out["9"].hrs_rn is None and out["9"].total_direct_hours == 2.0
    assert out["5"].rn_hprd is None and out["5"].total_direct_hprd is None
    neg = P.negative_hours(daily).first()
    assert neg.rows_with_negative_hours == 1


def test_swapped_header_fails_and_case_difference_passes(spark, tmp_dir):
    a = write_csv(os.path.join(tmp_dir, "swap", "a.csv"), ["PROVNUM", "STATE"], [["1", "TX"]])
    write_csv(os.path.join(tmp_dir, "swap", "b.csv"), ["STATE", "PROVNUM"], [["TX", "2"]])
    with pytest.raises(Exception):
        files.read_csv(spark, os.path.dirname(a)).collect()
    c = write_csv(os.path.join(tmp_dir, "case", "a.csv"), ["PROVNUM", "STATE"], [["1", "TX"]])
    write_csv(os.path.join(tmp_dir, "case", "b.csv"), ["provnum", "state"], [["2", "CA"]])
    got = files.read_csv(spark, os.path.dirname(c)).select("PROVNUM").collect()
    assert sorted(r[0] for r in got) == ["1", "2"]


def test_extra_columns_bind_by_name(spark, tmp_dir):
    header = ["A", "PROVNUM", "B", "STATE", "WorkDate", "Z", "MDScensus", "Hrs_RN"]
    p = write_csv(os.path.join(tmp_dir, "x", "a.csv"), header,
                  [["a", "015009", "b", "TX", "20240401", "z", "4", "8"]])
    r = _read_clean(spark, p).first()
    assert (r.provnum, r.state, r.mdscensus, r.hrs_rn) == ("015009", "TX", 4.0, 8.0)


def test_quoted_multiline_field(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q", "a.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as fh:
        fh.write('PROVNUM,PROVNAME,WorkDate,MDScensus\n')
        fh.write('1,"Line one\nline ""two""",20240401,3\n')
    rows = _read_clean(spark, p).collect()
    assert len(rows) == 1 and rows[0].provname == 'Line one\nline "two"'


def test_source_file_column(spark, tmp_dir):
    p = write_csv(os.path.join(tmp_dir, "s", "a.csv"), HEADER, [_row(), _row(PROVNUM="2")])
    counts = P.rows_per_source_file(_read_clean(spark, p)).collect()
    assert len(counts) == 1 and counts[0].rows == 2 and counts[0].source_file.endswith("a.csv")


def test_provider_dedup_is_deterministic(spark, tmp_dir):
    header = [h for h, _, _ in S.PROVIDER_COLUMNS]
    base = {h: None for h in header}
    r1 = dict(base, **{"CMS Certification Number (CCN)": " 015009", "Provider Name": "B",
                       "Overall Rating": "4"})
    r2 = dict(base, **{"CMS Certification Number (CCN)": "015009", "Provider Name": "A",
                       "Overall Rating": "x"})
    r3 = dict(base, **{"CMS Certification Number (CCN)": "  ", "Provider Name": "blank"})
    p = write_csv(os.path.join(tmp_dir, "prov", "a.csv"), header,
                  [[r[h] for h in header] for r in (r1, r2, r3)])
    out = C.clean_provider(files.read_csv(spark, p, with_source=False)).collect()
    assert len(out) == 1
    assert out[0].provider_id == "015009" and out[0].provider_name == "A"
    assert out[0].overall_rating is None


def test_claims_measure_code_parsing(spark, tmp_dir):
    header = [h for h, _, _ in S.CLAIMS_COLUMNS]
    rows = []
    for code, score in [("521", "1"), ("521.0", "2"), ("x", "3")]:
        r = {h: None for h in header}
        r.update({"CMS Certification Number (CCN)": "1", "Measure Code": code,
                  "Adjusted Score": score, "Processing Date": "2024-10-01"})
        rows.append([r[h] for h in header])
    p = write_csv(os.path.join(tmp_dir, "claims", "a.csv"), header, rows)
    cl = C.clean_claims(files.read_csv(spark, p, with_source=False))
    got = sorted((r.measure_code, r.adjusted_score) for r in cl.collect())
    assert got == [(521, 1.0), (521, 2.0)]
    assert cl.first().processing_date.isoformat() == "2024-10-01"
    dups = P.duplicate_claim_keys(cl).collect()
    assert [(d.provider_id, d.measure_code, d["count"]) for d in dups] == [("1", 521, 2)]


def test_first_per_key_matches_window(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "e"), (2, 5, "d")], "k int, o int, v string"
    )
    got = sorted(tuple(r) for r in C.first_per_key(df, ["k"], ["o", "v"]).collect())
    assert got == [(1, 1, "a"), (2, 5, "d")]


def test_drop_empty_rows_ignores_provenance(spark):
    df = spark.createDataFrame([(None, None, "f.csv"), ("1", None, "f.csv")],
                               "a string, b string, source_file string")
    assert C.drop_empty_rows(df, ignore=["source_file"]).count() == 1
    assert F is not None


def test_files_with_different_layouts_union_by_name(spark, tmp_dir):
    a = write_csv(os.path.join(tmp_dir, "l", "a.csv"), ["PROVNUM", "STATE", "WorkDate", "MDScensus"],
                  [["1", "TX", "20240401", "2"]])
    b = write_csv(os.path.join(tmp_dir, "l", "b.csv"), ["WorkDate", "PROVNUM", "MDScensus", "Hrs_RN"],
                  [["20240402", "2", "3", "6"]])
    got = {r.provnum: r for r in C.clean_staffing(files.read_csv_each(spark, [a, b])).collect()}
    assert got["1"].state == "TX" and got["1"].hrs_rn is None
    assert got["2"].state is None and got["2"].hrs_rn == 6.0 and got["2"].mdscensus == 3.0


def test_single_line_mode_reads_the_same_rows(spark, tmp_dir):
    p = write_csv(os.path.join(tmp_dir, "sl", "a.csv"), HEADER, [_row(), _row(PROVNUM="2")])
    a = sorted(r.provnum for r in C.clean_staffing(files.read_csv(spark, p)).collect())
    b = sorted(r.provnum for r in C.clean_staffing(files.read_csv(spark, p, multiline=False)).collect())
    assert a == b == ["100", "2"]


def test_malformed_line_does_not_fail_the_job(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad", "a.csv")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as fh:
        fh.write("PROVNUM,WorkDate,MDScensus\n1,20240401,3\n2,20240401\n3,20240401,4,extra\n")
    got = sorted(r.provnum for r in _read_clean(spark, p).collect())
    assert got == ["1", "3"]  # short line: NULL census -> dropped; long line: extra field ignored
