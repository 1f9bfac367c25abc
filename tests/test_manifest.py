"""Incremental manifest: classification, upsert, summary, versioned state."""

import pytest
from pyspark.sql import functions as F

from rosterline import schemas as S
from rosterline.streaming import manifest as MF

LISTING_SCHEMA = ("file_id string, name string, mime_type string, modified_time string, "
                  "source string, parent string, trashed boolean")


def _listing(spark):
    rows = [
        ("new", "a.csv", "text/csv", "t1", "pbj", "f", False),
        ("newer", "b.csv", "text/csv", "t2", "pbj", "f", False),
        ("older", "c.csv", "text/csv", "t0", "pbj", "f", False),
        ("same", "d.csv", "text/csv", "t1", "pbj", "f", False),
        ("folder", "dir", S.FOLDER_MIME, "t1", "pbj", "f", False),
        ("native", "doc", S.NATIVE_DOC_PREFIX + "document", "t1", "support", "f", False),
        ("failed_before", "e.csv", "text/csv", "t1", "support", "f", False),
        ("trashed", "g.csv", "text/csv", "t1", "support", "f", True),
        ("elsewhere", "h.csv", "text/csv", "t1", "support", "other", False),
    ]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def _manifest(spark):
    rows = [
        ("newer", "b.csv", "t1", "pbj", "pbj/b.csv"),
        ("older", "c.csv", "t1", "pbj", "pbj/c.csv"),
        ("same", "d.csv", "t1", "pbj", "pbj/d.csv"),
    ]
    return spark.createDataFrame(rows, S.MANIFEST_SCHEMA)


def test_classification(spark):
    c = MF.classify(MF.in_folder(_listing(spark), "f"), _manifest(spark))
    got = {r.file_id: (r.status, r.copy) for r in c.collect()}
    assert got == {
        "new": ("NEW", True), "newer": ("MODIFIED", True), "older": ("MODIFIED", True),
        "same": ("SKIPPED", False), "native": ("NEW", False), "failed_before": ("NEW", True),
    }


def test_results_summary_and_upsert(spark):
    c = MF.classify(MF.in_folder(_listing(spark), "f"), _manifest(spark))
    outcomes = spark.createDataFrame(
        [("new", True), ("newer", True), ("older", True), ("failed_before", False)],
        "file_id string, ok boolean",
    )
    fin = MF.results(c, outcomes)
    summ = {r.source: (r.new, r.modified, r.skipped, r.failed) for r in MF.summary(fin).collect()}
    assert summ == {"pbj": (1, 2, 1, 0), "support": (0, 0, 1, 1), "TOTAL": (1, 2, 2, 1)}
    with pytest.raises(MF.IngestionError):
        MF.check_no_failures(MF.summary(fin))
    nxt = MF.next_manifest(_manifest(spark), fin)
    ids = {r.file_id: r.modified_time for r in nxt.collect()}
    assert ids == {"new": "t1", "newer": "t2", "older": "t0", "same": "t1"}
    # applying the same listing again: everything copied before is SKIPPED
    again = MF.classify(MF.in_folder(_listing(spark), "f"), nxt)
    st = {r.file_id: r.status for r in again.collect()}
    assert st["new"] == st["newer"] == st["older"] == st["same"] == "SKIPPED"
    assert st["failed_before"] == "NEW" and st["native"] == "NEW"


def test_versioned_state_roundtrip(spark, tmp_dir):
    base = f"{tmp_dir}/manifest"
    assert MF.read_manifest(spark, base).count() == 0
    assert MF.write_manifest(_manifest(spark), base) == 0
    assert MF.write_manifest(_manifest(spark).limit(1), base) == 1
    assert MF.read_manifest(spark, base).count() == 1


def test_key_collisions(spark):
    listing = spark.createDataFrame(
        [("1", "same.csv", "text/csv", "t", "pbj", "f", False),
         ("2", "same.csv", "text/csv", "t", "pbj", "f", False)], LISTING_SCHEMA)
    c = MF.classify(listing, MF.empty_manifest(spark))
    assert [r.target_key for r in MF.key_collisions(c).collect()] == ["pbj/same.csv"]


def test_run_ingestion_checkpoints_per_source(spark, tmp_dir):
    base = f"{tmp_dir}/state"
    listing = _listing(spark)

    def copy_all(files):
        return files.select("file_id", (files.file_id != "failed_before").alias("ok"))

    with pytest.raises(MF.IngestionError):
        MF.run_ingestion(spark, listing, base, ["pbj", "support"], copy_all, folder="f")
    # one manifest version per source; failed and native files are not recorded
    assert MF._versions(spark, base) == [0, 1]
    ids = {r.file_id for r in MF.read_manifest(spark, base).collect()}
    assert ids == {"new", "newer", "older", "same"}

    def copy_ok(files):
        return files.select("file_id", F.lit(True).alias("ok"))

    summ = MF.run_ingestion(spark, listing, base, ["pbj", "support"], copy_ok, folder="f")
    total = {r.source: (r.new, r.modified, r.skipped, r.failed) for r in summ.collect()}["TOTAL"]
    assert total == (1, 0, 5, 0)  # pbj all SKIPPED now; support: native skipped, retry NEW


def test_lake_folder_listing_detects_new_and_modified(spark, tmp_dir):
    import os
    import time

    folder = os.path.join(tmp_dir, "landing")
    os.makedirs(folder)
    for n in ("a.csv", "b.csv"):
        with open(os.path.join(folder, n), "w") as fh:
            fh.write("PROVNUM\n1\n")
    first = MF.listing_from_folder(spark, folder, "pbj", "*.csv")
    c1 = MF.classify(first, MF.empty_manifest(spark))
    assert {r.status for r in c1.collect()} == {"NEW"}
    fin = MF.results(c1, c1.select("file_id", F.lit(True).alias("ok")))
    state = MF.next_manifest(MF.empty_manifest(spark), fin)
    time.sleep(1.1)
    with open(os.path.join(folder, "b.csv"), "w") as fh:  # rewritten in place
        fh.write("PROVNUM\n2\n")
    second = MF.listing_from_folder(spark, folder, "pbj", "*.csv")
    got = {r.name: r.status for r in MF.classify(second, state).collect()}
    assert got == {"a.csv": "SKIPPED", "b.csv": "MODIFIED"}


def test_nested_files_are_not_in_the_folder(spark, tmp_dir):
    import os

    folder = os.path.join(tmp_dir, "landing")
    for sub in ("q1", "q2"):
        os.makedirs(os.path.join(folder, sub))
        with open(os.path.join(folder, sub, "data.csv"), "w") as fh:
            fh.write("PROVNUM\n1\n")
    with open(os.path.join(folder, "top.csv"), "w") as fh:
        fh.write("PROVNUM\n1\n")
    listing = MF.listing_from_folder(spark, folder, "pbj", "*.csv")
    parents = {r.name: r.parent for r in listing.collect()}
    top = parents["top.csv"]
    assert top.endswith("/landing") and parents["data.csv"].rsplit("/", 1)[0] == top
    assert [r.name for r in MF.in_folder(listing, top).collect()] == ["top.csv"]
    # without the folder test both nested files take one key: nothing is copied
    with pytest.raises(MF.KeyCollisionError, match="pbj/data.csv"):
        MF.run_ingestion(spark, listing, f"{tmp_dir}/state", ["pbj"], lambda files: pytest.fail("copied"))


def test_only_the_latest_version_is_read_and_few_are_kept(spark, tmp_dir):
    base = f"{tmp_dir}/manifest"
    for _ in range(MF.KEPT_VERSIONS + 2):
        MF.write_manifest(_manifest(spark), base)
    versions = MF._versions(spark, base)
    assert len(versions) == MF.KEPT_VERSIONS and versions[-1] == MF.KEPT_VERSIONS + 1
    files = MF.read_manifest(spark, base).inputFiles()
    assert files and all(f"manifest_version={versions[-1]}/" in f for f in files)


def test_broken_state_is_not_a_first_run(spark, tmp_dir):
    import os

    base = f"{tmp_dir}/manifest"
    MF.write_manifest(_manifest(spark), base)
    for f in os.listdir(f"{base}/manifest_version=0"):
        if f.endswith(".parquet"):
            with open(f"{base}/manifest_version=0/{f}", "w") as fh:
                fh.write("not parquet")
    with pytest.raises(Exception):
        MF.read_manifest(spark, base).collect()


def test_ingestion_needs_a_source(spark, tmp_dir):
    with pytest.raises(ValueError):
        MF.run_ingestion(spark, _listing(spark), f"{tmp_dir}/state", [], lambda f: f)


def _rows(spark, names, time):
    return spark.createDataFrame([(n, f"{n}.csv", time, "pbj", f"pbj/{n}.csv") for n in names], S.MANIFEST_SCHEMA)


def _times(spark, base):
    return {r.file_id: r.modified_time for r in MF.read_manifest(spark, base).collect()}


def test_a_run_writes_the_changed_rows_only(spark, tmp_dir):
    base = f"{tmp_dir}/log"
    MF.write_manifest(_rows(spark, [f"f{i}" for i in range(500)], "t0"), base)
    for k in range(3):
        number = MF.append_changes(_rows(spark, [f"f{k}", f"new{k}", "often"], f"t{k + 1}"), base)
        written = spark.read.parquet(MF._version_path(base, number, MF.DELTA))
        assert written.count() == 3
    got = _times(spark, base)
    assert len(got) == 504 and got["often"] == "t3" and got["f1"] == "t2" and got["f9"] == "t0"
    assert MF._states(spark, base) == {0: MF.VERSION, 1: MF.DELTA, 2: MF.DELTA, 3: MF.DELTA}


def test_compaction_keeps_the_manifest(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/log"
    monkeypatch.setattr(MF, "COMPACT_ROWS", 0)
    want = {}
    for k in range(12):
        names = [f"f{k % 4}", f"g{k}"]
        MF.append_changes(_rows(spark, names, f"t{k}"), base)
        want |= dict.fromkeys(names, f"t{k}")
        assert _times(spark, base) == want
    states = MF._states(spark, base)
    snapshots = [n for n, kind in states.items() if kind == MF.VERSION]
    assert 1 <= len(snapshots) <= MF.KEPT_VERSIONS and min(states) <= min(snapshots)


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_dir):
    """A delta and a snapshot without their commit marker are not read, and their numbers are used again."""
    import os

    base = f"{tmp_dir}/log"
    MF.append_changes(_rows(spark, ["a", "b"], "t0"), base)
    number = MF.append_changes(_rows(spark, ["a"], "lost"), base)
    os.remove(os.path.join(MF._version_path(base, number, MF.DELTA), "_SUCCESS"))
    assert _times(spark, base) == {"a": "t0", "b": "t0"}
    version = MF.write_manifest(_rows(spark, ["c"], "lost"), base)
    os.remove(os.path.join(MF._version_path(base, version), "_SUCCESS"))
    assert _times(spark, base) == {"a": "t0", "b": "t0"}
    assert MF.append_changes(_rows(spark, ["b"], "t1"), base) == number
    assert _times(spark, base) == {"a": "t0", "b": "t1"}
