"""CSV columns go by header name, in batch and stream; missing values and number forms."""

import datetime as dt
import os

import pytest

from domainpulse.operators.cluster import cluster_features
from domainpulse.sources.files import MISSING, headers, read_domains_csv, read_metrics_csv
from domainpulse.streaming.incremental import incremental_ingest

NAMES = ["domain_id", "snapshot_date", "total_records", "null_rate", "stale_rate", "update_lag_hrs", "missing_fields"]
ROW = {"domain_id": "D1", "snapshot_date": "2024-01-02", "total_records": "10", "null_rate": "0.1", "stale_rate": "0.2",
       "update_lag_hrs": "3.5", "missing_fields": "4", "extra": "x", "created_at": "2024-01-02 03:04:05"}
WANT = ("D1", dt.date(2024, 1, 2), 10, 0.1, 0.2, 3.5, 4)


def write(folder, name, columns, **changes):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(",".join(columns) + "\n" + ",".join((ROW | changes)[c] for c in columns) + "\n")
    return path


@pytest.mark.parametrize("columns", [
    NAMES, NAMES[::-1], [*NAMES[:4], "extra", *NAMES[4:]], ["created_at", *NAMES[3:], *NAMES[:3]]])
def test_order_and_extra_columns(spark, scratch, columns):
    path = write(f"{scratch}/in", "m.csv", columns)
    assert tuple(read_metrics_csv(spark, path).first())[:7] == WANT
    incremental_ingest(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/ckpt")
    row = spark.read.parquet(f"{scratch}/store").select(*NAMES).first()
    assert tuple(row) == WANT


@pytest.mark.parametrize("gone", NAMES)
def test_a_missing_column_raises(spark, scratch, gone):
    path = write(f"{scratch}/in", "m.csv", [c for c in NAMES if c != gone])
    with pytest.raises(ValueError, match=gone):
        read_metrics_csv(spark, path)
    with pytest.raises(ValueError, match=gone):
        incremental_ingest(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/ckpt")


def test_files_of_different_headers_load_by_name(spark, scratch):
    """Three orders of columns, with and without the optional ones, in one delivery: batch and stream agree."""
    write(f"{scratch}/in", "a.csv", NAMES, domain_id="A")
    write(f"{scratch}/in", "b.csv", [*NAMES[:3], "stale_rate", "null_rate", *NAMES[5:], "created_at"], domain_id="B")
    write(f"{scratch}/in", "c 1.csv", ["extra", *NAMES[::-1]], domain_id="C")
    write(f"{scratch}/in", "d.csv", NAMES, domain_id="D")
    batch = sorted(tuple(r)[:7] for r in read_metrics_csv(spark, f"{scratch}/in").collect())
    assert batch == [(d, *WANT[1:]) for d in "ABCD"]
    incremental_ingest(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/ckpt")
    stream = spark.read.parquet(f"{scratch}/store")
    assert sorted(tuple(r) for r in stream.select(*NAMES).collect()) == batch
    assert {r.domain_id for r in stream.where("created_at is not null").collect()} == {"B"}


def test_files_of_one_header_are_one_scan(spark, scratch):
    for i in range(6):
        write(f"{scratch}/in", f"m [{i}].csv", NAMES if i % 3 else NAMES[::-1], domain_id=f"D{i}")
    assert [len(files) for _, files in headers(spark, f"{scratch}/in")] == [2, 4]
    assert read_metrics_csv(spark, f"{scratch}/in").count() == 6
    plan = read_metrics_csv(spark, f"{scratch}/in")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_the_file_that_lacks_a_column_is_named(spark, scratch):
    write(f"{scratch}/in", "good.csv", NAMES)
    write(f"{scratch}/in", "short.csv", [c for c in NAMES if c != "stale_rate"])
    with pytest.raises(ValueError, match="(?s)short.csv.*stale_rate"):
        read_metrics_csv(spark, f"{scratch}/in")
    with pytest.raises(ValueError, match="(?s)stale_rate.*short.csv"):
        incremental_ingest(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/ckpt")


def test_quoted_cells_and_line_ends_in_the_stream(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/m.csv", "wb") as f:
        f.write(("\ufeff" + ",".join(NAMES) + "\r\n" + '"D,1",2024-01-02,10,0.1,0.2,"3.5",4\r\n\r\n').encode())
    incremental_ingest(spark, f"{scratch}/in", f"{scratch}/store", f"{scratch}/ckpt")
    rows = [tuple(r) for r in spark.read.parquet(f"{scratch}/store").select(*NAMES).collect()]
    assert rows == [("D,1", *WANT[1:])] == [tuple(r)[:7] for r in read_metrics_csv(spark, f"{scratch}/in").collect()]


@pytest.mark.parametrize("marker", [m for m in MISSING if m])
def test_missing_markers(spark, scratch, marker):
    path = write(scratch, "m.csv", NAMES, null_rate=marker, missing_fields=marker, domain_id=marker)
    r = read_metrics_csv(spark, path).first()
    assert (r["null_rate"], r["missing_fields"], r["domain_id"], r["total_records"]) == (None, None, None, 10)


def test_whole_numbers_written_with_a_point(spark, scratch):
    path = write(scratch, "m.csv", NAMES, total_records="3.0", missing_fields="3.5")
    r = read_metrics_csv(spark, path).first()
    assert (r["total_records"], r["missing_fields"]) == (3, None)


def test_domains_by_name(spark, scratch):
    path = os.path.join(scratch, "d.csv")
    with open(path, "w") as f:
        f.write("data_source,owner_team,note,domain_id,domain_name\ns,t,x,D1,n\n")
    assert tuple(read_domains_csv(spark, path).first()) == ("D1", "n", "t", "s")


def test_domain_without_id_keeps_its_cluster_row(spark):
    cols = ["null_rate", "stale_rate", "update_lag_hrs", "missing_fields"]
    from domainpulse.config import FEATURES
    raw = spark.createDataFrame([("a", *map(float, range(4))), (None, *[9.0] * 4)], ["domain_id", *FEATURES])
    scaled = spark.createDataFrame([("a", *[0.0] * 4), (None, *[1.0] * 4)], ["domain_id", *[f"{c}_scaled" for c in FEATURES]])
    out = cluster_features(raw, scaled, [[0.0] * 4, [1.0] * 4])
    assert out.count() == 2 and out.where("domain_id is null").count() == 1 and len(cols) == len(FEATURES)


def test_labels_come_by_projection_and_keep_the_domain_without_id(spark):
    from domainpulse.config import FEATURES
    from domainpulse.operators.cluster import label_features

    rows = [(None, 1.0, 2.0, 3.0, 4.0), ("D1", 5.0, 6.0, 7.0, 8.0)]
    raw = spark.createDataFrame(rows, "domain_id string, " + ", ".join(f"{c} double" for c in FEATURES))
    out = label_features(raw, [[-1.0] * 4, [1.0] * 4])
    assert {(r.domain_id, r.cluster_label) for r in out.collect()} == {(None, 0), ("D1", 1)}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_row_of_the_stream_carries_its_line_and_not_its_file(spark):
    """A file's lines become rows without a copy of the whole file in each, so memory grows with the file, not its square."""
    from domainpulse.streaming.incremental import by_own_header

    n = 20_000
    named, turned = ",".join(NAMES), ",".join(["extra", *NAMES[::-1]])
    files = [("a", named + "\n" + "".join(f"D{i},2024-01-02,10,0.1,0.2,3.5,4\n" for i in range(n))),
             ("b", f"﻿{turned}\r\nx,4,3.5,0.2,0.1,10,2024-01-02,E1\r\n \r\nx,4\r\n"), ("c", ""), ("d", "not,a,header\n")]
    rows = by_own_header(spark.createDataFrame(files, "file string, value string"))
    node, exploded = rows._jdf.queryExecution().optimizedPlan(), 0
    while node.children().size():
        if node.nodeName() == "Generate":
            exploded += 1
            carried = node.requiredChildOutput()
            assert "array" not in [carried.apply(i).dataType().typeName() for i in range(carried.size())]
        node = node.children().apply(0)
    assert exploded == 1
    got = {tuple(r)[:7] for r in rows.collect()}
    assert got == {(f"D{i}", "2024-01-02", "10", "0.1", "0.2", "3.5", "4") for i in range(n)} | {
        ("E1", "2024-01-02", "10", "0.1", "0.2", "3.5", "4"), (None,) * 5 + (None, "4")}
