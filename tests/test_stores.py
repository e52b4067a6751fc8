"""Order of arrival over several files, the stores' contract, scores kept per run, life of intermediates, the KPI anchor."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from domainpulse import schemas
from domainpulse.operators import quality
from domainpulse.operators.ingest import new_domains
from domainpulse.operators.trend import alerts_of_run, run_alerts
from domainpulse.plans import bridges, catalog
from domainpulse.plans.chain import run_chain, run_stored
from domainpulse.session import intermediates
from domainpulse.sources import files, sinks
from conftest import SF001
from helpers import domains, metrics


def test_first_file_wins_whatever_its_size(spark, tmp_path):
    head = "domain_id,domain_name,owner_team,data_source\n"
    (tmp_path / "a.csv").write_text(head + "D1,first,t,s\nD2,one,t,s\nD2,two,t,s\n")
    (tmp_path / "b.csv").write_text(head + "".join(f"X{i},name {i},t,s\n" for i in range(5000)) + "D1,second,t,s\n")
    got = new_domains(
        files.with_arrival(files.read_domains_csv(spark, str(tmp_path))),
        spark.createDataFrame([], "domain_id string"))
    names = {r.domain_id: r.domain_name for r in got.where("domain_id like 'D%'").collect()}
    assert names == {"D1": "first", "D2": "one"}


def test_scores_of_earlier_runs_stay(spark, tmp_path):
    path = str(tmp_path / "risk_scores")
    cols = ["domain_id", "run_date", "composite_score", "cluster_label", "risk_tier", "top_driver"]
    for day, tier in (("2024-01-01", "LOW"), ("2024-01-02", "LOW"), ("2024-01-02", "MEDIUM")):
        rows = spark.createDataFrame([("D1", day, 30.0, 1, tier, "null_rate"), (None, day, 10.0, 0, "LOW", "null_rate")], cols)
        sinks.append_runs(rows.withColumn("run_date", F.to_date("run_date")), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    alerts = [(r.domain_id, str(r.run_date), r.prev_tier, r.alert_reason) for r in run_alerts(stored).collect()]
    assert alerts == [("D1", "2024-01-02", "LOW", "tier_rose")]


def test_anchor_of_the_lineitem_rollup_joins_nothing(spark):
    plan = catalog.QUERIES["kpi_lineitem"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_anchor_is_the_last_day_of_line_items_that_have_an_order(spark, tmp_path):
    base = dt.date(2024, 3, 1)
    line = lambda order, day: (order, 1, dt.datetime.combine(base + dt.timedelta(days=day), dt.time()))
    rows = [line(1, 0), line(2, 5)] + [line(900 + d, d) for d in range(6, 400)]  # the newest 394 days have no order
    for name, frame in (("lineitem", spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_shipdate timestamp_ntz")),
                        ("orders", spark.createDataFrame([(1,), (2,)], "o_orderkey long")),
                        ("none/orders", spark.createDataFrame([(7,)], "o_orderkey long"))):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.read.parquet(str(tmp_path / "lineitem.parquet")).write.parquet(str(tmp_path / "none" / "lineitem.parquet"))
    assert bridges.lineitem_dates(spark, str(tmp_path)).first()[0] == base + dt.timedelta(days=5)
    assert bridges.lineitem_dates(spark, str(tmp_path / "none")).first()[0] is None


def write_store(spark, path, rows, drop=()):
    metrics(spark, rows).drop(*drop).write.mode("append").parquet(path)


def test_a_stored_column_that_no_file_holds_fails_the_run(spark, tmp_path):
    store = str(tmp_path)
    domains(spark, [("A", "a", "t", "s")]).write.parquet(f"{store}/domains")
    write_store(spark, f"{store}/coverage_metrics", [("A", 0, 0.1, 0.1, 1.0, 0)], drop=("null_rate",))
    found = sinks.read_as_found(spark, f"{store}/coverage_metrics", schemas.METRICS)
    assert "null_rate" not in found.columns
    issues = {r.stage: (r.status, r.notes) for r in quality.validation_report(
        sinks.read_as_found(spark, f"{store}/domains", schemas.DOMAINS), found).collect()}
    assert issues["validate.coverage_metrics.columns"][0] == "FAILED"
    assert "null_rate" in issues["validate.coverage_metrics.columns"][1]
    with pytest.raises(RuntimeError):
        run_stored(spark, store)
    audit = spark.read.parquet(f"{store}/audit_log")
    assert audit.where("status = 'FAILED' AND stage = 'validate.coverage_metrics.columns'").count() == 1
    # a column that only some files hold is there, with nulls that the null check reports
    write_store(spark, f"{store}/coverage_metrics", [("A", 1, 0.1, 0.1, 1.0, 0)])
    found = sinks.read_as_found(spark, f"{store}/coverage_metrics", schemas.METRICS)
    nulls = {r.stage: r.rows_affected for r in quality.check_nulls(found, "coverage_metrics").collect()}
    assert nulls == {"validate.coverage_metrics.nulls.null_rate": 1}
    assert sinks.read_as_found(spark, f"{store}/absent", schemas.METRICS).columns == schemas.METRICS.fieldNames()


def test_the_load_counts_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "m")
    first = metrics(spark, [(f"D{i}", i % 3, 0.1, 0.1, 1.0, 0) for i in range(50)])
    assert sinks.append_metrics(spark, first, path) == 50 == spark.read.parquet(path).count()
    again = metrics(spark, [(f"D{i}", i % 3, 0.1, 0.1, 1.0, 0) for i in range(40, 60)])
    assert sinks.append_metrics(spark, again, path) == 10
    assert spark.read.parquet(path).count() == 60


def test_stored_runs_are_compared_with_the_run_before(spark, tmp_path):
    store = str(tmp_path)
    domains(spark, [(f"D{i}", f"n{i}", "t", "s") for i in range(6)]).write.parquet(f"{store}/domains")
    calm = [(f"D{i}", 0, 0.01 * i, 0.02 * i, 1.0 + i, 0) for i in range(6)]
    sinks.append_metrics(spark, metrics(spark, calm), f"{store}/coverage_metrics")
    one = run_stored(spark, store, run_date="2024-01-01")
    assert one.alerts.where("prev_run is not null").count() == 0
    worse = [("D0", 6, 1.0, 1.0, 200.0, 50)] + [(f"D{i}", 6, 0.01 * i, 0.02 * i, 1.0 + i, 0) for i in range(1, 6)]
    sinks.append_metrics(spark, metrics(spark, worse), f"{store}/coverage_metrics")
    two = run_stored(spark, store, run_date="2024-01-08")
    kept = spark.read.parquet(f"{store}/risk_scores")
    assert kept.groupBy("run_date").count().count() == 2 and kept.count() == 12
    rose = {r.domain_id: r for r in two.alerts.where("alert_reason like '%tier_rose%'").collect()}
    assert "D0" in rose and str(rose["D0"].prev_run) == "2024-01-01" and rose["D0"].score_change > 0
    # the same alerts from the whole store, and a rerun replaces its own run only
    whole = run_alerts(kept).where("run_date = DATE'2024-01-08'")
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, two.alerts.select(*whole.columns).collect()))
    run_stored(spark, store, run_date="2024-01-08")
    assert spark.read.parquet(f"{store}/risk_scores").count() == 12
    assert spark.read.parquet(f"{store}/risk_alerts").select("run_date").distinct().count() <= 2


def test_only_the_previous_run_is_read(spark, tmp_path):
    path = str(tmp_path / "risk_scores")
    cols = ["domain_id", "run_date", "composite_score", "cluster_label", "risk_tier", "top_driver"]
    for day in range(1, 6):
        sinks.append_runs(spark.createDataFrame([("D1", f"2024-01-0{day}", 10.0 * day, 0, "LOW", "x")], cols).withColumn(
            "run_date", F.to_date("run_date")), path)
    stored = sinks.read_store(spark, path, schemas.RISK_SCORES)
    now = spark.createDataFrame([("D1", 90.0, 3, "CRITICAL", "x"), ("D9", 90.0, 3, "CRITICAL", "x")],
                                "domain_id string, composite_score double, cluster_label int, risk_tier string, top_driver string")
    now = now.withColumn("run_date", F.lit("2024-01-05").cast("date"))
    alerts = {r.domain_id: r for r in alerts_of_run(now, stored, "2024-01-05").collect()}
    assert str(alerts["D1"].prev_run) == "2024-01-04" and alerts["D1"].score_change == 50.0
    assert alerts["D9"].prev_tier is None and alerts["D9"].alert_reason == "high_tier"


def test_nothing_stays_after_a_scope(spark, tmp_path):
    rows = [(f"D{i}", d, 0.01 * i, 0.02 * i, 1.0 + i, i % 3) for i in range(8) for d in range(7)]
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with intermediates(spark) as made:
        result = run_chain(domains(spark, [(f"D{i}", "n", "t", "s") for i in range(8)]), metrics(spark, rows), run_date="2024-01-07")
        scores = result.scores.collect()
        folders = list(made)
        assert folders and all(exists(spark, p) for p in folders)
    assert len(scores) == 8 and not any(exists(spark, p) for p in folders)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def exists(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
