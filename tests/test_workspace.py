import csv
import datetime as dt
import glob
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlens import Workspace


@pytest.fixture(scope="module")
def workspace(sample):
    return Workspace.from_dataframe(sample.drop("is_flagged_fraud")).run()


def test_needs_run(sample):
    w = Workspace.from_dataframe(sample)
    with pytest.raises(RuntimeError, match="run"):
        w.segment
    with pytest.raises(ValueError, match="engine"):
        w.run("other")


def test_results_and_views(workspace):
    assert workspace.metrics.first()["fraud_rate_pct"] > 0
    assert workspace.segment.champions.columns == workspace.segment.rfm().columns
    assert workspace.merchants.top_by_volume(5).count() == 5
    assert workspace.cohorts.best_cohort().isEmpty()                 # one month of data
    assert workspace.forecast.quality().first()["confidence"] == "low"
    assert workspace.forecast.revenue(20).count() == 12
    assert workspace.forecast.summary().first()["next_month_revenue"] > 0
    assert workspace.profile().filter("field = 'amount'").first()["non_null"] == 480
    assert set(workspace.dashboard()) == {"metrics", "monthly", "rfm", "merchants", "cohort", "trend", "counts"}
    assert workspace.benchmark("nowhere").count() == 2
    got = workspace.query("SELECT count(*) AS n FROM transactions t JOIN rfm USING (customer_id)").first()
    assert got["n"] == 480


def test_warehouse_engine_agrees(sample, workspace):
    plain = sample.withColumn("currency", F.lit("GBP")).drop("is_flagged_fraud")
    native = Workspace.from_dataframe(plain).run()
    derived = Workspace.from_dataframe(plain).run("warehouse", as_of=F.lit("2023-02-01").cast("date"))
    for name in ("recency_days", "frequency", "r_score", "f_score", "m_score", "segment"):
        pick = lambda w: {r["customer_id"]: r[name] for r in w.results["rfm"].collect()}  # noqa: E731, B023
        assert pick(native) == pick(derived), name
    volume = lambda w: w.results["payment_performance"].agg(F.round(F.sum("total_volume"), 2)).first()[0]
    assert volume(native) == volume(derived)


def test_fraud_explanations(workspace):
    with pytest.raises(RuntimeError, match="detect"):
        workspace.fraud.explain()
    workspace.fraud.detect("unsupervised")
    one = workspace.fraud.explain("t7").first()
    assert one["detection_mode"] == "unsupervised" and one["reasons"]
    with pytest.raises(ValueError, match="not found"):
        workspace.fraud.explain("missing")
    assert workspace.fraud.summary().first()["total_transactions"] == 480


def test_drift_against_another(workspace):
    psi, report = workspace.fraud.drift(workspace)
    assert psi.count() == 8 and report.first()["status"] == "stable"


def test_export(workspace, tmp_path):
    names = workspace.export(str(tmp_path))
    assert names == ["metrics.json", "rfm_segments.csv", "cohort_retention.csv", "merchant_scorecard.csv", "payment_performance.csv"]
    rows = [r for p in glob.glob(f"{tmp_path}/rfm_segments.csv/part-*") for r in csv.DictReader(open(p))]
    assert len(rows) == 37 and "segment" in rows[0]
    lines = [json.loads(x) for p in glob.glob(f"{tmp_path}/metrics.json/part-*") for x in open(p)]
    assert lines[0]["total_transactions"] == 480


def test_csv_with_other_names(spark, tmp_path):
    path = f"{tmp_path}/in.csv"
    with open(path, "w") as f:
        f.write("record_id,member_id,debit,occurred_at,outcome,payee\n")
        for i in range(40):
            at = dt.datetime(2023, 6, 1) + dt.timedelta(hours=2 * i)
            f.write(f"ref_{i},c{i % 5},{10 + i}.50,{at},{'success' if i % 4 else 'failed'},Shop {i % 3}\n")
    w = Workspace.from_csv(spark, path).run()
    assert w.metrics.first()["completion_pct"] == 75.0
    assert w.segment.rfm().count() == 5
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        Workspace.from_csv(spark, f"{tmp_path}/none.csv")


def test_release_deletes_staged_tables(spark):
    from ledgerlens import storage

    staged = storage.stage(spark.range(3), "probe")
    path = storage._staged[-1]
    assert staged.count() == 3 and storage.table_exists(spark, path)
    keep = storage._staged[:-1]
    storage._staged[:] = [path]
    assert storage.release(spark) == 1 and not storage.table_exists(spark, path)
    storage._staged[:] = keep
