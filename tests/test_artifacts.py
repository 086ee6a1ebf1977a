"""Artifact readers (S4-S9) on small literal fixtures written to a scratch dir."""

import json
import os
import tempfile

from ferrule.sources import artifacts

# Invented values in the layout of a fixed-width report and of an iteration trace.
REPORT = """[run] toy | scores per fold
fold_1 | classification report (outer test):
              precision    recall  f1-score   support

         0.0      0.250     0.500     0.333         4
         1.0      0.500     0.250     0.333         8
         2.0      1.000     0.750     0.857        16

    accuracy                          0.625        28
   macro avg      0.583     0.500     0.508        28
weighted avg      0.750     0.571     0.633        28

fold_2 | classification report (outer test):
              precision    recall  f1-score   support

         0.0      0.800     0.800     0.800        10
         1.0      0.700     0.700     0.700         6

    accuracy                          0.875        16
   macro avg      0.750     0.750     0.750        16
weighted avg      0.762     0.762     0.762        16
"""

TRACE = "iter\tBalancedAccuracy\tLogloss\n0\t0.25\t0.9\n1\t0.25\t0.8\n" \
        "2\t0.75\t0.6\t0.75\n3\t0.5\t0.7\n"


def _scratch():
    return tempfile.mkdtemp(prefix="ferrule-test-")


def test_parse_reports_and_fold_average(spark):
    d = _scratch()
    with open(os.path.join(d, "r.txt"), "w") as f:
        f.write(REPORT)
    rep = artifacts.parse_reports(spark, d)
    rows = {(r["fold"], r["row"]): r for r in rep.collect()}
    assert len(rows) == 11
    assert rows[(1, "macro avg")]["f1"] == 0.508
    assert rows[(1, "accuracy")]["support"] == 28.0
    assert rows[(2, "1.0")]["recall"] == 0.7
    from ferrule.operators.metrics import fold_average_report
    avg = {r["row"]: r for r in fold_average_report(rep, ["row"]).collect()}
    assert abs(avg["accuracy"]["f1_mean"] - 0.75) < 1e-9
    assert abs(avg["accuracy"]["f1_std"] - 0.125) < 1e-9


def test_trace_permissive_and_best_iteration(spark):
    d = _scratch()
    with open(os.path.join(d, "t.tsv"), "w") as f:
        f.write(TRACE)
    tr = artifacts.read_trace(spark, d, ("BalancedAccuracy", "Logloss"))
    r = artifacts.best_iteration(tr, "BalancedAccuracy", maximize=True).first()
    assert r["n_rejected"] == 1
    assert r["best_iter"] == 3 and abs(r["best_value"] - 0.5) < 1e-12
    r = artifacts.best_iteration(tr, "Logloss", maximize=False).first()
    assert r["best_iter"] == 3


def test_trials_leaderboard(spark):
    d = _scratch()
    docs = [{"trial_id": "0", "status": "COMPLETED", "score": 0.80, "best_step": 4,
             "hyperparameters": {"space": [], "values": {"n_layers": 3, "lr": 0.001}}},
            {"trial_id": "1", "status": "FAILED", "score": None, "best_step": 0,
             "hyperparameters": {"space": [], "values": {"n_layers": 5, "lr": 0.01}}},
            {"trial_id": "2", "status": "COMPLETED", "score": 0.9, "best_step": 9,
             "hyperparameters": {"space": [], "values": {"n_layers": 4, "lr": 0.0005}}}]
    for i, doc in enumerate(docs):
        with open(os.path.join(d, f"trial_{i}.json"), "w") as f:
            json.dump(doc, f)
    lb = artifacts.trial_leaderboard(artifacts.read_trials(spark, d)).orderBy("rank").collect()
    assert [r["trial_id"] for r in lb] == ["2", "0"]
    assert lb[0]["values"]["n_layers"] == "4"


def test_candidates_roundtrip_and_leaderboard(spark):
    d = _scratch()
    header = ("mean_fit_time,std_fit_time,mean_score_time,std_score_time,param_degree,params,"
              "split0_test_score,split1_test_score,split2_test_score,mean_test_score,std_test_score,rank_test_score")
    rows = ['0.39,0.02,0.002,0.0005,4,"OrderedDict({\'degree\': 4})",0.5,0.6,0.7,0.6,0.0816,1',
            '0.29,0.01,0.001,0.0004,8,"OrderedDict({\'degree\': 8})",-1.0,-2.0,-2.5,-1.8333,0.6236,2']
    src = os.path.join(d, "in.csv")
    with open(src, "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    df = artifacts.read_candidates(spark, src, artifacts.candidate_schema(3, ("degree",)))
    assert df.count() == 2 and df.first()["params"].startswith("OrderedDict")
    from ferrule.operators.metrics import candidate_leaderboard
    lb = {r["param_degree"]: r for r in candidate_leaderboard(
        df, [f"split{i}_test_score" for i in range(3)], ["param_degree"]).collect()}
    assert lb["4"]["rank_test_score"] == 1 and abs(lb["4"]["std_test_score"] - 0.0816497) < 1e-6
    out = os.path.join(d, "out")
    artifacts.write_candidates(df, out, sep=";")
    back = spark.read.option("header", True).option("sep", ";").csv(out)
    assert back.count() == 2


def test_sectioned_reports(spark, tmp_path):
    """A file of many sections is cut anywhere and read by several tasks, each section once; the
    commit leaves only whole files; appending adds files."""
    from ferrule.sources import reports
    rows = [(f, r, 0.125 * (f % 8), 0.5, 0.25, float(f)) for f in range(60) for r in ("0", "1", "macro avg")] + [(f, "accuracy", 0.75, 0.75, 0.75, 9.0) for f in range(60)]
    df = spark.createDataFrame(rows, "fold int, row string, precision double, recall double, f1 double, support double")
    uri = f"file://{tmp_path}/rep"
    reports.write_report(df, uri)
    want = sorted((f, r, float(f"{p:.3f}"), a, b, n) for f, r, p, a, b, n in rows)
    for split in (97, 1000, 1 << 20):
        got = reports.read_report(spark, uri, split)
        assert sorted(tuple(r)[1:] for r in got.collect()) == want
    assert reports.read_report(spark, uri, 1000).rdd.getNumPartitions() > 10
    assert all(p.name.startswith("report-") for p in (tmp_path / "rep").iterdir())
    reports.write_report(df.where("fold = 3"), uri)
    assert reports.read_report(spark, uri).count() == len(rows) + 4
    reports.write_report(df.limit(0), f"file://{tmp_path}/none")
    assert reports.read_report(spark, f"file://{tmp_path}/none").count() == 0


def test_failed_report_write_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F
    from ferrule.sources import reports
    bad = spark.range(50).select(F.col("id").cast("int").alias("fold"), F.lit("0").alias("row"), F.when(F.col("id") == 40, F.raise_error(F.lit("no"))).otherwise(F.lit(0.5)).cast("double").alias("precision"),
                                 F.lit(0.5).alias("recall"), F.lit(0.5).alias("f1"), F.lit(1.0).alias("support"))
    try:
        reports.write_report(bad, f"file://{tmp_path}/bad")
        raise AssertionError("written")
    except Exception as e:
        assert "written" not in str(e)
    assert not (tmp_path / "bad").exists() or not list((tmp_path / "bad").iterdir())
