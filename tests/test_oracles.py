"""Every registered query against its DuckDB oracle on the driver tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
ONLY = os.environ.get("FERRULE_ONLY")


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, sf_dir, con):
    if ONLY and name not in ONLY.split(","):
        pytest.skip("filtered")
    problems = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert not problems, problems


CORE = sorted(n for n in set(QUERIES) - set(ORACLES) if not n.startswith("op") and n != "pipeline")  # those have tests of their own


def test_queries_without_oracle_are_known():
    assert CORE == ["ml_forest_importances", "ml_group_vote_gbt", "ml_model_comparison", "quality_mar_test"]


def test_group_vote_model(spark, sf_dir):
    """Every patient votes once, in its own held-out fold, and the vote is one of the labels."""
    from tests.oracle import duck
    rows = QUERIES["ml_group_vote_gbt"](spark, sf_dir).collect()
    patients = {r[0] for r in duck(sf_dir).execute("SELECT DISTINCT user_id FROM events").fetchall()}
    assert {r["patient_id"] for r in rows} == patients and len(rows) == len(patients) and {r["vote"] for r in rows} <= {0, 1}
    assert {r["fold"] for r in rows} == set(range(5)) and all(r["label"] == r["patient_id"] % 2 for r in rows)


def test_model_comparison(spark, sf_dir):
    """Three learners, each scoring every recording once, out of fold; the label is the parity of the
    patient, so none can be much better or worse than chance."""
    rows = {r["model"]: r for r in QUERIES["ml_model_comparison"](spark, sf_dir).collect()}
    assert set(rows) == {"random_forest", "mlp", "linear_svc"} and len({r["n_rows"] for r in rows.values()}) == 1
    assert all(0.3 < r["accuracy"] < 0.7 for r in rows.values())


def test_forest_importances(spark, sf_dir):
    rows = QUERIES["ml_forest_importances"](spark, sf_dir).collect()
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True) and abs(sum(r["importance"] for r in rows) - 1) < 1e-9
    assert {r["feature"] for r in rows} == {"path_length", "amp_x", "amp_y"}


def test_mar_test(spark, sf_dir):
    """Only l_discount has holes (by order key, at random): its AUC is near one half, the
    other columns have no AUC in any fold."""
    rows = {(r["column"], r["set"]): r for r in QUERIES["quality_mar_test"](spark, sf_dir).collect()}
    assert len(rows) == 6 and all(r["n_folds"] == 2 for r in rows.values())
    assert all(abs(rows[("l_discount", s)]["auc_mean"] - 0.5) < 0.05 and rows[("l_discount", s)]["n_undefined"] == 0 for s in ("train", "test"))
    assert all(r["n_undefined"] == 2 and r["auc_mean"] is None for (c, _), r in rows.items() if c != "l_discount")


def test_correlated_groups(spark, sf_dir, con):
    """The greedy grouping done on numpy correlations."""
    import numpy as np
    x = con.execute("SELECT l_quantity, l_discount, l_tax FROM lineitem").fetchnumpy()
    q, dsc, t = (np.asarray(x[c], float) for c in ("l_quantity", "l_discount", "l_tax"))
    cols = {"l_quantity": q, "l_discount": dsc, "l_tax": t, "l_quantity_2": q * q, "l_quantity*l_discount": q * dsc, "l_quantity*l_tax": q * t,
            "l_discount_2": dsc * dsc, "l_discount*l_tax": dsc * t, "l_tax_2": t * t}
    left, want = sorted(cols, key=lambda c: -cols[c].var()), set()
    while left:
        head = left[0]
        group = [c for c in left if c == head or abs(np.corrcoef(cols[c], cols[head])[0, 1]) > 0.8]
        want |= {(head, c) for c in group}
        left = [c for c in left if c not in group]
    assert {(r["keep"], r["member"]) for r in QUERIES["sel_correlated_groups"](spark, sf_dir).collect()} == want
