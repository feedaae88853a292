"""Every catalog query against its DuckDB SQL (the driver's check), on the
smoke data; the fitted-model queries against what must hold for any model."""

import pytest

from paths import SF_SMALL
from seriesforge.plans.catalog import ORACLE, QUERIES
import oracle_harness as H

@pytest.fixture(scope="module")
def con():
    return H.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_pair(spark, con, name):
    problems = H.compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert not problems, problems


def test_models_have_checks():
    assert set(QUERIES) - set(ORACLE) == {"m1_m2_m3_m5_train_competition", "m4_a25_feature_selection", "m8_score_with_models",
                                          "d9_grid", "d10_patience"}


def test_competition_metrics(spark):
    rows = QUERIES["m1_m2_m3_m5_train_competition"](spark, SF_SMALL).collect()
    assert len({(r.candidate, r.horizon) for r in rows}) == len(rows) == 21
    # every candidate and horizon is scored on the same held-out rows
    assert len({r.n for r in rows}) == 1 and all(0 < r.mae <= r.rmse and r.r2 < 1 for r in rows)
    linear = QUERIES["d1_linear_regression_baseline"](spark, SF_SMALL).collect()
    assert sorted(r.horizon for r in linear) == list(range(1, 8)) and {r.n for r in linear} == {r.n for r in rows}


def test_patience_and_grid(spark):
    rows = QUERIES["d10_patience"](spark, SF_SMALL).collect()
    assert len(rows) == 14 and all(r.rounds_kept == r.best_round and (r.rounds_run == r.best_round + 50 or r.rounds_run == 500) for r in rows)
    grid = QUERIES["d9_grid"](spark, SF_SMALL).collect()
    assert sorted(r.candidate for r in grid) == [f"LeafwiseBoosting#{i}" for i in range(9)] and len({r.n for r in grid}) == 1


def test_ranking(spark):
    rows = sorted(QUERIES["m4_a25_feature_selection"](spark, SF_SMALL).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and 1 < len(rows) <= 30
    assert all(a.importance >= b.importance >= 0 for a, b in zip(rows, rows[1:])) and len({r.feature for r in rows}) == len(rows)


def test_scores_from_stored_models(spark):
    rows = QUERIES["m8_score_with_models"](spark, SF_SMALL).collect()
    assert len({(r.series_id, r.horizon) for r in rows}) == len(rows) == 5 * 7
    assert all((r.target_date - r.origin_date).days == r.horizon and r.predicted > 0 for r in rows)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
