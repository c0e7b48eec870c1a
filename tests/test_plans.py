"""Shape of the physical plans of the registered queries."""

import pytest

from rollcall.operators.features import create_features
from rollcall.plans import QUERIES, bases, load_all

load_all()
SF = "/root/testdata/sf0.001"
# Queries that only need planning: no training, no stream.
LAZY = [
    "select_features", "clinic_rules", "dedup_keep_last", "dedup_postal_variants",
    "star_extract", "eligibility_filter", "prediction_window_filter", "trial_cohort_filter",
    "active_patient_semi", "cohort_semi_by_date", "geo_enrich", "not_in_exclusion", "kpi_base",
    "monitoring_base", "call_list", "call_mute_anti", "prediction_context", "trial_combine",
    "rekey_foreign_key", "merge_groups_outer", "prev_missed_features", "appointments_last_days",
    "appointments_same_day", "lagged_cumulative", "daily_top_k", "top_row_per_patient",
    "monthly_rate", "call_outcome_kpis", "outcome_matrix", "upsert_sensitive", "upsert_patients",
    "deactivate_outdated", "retention_delete", "calibration_curve", "holiday_calendar",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert bad not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_window_runs_in_a_single_task(spark, name):
    lines = plan(QUERIES[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        # The one exception: totals of the sorted ranges, a row per shuffle partition.
        if "Window [" in line and "_range" not in line:
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4])


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["kpi_base"](spark, SF))
    assert "props" not in text
    text = plan(QUERIES["eligibility_filter"](spark, SF))
    assert "PushedFilters" in text and "ReadSchema" in text


def test_best_rows_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["daily_top_k"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_left_join_becomes_inner(spark):
    text = plan(QUERIES["left_join_turned_inner"](spark, SF))
    assert "LeftOuter" not in text and "Inner" in text


def test_cleaning_needs_one_exchange(spark):
    """Both deduplications share the shuffle by patient and start."""
    text = plan(bases.cleaned(spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 2


def test_row_windows_go_by_patient_and_chunk(spark):
    """From the scan to the features, rows are shuffled for cleaning and once more for all history windows."""
    cleaned = bases.cleaned(spark, SF)
    text = plan(create_features(cleaned, bases.postal_codes(spark, SF), stage=False))
    wide = [x for x in text.splitlines() if "Exchange hashpartitioning" in x and "REPARTITION" in x]
    # The rows' branch and the slim branch of the chunk totals each hold the shuffle of the cleaning.
    assert len(wide) == 2
    by_rows = [x for x in text.splitlines() if "Window [" in x and "_at#" in x]
    assert by_rows and all("_chunk" in x for x in by_rows)
