"""Registered queries against their SQL on the smallest tables.

Set TIDEMARK_ALL=1 to run every query.
"""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CORE = """flagship_precision_at_k e1_latest_snapshot e4_two_hop e8_consensus e10_attributes e13_union_padded e14_episodes e15_member_flag e18_exit_tables
f6_fix_date f16_fuzzy_names f18_text_classes f19_diagnosis_classes f20_call_flags f20_visit_flags t2_folds t4_cohort t5_labels t7_split_labels t9_point_in_time_join
t10_interval_aggregates t11_t13_history t14_modes t15_age t17_t18_episodes m6_one_hot m7_standardise r1_feature_ranker_orders r9_ranks_many_tasks v3_evaluation_rows
v6_v7_full_curves v8_confusion v10_rank_model_sets v14_crosstabs v18_repair_evaluations v20_metric_over_time a4_group_metrics a5_disparities l5_totals_by_model
g1_outreach_lists g3_outcomes x1_match_coverage x7_active_day_stats x8_false_alarm_follow_up c1_checks s4_s5_predictions s8_s9_experiment_log s10_list_export""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, (list, np.ndarray)):
        return str(list(v))
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (float, np.floating)):
        return repr(round(float(v), 8) + 0.0)
    return str(int(v)) if isinstance(v, (int, np.integer)) else str(v)


def canon(df):
    df = df[sorted(df.columns)].astype(object).map(plain)
    return df.sort_values(list(df.columns), ignore_index=True)


def test_every_query_has_a_callable():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(CORE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("TIDEMARK_ALL") else CORE)
def test_query(spark, duck, name):
    got = canon(entry.queries()[name](spark, SF).toArrow().to_pandas(date_as_object=True))
    want = canon(duck.sql(entry.oracle_sql()[name]).to_arrow_table().to_pandas(date_as_object=True))
    pd.testing.assert_frame_equal(got, want)
