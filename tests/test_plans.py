"""Plan shape guards: the properties the operators are designed around."""

import pytest

from spindle.plans.queries import QUERIES
from tests.conftest import SF001

MODEL_QUERIES = {"svm_scores", "svm_auc", "nb_accuracy", "score_new", "libsvm_features", "hashing_tfidf"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_word_count_pre_aggregates_before_shuffle(spark):
    plan = _plan(QUERIES["word_count"](spark, SF001))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(word")  # printed top-down


def test_point_lookup_pushed_to_scan(spark):
    df = QUERIES["key_role_lookup"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_name,Customer#000000001)" in text


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["kafka_offset_ranges"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_upsert_and_offsets_are_partial_aggregates(spark):
    for name in ("keyed_upsert_latest", "kafka_offset_ranges", "sensor_state_snapshot"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "partial_max" in plan or "partial_min" in plan, name


def test_sliding_spreads_buckets_not_rows(spark):
    """Rows are summed into buckets first; a bucket makes two change rows, and
    windows are filled in above the running sum (no copy of rows per window)."""
    plan = _plan(QUERIES["sliding_count"](spark, SF001))
    assert "Expand" not in plan
    first_partial = plan.rindex("partial_count")
    assert plan.index("Window [") < plan.index("Generate explode(array(") < first_partial
    assert plan.count("Scan parquet") == 1


def test_tfidf_tokenizes_once(spark):
    """The term-frequency shuffle is shared by the IDF and join branches."""
    df = QUERIES["tfidf"](spark, SF001)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("Generate posexplode") == 1
