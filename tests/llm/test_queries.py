"""Every query runs over empty tables, and over tables whose columns are all null."""

import pytest

from textmill.llm import history
from textmill.llm import queries as q

S = {
    "final_data": "review_id long, review_description string, rating string, company string, loaded_at timestamp_ntz",
    "splits": "row_id long, split string, source string, review_id long, text string, label string, company string, is_near_empty boolean, dialect string, dialect_confidence double",
    "feedback": "feedback_row long, review_id long, batch_day string, override_id string, captured_at string, text string, model_label string, corrected_label string, agent_id string, model_score string, model_version string, company string, note string, guideline_version string",
    "overrides": "review_id long, override_id string, captured_at string, text string, model_label string, corrected_label string, agent_id string, model_score string, model_version string, company string, note string, guideline_version string, second_agent_id string, corroborating_agents string, second_label string, adjudicator_id string, adjudicated_label string, status string, route string, is_correction string",
    "train_feedback": "text string, label string, company string, is_near_empty boolean, dialect string, dialect_confidence double, source string, guideline_version string, model_label string, model_version string, captured_at string, override_id string, qa_status string, corroborated_by string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long, company string, posted_at timestamp_ntz",
    "mix_targets": "source string, target_share double, max_repeats long",
    "containers": "container_kind string, capacity_tokens long",
}


@pytest.fixture(scope="module", params=["empty", "nulls"])
def tables(spark, tmp_path_factory, request):
    d = tmp_path_factory.mktemp(request.param)
    for name, schema in S.items():
        df = spark.createDataFrame([], schema)
        if request.param == "nulls":
            df = spark.createDataFrame([tuple([None] * len(df.columns))] * 3, schema)
            if name == "splits":
                from pyspark.sql import functions as F

                df = df.withColumn("split", F.lit("train"))
        df.coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return str(d)


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_runs(spark, tables, name):
    df = q.queries()[name](spark, tables)
    assert df.columns
    n = df.count()
    if name.endswith("_found"):
        assert n == 0


def test_columns(spark, tables):
    want = {"p1": ["review_id", "label"], "p2": ["review_id_a", "review_id_b"], "p3": ["origin", "record_id", "seg_no", "lang"], "p4": ["review_id_a", "review_id_b"], "p5": ["feedback_row", "field", "kind"],
            "p6": ["row_id_a", "row_id_b"], "p7": ["feedback_row", "override_id"], "p10": ["doc_id_a", "doc_id_b"]}
    for p, columns in want.items():
        assert q.queries()[f"{p}_found"](spark, tables).columns == columns


def test_a_day_that_cannot_be_read_is_null(spark):
    days = spark.createDataFrame([("1970-01-03",), ("",), ("yesterday",), ("2026-13-40",), (None,)], "batch_day string")
    assert [r[0] for r in days.selectExpr(q.DAY.format("batch_day")).collect()] == [2, None, None, None, None]
    text = " ".join(f"word{i}" for i in range(20))
    new = spark.createDataFrame([(1, text, "2026-01-05"), (2, text, ""), (3, text, "soon")], "feedback_row long, text string, batch_day string")
    held = spark.createDataFrame([("a", text, "2026-01-02T10:00:00Z"), ("b", text, ""), ("c", text, "?")], "override_id string, text string, captured_at string")
    got = history.repeated_rows(new, "feedback_row", "text", q.DAY.format("batch_day"), held, "override_id", "text", q.DAY.format("substr(captured_at, 1, 10)"))
    assert [(r["feedback_row"], r["override_id"]) for r in got.collect()] == [(1, "a")]
