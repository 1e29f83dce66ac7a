"""What the plans must look like to hold at scale."""

import pytest
from conftest import SMALL

from loamwork.plans import QUERIES

STREAMS_AND_FITS = {"tune_params", "tune_regression", "importance_by_segment", "train_binary_gbt", "train_mlp_multiclass", "score_and_save", "train_forest_importance", "attribution_mean_abs", "attribution_linear", "attribution_rows"}


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS_AND_FITS))
def test_no_join_of_all_pairs(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "filter_in_and_eq")
    assert "PushedFilters: [IsNotNull(o_orderstatus), In(o_orderpriority" in text.replace("IsNotNull(o_orderpriority), ", "")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text
    assert "EqualTo(o_custkey,42)" in plan(spark, "lookup_by_key")


@pytest.mark.parametrize("name", ["normalize_space", "chunk_words", "heading_sections", "first_occurrence_dedup", "guess_title", "clean_html", "section_state", "line_score", "infer_priority", "job_requirements", "clean_requirements", "weak_output_flag", "conversation_history"])
def test_document_work_needs_no_keyed_shuffle(spark, name):
    assert "hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize("name", ["join_terms_in_text", "match_terms_presence", "match_terms_count"])
def test_terms_are_counted_in_the_row(spark, name):
    """No run of words leaves its row: one pass over the texts, no generator below it, no shuffle."""
    text = plan(spark, name)
    assert "Exchange" not in text and "Join" not in text and text.count("MapInArrow") == 1
    assert "Generate" not in text.split("MapInArrow")[1]


@pytest.mark.parametrize("name", ["top_n", "sink_preview", "capped_sample"])
def test_top_rows_are_merged_from_tasks(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_latest_record_is_an_aggregate(spark):
    text = plan(spark, "latest_by_event_time")
    assert "partial_max_by" in text and "Window" not in text


def test_requirement_lists_need_no_python(spark):
    for name in ("job_requirements", "clean_requirements", "merge_requirement_lists"):
        assert "EvalPython" not in plan(spark, name) and "InArrow" not in plan(spark, name)


def test_sweep_is_not_grouped_by_the_raw_score(spark):
    assert "hashpartitioning(score" not in plan(spark, "threshold_sweep")


@pytest.mark.parametrize("name", ["clean_requirements", "weak_output_flag", "job_requirements", "merge_requirement_lists", "first_occurrence_dedup", "heading_sections", "chunk_words", "chunk_chars", "section_state", "clean_html"])
def test_lists_are_computed_once(spark, name):
    """No filter on the length of a computed array below its generator."""
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in text.splitlines() if "Filter" in x and "size(" in x and ("transform(" in x or "lambda" in x)]


def test_similar_keys_cost_one_step_a_list(spark):
    """Short lists pass by the index of long ones, and no step of it copies their rows."""
    text = QUERIES["merge_requirement_lists"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode") <= 20


@pytest.mark.parametrize("name", ["synthesize_marginals", "complete_row_by_sampling"])
def test_drawn_columns_are_never_broadcast(spark, name):
    """The numbered source grows with the input."""
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in text.splitlines() if "Join Inner" in x]
    assert joins and all("strategy=merge" in x for x in joins)


def test_texts_are_cut_a_few_rows_at_a_time(spark):
    """No Arrow batch of 10,000 whole texts and all their pieces in Python."""
    text = plan(spark, "chunk_chars")
    assert "BatchEvalPython" in text and "ArrowEvalPython" not in text


def test_split_shuffles_no_rows_by_label(spark):
    """A few labels would be as many tasks; what is joined by label is sent to the rows at any size of theirs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "stratified_split")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_a_query_text_is_made_in_the_row_of_its_document(spark):
    text = plan(spark, "retrieval_query_text")
    assert "Exchange" not in text and "Join" not in text and text.count("MapInArrow") == 1
