"""Plans that must keep their shape: pruned columns, pushed filters, few exchanges."""

import re

import pytest

from shardloom.workloads import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    return text, len(re.findall(r"Exchange (?:hash|range|Round|Single)", text))


def test_filters_and_columns_reach_the_scan(spark):
    text, _ = plan(spark, "split_filter")
    assert "EqualTo(lang,en)" in text and "text" not in re.search(r"ReadSchema: struct<doc_id[^>]*>", text).group()
    text, _ = plan(spark, "lag_histogram")
    assert re.search(r"ReadSchema: struct<event_type:string,value:double>", text)


def test_rows_to_split_are_not_shuffled(spark):
    text, exchanges = plan(spark, "split_stratified")
    assert "SortMergeJoin" not in text and exchanges == 1  # the cut keys, at most two per group
    text, exchanges = plan(spark, "incremental_scan")
    assert "LeftSemi" in text and "SortMergeJoin" not in text and exchanges == 0
    text, exchanges = plan(spark, "pair_modalities")
    assert "SortMergeJoin" not in text and exchanges == 0


@pytest.mark.parametrize("name", ["manifest_fold", "bottleneck_report", "lag_quantiles", "latest_checkpoint"])
def test_one_exchange_per_aggregation(spark, name):
    text, exchanges = plan(spark, name)
    assert exchanges == 1 and "partial_" in text


@pytest.mark.parametrize("name", ["score_topk", "augment_compose", "normalize_tiles", "request_validate", "late_fusion"])
def test_vector_work_stays_in_the_jvm(spark, name):
    text, _ = plan(spark, name)
    assert "Python" not in text and "MapInArrow" not in text


def test_positions_use_no_single_partition(spark):
    for name in ("sharded_sample", "make_batches", "label_encode"):
        text, _ = plan(spark, name)
        rows = text.split("BroadcastExchange")[0]
        assert "SinglePartition" not in rows
