"""Plan-shape checks: what the scale design promises must be visible in the plans."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# queries without side effects (no writes, checkpoints or model fits) — planning them is cheap
_SIDE = ("sink_", "stream_", "op", "pipeline", "validated_write", "runs_pivot_",  "table_", "scan_csv", "scan_parquet", "save_", "online_sync", "offline_export",
         "log_", "experiment_delete", "message_handler", "source_interface", "lineage_", "rf_", "gbt_",
         "logistic", "model_dispatch", "score_model", "evaluate_model", "feature_importance", "grid_search",
         "compare_models", "train_evaluate", "ann_lsh", "train_test_split", "stratified_split",
         "training_serving_skew")
PURE = sorted(n for n in QUERIES if not n.startswith(_SIDE))


def _plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_nested_loop_or_python_rows(spark, sf, name):
    p = _plan(spark, sf, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_period_filter_reaches_parquet(spark, sf):
    p = _plan(spark, sf, "drift_report")
    assert re.search(r"PushedFilters: \[[^]]*LessThan\(ts", p)
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", p)


def test_column_pruning(spark, sf):
    p = _plan(spark, sf, "category_counts")
    assert "ReadSchema: struct<event_type:string>" in p


def test_topk_is_partial_before_shuffle(spark, sf):
    p = _plan(spark, sf, "knn_by_entity")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_prefix_join_is_equi_join(spark, sf):
    p = _plan(spark, sf, "join_message_prefix")
    assert ("BroadcastHashJoin" in p or "SortMergeJoin" in p or "ShuffledHashJoin" in p)


def test_ingest_batch_prunes_the_listing(spark, sf):
    """A batch's directories prune the partitions of the listing and of the content."""
    from kestrel.operators import objects as O
    from kestrel.plans.objects import _contents
    from kestrel.session import scratch_path
    from kestrel.sources.derived import objects
    from kestrel.streaming.ingest import batch_mirror
    path = O.write_listing(objects(spark, sf), _contents(spark, sf), scratch_path(spark, "listing"))
    name = spark.read.parquet(f"{path}/listing").first()["name"]
    good = spark.createDataFrame([("m", name.rsplit("/", 1)[0])], "message_id string, path string").where("length(path) > 0")
    out = batch_mirror(good, path)
    assert out.count() >= 1
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    pruned = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert len(pruned) >= 2 and all("dynamicpruning" in f for f in pruned[:2]), plan


def test_monitors_share_one_scan(spark, sf):
    """All monitors: the source is scanned once, the final plan reads the table of snapshots and the table of bins."""
    from kestrel.operators import monitor as MO
    from kestrel.plans.drift import CAT, MONITORS, NUM, _thr
    from kestrel.sources.derived import features
    scans = []
    keep = MO._written

    def spy(df, name):
        out = keep(df, name)
        scans.append(len(re.findall(r"FileScan parquet", df._jdf.queryExecution().executedPlan().toString())))
        return out
    MO._written = spy
    try:
        jobs = MO.schedule_jobs(features(spark, sf), "feature_timestamp", MONITORS, NUM, CAT, _thr(spark))
    finally:
        MO._written = keep
    assert len(jobs.collect()) > 10
    final = re.search(r"== Final Plan ==(.*?)== Initial Plan ==", jobs._jdf.queryExecution().executedPlan().toString(), re.S).group(1)
    assert scans[0] == 1 and len(re.findall(r"Scan parquet", final)) <= 2, (scans, final)


@pytest.mark.parametrize("name", ["knn_by_entity", "knn_topk", "knn_by_vector", "knn_filtered", "knn_crowding", "crowding_topk"])
def test_query_vectors_are_not_broadcast(spark, sf, name):
    """Blocks of queries go from shuffle to shuffle, never through the driver."""
    p = _plan(spark, sf, name)
    assert "BroadcastExchange" not in p and "SortMergeJoin [_salt" in p


def test_approximate_search_broadcasts_no_vectors(spark, sf):
    from kestrel.operators import vectors as V
    from kestrel.plans.vectors import _emb, _queries
    e = _emb(spark, sf)
    cand = V.ann_candidates(V.fit_inverted_file(e, 10), e, _queries(e), 10)
    for df in (cand, V.ann_search(cand, e, _queries(e), 10)):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_split_joins_rows_to_their_own_bucket(spark):
    """Rows of one stratum are spread over its buckets: a join by stratum alone puts them into one task."""
    from pyspark.sql import functions as F
    from kestrel.operators.ml import stratified_split
    t = spark.range(1000).withColumn("y", F.col("id") * 1.0)
    train, test = stratified_split(t, "y", 0.2, F.col("id").cast("string"), stratify=False, materialize=False)
    joins = re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^]]*)\]", train._jdf.queryExecution().executedPlan().toString())
    assert joins and all("_b" in keys for keys in joins)
    want = {r[0] for r in t.withColumn("h", F.md5(F.concat(F.lit("42:"), F.col("id").cast("string")))).orderBy("h").limit(200).collect()}
    assert {r.id for r in test.collect()} == want and train.count() == 800


@pytest.mark.parametrize("name", ["knn_by_entity", "knn_topk", "knn_by_vector", "knn_filtered", "knn_crowding", "crowding_topk"])
def test_pairs_are_cut_before_they_are_sorted(spark, sf, name):
    """Scores come from the tasks that keep the best of each query, not from a row for every pair."""
    p = _plan(spark, sf, name)
    joined = p.index("SortMergeJoin [_salt")
    assert "MapInArrow" in p[:joined] and "inline" not in p


def test_approximate_search_counts_bits_in_its_tasks(spark, sf):
    from kestrel.operators import vectors as V
    from kestrel.plans.vectors import _emb, _queries
    e = _emb(spark, sf)
    p = V.ann_candidates(V.fit_inverted_file(e, 10), e, _queries(e), 10)._jdf.queryExecution().executedPlan().toString()
    assert "bit_count" not in p and "MapInArrow" in p[:p.index("SortMergeJoin [_salt")]
