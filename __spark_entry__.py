"""Registered queries and the SQL each of them is checked against."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.config import ScorerConfig
from edgewatch.functions import quantile_sketch
from edgewatch.functions.ordering import Slices, exact_quantiles, long_form, smallest_per_group, with_row_index
from edgewatch.functions.scalar import event_seconds
from edgewatch.operators import alerts as alert_ops
from edgewatch.operators import attributes, baseline, clean, curves, edges, evaluate, live_view, monitor, replay, sketch
from edgewatch.operators.scoring import Clock, assign_ticks, profile_events, score_edges
from edgewatch.operators.trees import decision_trees
from edgewatch.plans.detection import compare_detectors, evaluate_batch
from edgewatch.schemas import ALERT_TABLE_SCHEMA, LABEL_CLASSES
from edgewatch.session import materialize, shared_dir
from edgewatch.sinks import compaction, reports, tables
from edgewatch.sources import edge_files, edge_log, flow_files, streams
from edgewatch.sources import tables as stored_tables
from edgewatch.sources.edge_files import attach_labels
from edgewatch.streaming.entity_clock import STATE_STORE, count_with_entity_clocks
from edgewatch.streaming.job import scoring_job
from edgewatch.streaming.rates import RateTable

try:
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL
    from corpus_pipeline import run as _pipeline
    from edgewatch.llm.queries import ORACLE_SQL as _LLM_SQL
    from edgewatch.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:  # the subpackage is optional, its own faults are not hidden
    if missing.name not in ("corpus_pipeline", "edgewatch.llm", "edgewatch.llm.queries"):
        raise
    _CORPUS, _CORPUS_SQL = {}, {}
else:
    _CORPUS = {**_LLM_QUERIES, "pipeline": _pipeline}
    _CORPUS_SQL = _LLM_SQL | ({"pipeline": _PIPELINE_SQL} if _PIPELINE_SQL else {})

DAY = 86_400
HOUR = 3_600
ZSCORE = 2.0
SELECTIVE = ScorerConfig(tick_seconds=HOUR, alpha=0.5, threshold=80.0)
SLOW_DECAY = ScorerConfig(tick_seconds=HOUR, alpha=0.98)
DAILY = ScorerConfig(tick_seconds=30 * DAY, alpha=0.5)
SKETCHED = ScorerConfig(
    tick_seconds=HOUR, alpha=0.5, width=64, depth=3, counts="sketch", hash_fn="md5"
)
SMALL_SKETCH = ScorerConfig(width=64, depth=4, hash_fn="md5")
FILTERED = ScorerConfig(tick_seconds=HOUR, alpha=0.5, filter_anomalies=True, filter_cutoff=80.0)
LATE_ORDER = ScorerConfig(tick_seconds=HOUR, alpha=0.5, threshold=80.0, order="arrival")
LOG_PARTITIONS = 4
FORGET = 5 * DAY
FEATURES = ["quantity", "extendedprice", "discount", "tax"]
RAW_FEATURES = ["Flow Duration", "Total Fwd Packets", "Flow Bytes/s"]


# --- inputs ------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User -> event type, one edge event per row of ``events``."""
    return edges.as_edges(
        _table(spark, sf_dir, "events"),
        F.concat(F.lit("u"), "user_id"),
        F.col("event_type"),
        event_seconds(F.col("ts")),
        F.col("event_id"),
        label=(F.col("value") >= 100).cast("smallint"),
    )


def _line_id():
    """60-bit number from a line item's columns, the same in both engines."""
    text = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    )
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer -> supplier, one edge event per line item: many edges, few events each."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return edges.as_edges(
        joined,
        F.concat(F.lit("c"), "o_custkey"),
        F.concat(F.lit("s"), "l_suppkey"),
        event_seconds(F.col("l_shipdate")),
        _line_id(),
    )


def _raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as flow records with untidy labels and numbers in text."""
    price = F.col("l_extendedprice").cast("string")
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45), "Heartbleed")
        .when(F.col("l_returnflag") == "N", " BENIGN ")
        .when(F.col("l_returnflag") == "A", "DDOS")
        .otherwise("port scan").alias("Label"),
        F.when(F.pmod("l_orderkey", F.lit(11)) == 0, "Infinity")
        .when(F.pmod("l_orderkey", F.lit(13)) == 0, "n/a")
        .otherwise(price).alias("Flow Duration"),
        F.when(F.pmod("l_orderkey", F.lit(7)) == 0, F.lit(None))
        .otherwise(F.col("l_quantity").cast("string")).alias("Total Fwd Packets"),
        F.when(F.pmod("l_orderkey", F.lit(17)) == 0, "NaN")
        .otherwise(F.col("l_tax").cast("string")).alias("Flow Bytes/s"),
    )


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as clean flow records with a class and four features."""
    labelled = _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", " BENIGN ")
        .when(F.col("l_returnflag") == "A", "DDOS")
        .otherwise("port scan").alias("Label"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.pmod("l_orderkey", F.lit(19)) > 0, F.col("l_extendedprice")).alias("extendedprice"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    return clean.normalize_labels(labelled)


def _round(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _ingested_at():
    """Arrival of an event a few seconds after it happened, for the delay statistics."""
    return F.timestamp_seconds(F.col("timestamp") + F.pmod("event_id", F.lit(7)))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.alert_rows(score_edges(_events(spark, sf_dir), SELECTIVE))


# --- queries -----------------------------------------------------------------------------------


def edge_bucket_counts(spark, sf_dir):
    return baseline.edge_bucket_counts(_events(spark, sf_dir), DAY)


def history_moments(spark, sf_dir):
    moments = baseline.history_moments(baseline.edge_bucket_counts(_events(spark, sf_dir), DAY))
    return _round(moments, "mean_count", "std_count")


def batch_zscore(spark, sf_dir):
    return _round(baseline.zscore_flags(_events(spark, sf_dir), DAY, ZSCORE), "z_score")


def sparse_zscore(spark, sf_dir):
    return _round(baseline.zscore_flags(_shipments(spark, sf_dir), 30 * DAY, ZSCORE), "z_score")


def flag_totals(spark, sf_dir):
    events = _events(spark, sf_dir)
    span = baseline.time_span(events)
    return baseline.flag_totals(
        baseline.edge_bucket_counts(events, DAY, span),
        baseline.zscore_flags(events, DAY, ZSCORE, span),
    )


def truth_edges(spark, sf_dir):
    return edges.truth_edges(_events(spark, sf_dir))


def caught_edges(spark, sf_dir):
    events = _events(spark, sf_dir)
    return edges.common_edges(
        edges.truth_edges(events), baseline.zscore_flags(events, DAY, ZSCORE)
    )


def batch_eval(spark, sf_dir):
    return _round(evaluate_batch(_events(spark, sf_dir), DAY, ZSCORE), "precision", "recall")


def method_comparison(spark, sf_dir):
    compared = compare_detectors(_events(spark, sf_dir), SELECTIVE, DAY, ZSCORE, _ingested_at())
    return _round(
        compared, "precision", "recall", "max_detection_delay", "avg_detection_delay"
    )


def tick_assign(spark, sf_dir):
    events = _events(spark, sf_dir)
    profile = profile_events(events, SELECTIVE)
    ticked = assign_ticks(events, SELECTIVE, profile, Clock(profile.first))
    return ticked.select("event_id", "timestamp", "tick")


def _scores(df: DataFrame) -> DataFrame:
    doubles = ("score", "edge_score", "src_score", "dst_score", "expected_edge")
    return _round(df, *doubles)


def chi_squared(spark, sf_dir):
    scored = score_edges(_events(spark, sf_dir), SLOW_DECAY)
    return _round(
        scored.select("event_id", "edge_current", "edge_total", "tick", "edge_score"), "edge_score"
    )


def midas_score(spark, sf_dir):
    return _scores(score_edges(_events(spark, sf_dir), SELECTIVE))


def midas_score_slow_decay(spark, sf_dir):
    return _scores(score_edges(_events(spark, sf_dir), SLOW_DECAY))


def midas_score_sparse(spark, sf_dir):
    # the join is run once, scoring reads the events several times
    shipments = materialize(_shipments(spark, sf_dir), "shipments", drop_shuffles=True, compression="zstd")
    return _scores(score_edges(shipments, DAILY))


def midas_score_late(spark, sf_dir):
    """Events that arrive by id while their timestamps jump back by up to 2.5 hours."""
    events = _events(spark, sf_dir)
    back = F.pmod(F.col("event_id") * 7919, F.lit(9000))
    late = events.withColumn("timestamp", F.col("timestamp") - back)
    cfg = ScorerConfig(tick_seconds=HOUR, alpha=0.5, threshold=80.0, order="arrival")
    return _scores(score_edges(late, cfg))


def midas_sketch_score(spark, sf_dir):
    return _scores(score_edges(_events(spark, sf_dir), SKETCHED))


def midas_f_score(spark, sf_dir):
    return _scores(score_edges(_events(spark, sf_dir), FILTERED))


def cms_cells(spark, sf_dir):
    return sketch.build_sketch(_events(spark, sf_dir), "src", SMALL_SKETCH)


def cms_estimate(spark, sf_dir):
    events = _events(spark, sf_dir)
    cells = sketch.build_sketch(events, "src", SMALL_SKETCH)
    return sketch.estimate_counts(cells, events, "src", SMALL_SKETCH)


def cms_merge_decay(spark, sf_dir):
    """Sketches of labelled and unlabelled events, merged, then decayed."""
    events = _events(spark, sf_dir)
    parts = [
        sketch.build_sketch(events.filter(F.col("label") == v), "src", SMALL_SKETCH) for v in (0, 1)
    ]
    return sketch.decay_sketch(sketch.merge_sketches(*parts), 0.9)


def score_stats(spark, sf_dir):
    scored = score_edges(_events(spark, sf_dir), SELECTIVE)
    stats = evaluate.score_stats(alert_ops.score_rows(scored, _ingested_at()))
    return _round(
        stats, "min_score", "max_score", "avg_score", "max_detection_delay", "avg_detection_delay"
    )


def scores_table(spark, sf_dir):
    scored = score_edges(_events(spark, sf_dir), SELECTIVE)
    rows = alert_ops.score_rows(scored, _ingested_at())
    return _round(rows, "anomaly_score").withColumns(
        {c: F.unix_seconds(c) for c in ("event_time", "ingested_at")}
    )


def alerts_table(spark, sf_dir):
    rows = _round(_alerts(spark, sf_dir), "score")
    return rows.select(
        "alert_id", "src", "dst", F.unix_seconds("event_time").alias("event_time"), "score",
        F.array_join("subgraph_nodes", ",").alias("subgraph_nodes"),
    )


def alert_messages(spark, sf_dir):
    """Envelopes, read back from their JSON text."""
    schema = (
        "type string, data struct<alert_id:string,src:string,dst:string,timestamp:bigint,"
        "score:double,subgraph_nodes:array<string>>"
    )
    messages = alert_ops.alert_messages(_alerts(spark, sf_dir))
    parsed = messages.select("alert_id", F.from_json("value", schema).alias("m"))
    return parsed.select(
        "alert_id", F.col("m.type").alias("type"), "m.data.src", "m.data.dst", "m.data.timestamp",
        F.round("m.data.score", 6).alias("score"),
        F.array_join("m.data.subgraph_nodes", ",").alias("subgraph_nodes"),
    )


def alert_rate(spark, sf_dir):
    return monitor.alert_rate(_alerts(spark, sf_dir), seconds=1)


def alert_feed(spark, sf_dir):
    feed = _round(monitor.alert_feed(_alerts(spark, sf_dir)), "score")
    return feed.select("alert_id", "src", "dst", "score", "event_id")


def alert_graph_edges(spark, sf_dir):
    return _round(monitor.alert_graph_edges(_alerts(spark, sf_dir)), "score")


def alert_graph_edges_all(spark, sf_dir):
    return _round(monitor.alert_graph_edges(_alerts(spark, sf_dir), None), "score")


def alert_graph_nodes(spark, sf_dir):
    return monitor.alert_graph_nodes(_alerts(spark, sf_dir))


def alert_graph_nodes_all(spark, sf_dir):
    return monitor.alert_graph_nodes(_alerts(spark, sf_dir), None, None)


def live_graph_edges(spark, sf_dir):
    return _round(live_view.live_graph_edges(_alerts(spark, sf_dir), flush_seconds=HOUR), "score")


def live_graph_nodes(spark, sf_dir):
    return live_view.live_graph_nodes(_alerts(spark, sf_dir), flush_seconds=HOUR)


def _judged(spark, sf_dir):
    return _round(score_edges(_events(spark, sf_dir), SELECTIVE), "score")


def threshold_curve(spark, sf_dir):
    return _round(curves.threshold_curve(_judged(spark, sf_dir)), "precision", "recall")


def score_separation(spark, sf_dir):
    return _round(curves.separation(_judged(spark, sf_dir)), "auc", "average_precision")


def positional_label_join(spark, sf_dir):
    """Row N of the event file with row N of a label column read separately."""
    events = with_row_index(_table(spark, sf_dir, "events").select("event_id", "user_id"), parquet=True)
    labels = with_row_index(
        _table(spark, sf_dir, "events").select((F.col("value") >= 100).cast("smallint").alias("label")),
        parquet=True,
    )
    return attach_labels(events, labels, "row_idx")


def _event_rows(spark, sf_dir):
    return with_row_index(
        _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts"),
        parquet=True,
    )


def replay_timeline(spark, sf_dir):
    rows = replay.replay_timeline(_event_rows(spark, sf_dir), rate=100, start=1_700_000_000)
    return rows.select("row_idx", "event_id", "timestamp")


def _replayable(spark, sf_dir):
    return _event_rows(spark, sf_dir).select(
        "row_idx",
        F.concat(F.lit("u"), "user_id").alias("Source IP"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("Destination IP"),
        F.col("ts").alias("Timestamp"),
        (F.col("value") >= 100).alias("is_attack"),
        F.when(F.col("value") >= 100, "DDoS").otherwise("Benign").alias("attack_type"),
        F.col("value").alias("Flow Duration"),
        F.when(F.col("user_id") > 5, F.col("user_id").cast("string")).otherwise("none").alias("Flow Bytes/s"),
        F.col("event_type").alias("Protocol"),
    )


def replay_events_json(spark, sf_dir):
    """Events as JSON text, read back."""
    schema = (
        "src string, dst string, timestamp bigint, label int, attack_type string, "
        "`Flow Duration` double, `Flow Bytes/s` double, Protocol string"
    )
    sent = replay.replay_json(_replayable(spark, sf_dir), rate=100, start=1_700_000_000)
    return sent.select("row_idx", F.from_json("value", schema).alias("e")).select("row_idx", "e.*")


def replay_events(spark, sf_dir):
    """Events with a feature map and their original timestamps."""
    sent = replay.replay_events(_replayable(spark, sf_dir), preserve_timestamps=True)
    return sent.select(
        "row_idx", "src", "dst", "timestamp", "label", "attack_type",
        F.col("features")["Flow Duration"].alias("flow_duration"),
        F.size("features").cast("bigint").alias("n_features"),
    )


def sample_per_group(spark, sf_dir):
    key = F.conv(F.substring(F.md5(F.concat(F.lit("42:"), F.col("event_id").cast("string"))), 1, 15), 16, 10)
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    return smallest_per_group(events, "event_type", key.cast("bigint"), 5, "event_id")


def label_normalize(spark, sf_dir):
    flows = clean.normalize_labels(_raw_flows(spark, sf_dir))
    return flows.select("l_orderkey", "l_partkey", "l_linenumber", "Label", "is_attack", "attack_type")


def unknown_labels(spark, sf_dir):
    return clean.unknown_labels(_raw_flows(spark, sf_dir))


def median_impute(spark, sf_dir):
    flows = clean.impute_medians(_raw_flows(spark, sf_dir), RAW_FEATURES)
    return flows.select("l_orderkey", "l_partkey", "l_linenumber", *[F.col(f"`{c}`") for c in RAW_FEATURES])


def parse_timestamps(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    kind = F.pmod("event_id", F.lit(5))
    text = (
        F.when(kind == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
        .when(kind == 1, F.date_format(ts, "dd/MM/yyyy hh:mm:ss a"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd hh:mm:ss a"))
        .otherwise(F.date_format(ts, "yyyyMMdd"))
    )
    parsed = clean.parse_timestamps(text)
    return _table(spark, sf_dir, "events").select("event_id", F.unix_seconds(parsed).alias("parsed"))


def dedupe_keep_first(spark, sf_dir):
    flows = _table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_tax", "l_discount",
        event_seconds(F.col("l_shipdate")).alias("Timestamp"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
    )
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return clean.drop_duplicate_flows(flows, order).drop(*order)


def class_counts(spark, sf_dir):
    return clean.class_counts(clean.normalize_labels(_raw_flows(spark, sf_dir)))


def dataset_summary(spark, sf_dir):
    summary = clean.dataset_summary(clean.normalize_labels(_raw_flows(spark, sf_dir)), files_loaded=1)
    count = F.col("attack_types")
    return summary.select(
        "total_rows", "benign_rows", "attack_rows",
        count["DDoS"].alias("ddos"), count["PortScan"].alias("port_scan"),
        "numeric_columns", "files_loaded",
    )


def quantiles(spark, sf_dir):
    """Quartiles per class and feature, by the two-step method meant for large tables."""
    flows = _flows(spark, sf_dir)
    found = exact_quantiles(
        flows, FEATURES, [0.25, 0.5, 0.75], "attack_type", rows=flows.count(), rows_per_slice=5_000
    )
    return _round(found, "low", "high", "q0", "q1", "q2")


def feature_statistics(spark, sf_dir):
    stats = attributes.feature_statistics(_flows(spark, sf_dir), FEATURES)
    return _round(stats, *[c for c in stats.columns if c not in ("attack_type", "feature")])


def sketched_medians(spark, sf_dir):
    """Medians from sketches of two halves of the flows, and whether their ranks are as near as promised."""
    flows = _flows(spark, sf_dir).withColumn("half", F.pmod(F.xxhash64("quantity", "extendedprice"), F.lit(2)))
    halves = [quantile_sketch.feature_sketches(flows.filter(F.col("half") == i), FEATURES, "attack_type") for i in (0, 1)]
    path = _scratch(spark, "sketches")
    for i, half in enumerate(halves):
        half.write.parquet(f"{path}/half={i}")
    merged = quantile_sketch.merged_sketches(spark.read.parquet(path), "attack_type")
    medians = quantile_sketch.sketch_quantiles(merged, "attack_type", [0.5])
    cells = long_form(flows, FEATURES, Slices({}), F.col("attack_type"))
    ranks = cells.join(F.broadcast(medians), ["attack_type", "feature"]).groupBy("attack_type", "feature", "n").agg(
        (F.count_if(F.col("value") < F.col("q0")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("value") <= F.col("q0")) / F.count(F.lit(1))).alias("upto"),
    )
    error = 2 * quantile_sketch.rank_error()
    near = (F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    return ranks.select("attack_type", "feature", "n", near.alias("near"))


def cliffs_delta(spark, sf_dir):
    return _round(attributes.cliffs_delta(_flows(spark, sf_dir), FEATURES), "cliff_delta")


def feature_importance(spark, sf_dir):
    found = attributes.feature_importance(_flows(spark, sf_dir), FEATURES)
    return _round(found, "importance", digits=8)


def correlation_matrix(spark, sf_dir):
    return _round(attributes.correlation_matrix(_flows(spark, sf_dir), FEATURES), "correlation")


def attribute_table(spark, sf_dir):
    flows = _flows(spark, sf_dir)
    stats = attributes.feature_statistics(flows, FEATURES)
    return _round(attributes.attribute_table(flows, stats, features=FEATURES), "support_percent")


def _tree_flows(spark, sf_dir):
    """Flows in which the class depends on whole-number features, so that trees have something to find."""
    discount, tax = (F.round(F.col(c) * 100) for c in ("l_discount", "l_tax"))
    kind = (
        F.when((F.col("l_quantity") > 40) & (discount > 5), "DDoS")
        .when(tax > 6, "PortScan")
        .otherwise("Benign")
    )
    return _table(spark, sf_dir, "lineitem").select(
        kind.alias("attack_type"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"), discount.alias("discount"), tax.alias("tax"),
    )


def decision_tree_rules(spark, sf_dir):
    rules = decision_trees(_tree_flows(spark, sf_dir), FEATURES).rules
    return _round(rules, "threshold")


def decision_tree_metrics(spark, sf_dir):
    return decision_trees(_tree_flows(spark, sf_dir), FEATURES).metrics


def attribute_table_with_trees(spark, sf_dir):
    flows = _tree_flows(spark, sf_dir)
    trees = decision_trees(flows, FEATURES)
    stats = attributes.feature_statistics(flows, FEATURES)
    table = attributes.attribute_table(flows, stats, trees.metrics, FEATURES)
    return _round(table, "support_percent")


def _nan_flows(spark, sf_dir):
    """The flows with NaN where they have gaps."""
    return _flows(spark, sf_dir).withColumn(
        "extendedprice", F.coalesce("extendedprice", F.lit(float("nan")))
    )


def feature_importance_with_nan(spark, sf_dir):
    found = attributes.feature_importance(_nan_flows(spark, sf_dir), FEATURES)
    return _round(found, "importance", digits=8)


def correlation_matrix_with_nan(spark, sf_dir):
    return _round(attributes.correlation_matrix(_nan_flows(spark, sf_dir), FEATURES), "correlation")


def _priced_flows(spark, sf_dir):
    """Flows in which the class follows the price, a feature of many thousand values, and no tree is perfect."""
    price = F.col("l_extendedprice")
    kind = (
        F.when(price > 38_000 + 260_000 * F.col("l_discount"), "DDoS")
        .when(price < 4_000 + 50_000 * F.col("l_tax"), "PortScan")
        .otherwise("Benign")
    )
    return _table(spark, sf_dir, "lineitem").select(
        kind.alias("attack_type"), F.col("l_quantity").alias("quantity"), price.alias("extendedprice"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def decision_tree_nodes(spark, sf_dir):
    return _round(decision_trees(_priced_flows(spark, sf_dir), FEATURES).nodes, "threshold")


def decision_tree_importances(spark, sf_dir):
    return _round(decision_trees(_priced_flows(spark, sf_dir), FEATURES).importances, "importance")


def trees_with_nan(spark, sf_dir):
    """Gaps in a feature that no perfect tree uses change nothing."""
    gap = F.when(F.pmod(F.round(F.col("extendedprice") * 100).cast("long"), F.lit(19)) == 0, F.lit(float("nan")))
    flows = _tree_flows(spark, sf_dir).withColumn("extendedprice", F.coalesce(gap, "extendedprice"))
    return decision_trees(flows, FEATURES).metrics


# --- tables written to the session's shared folder and read back ---------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/edgewatch/{name}-{uuid.uuid4().hex}"


def _edge_text(spark, sf_dir):
    return _events(spark, sf_dir).select("src", "dst", "timestamp", "label", "event_id")


def headed_edges(spark, sf_dir):
    path = _scratch(spark, "headed")
    rows = _edge_text(spark, sf_dir).select("label", F.col("timestamp"), F.col("dst").alias("Destination"), F.col("src").alias("Source"))
    rows.write.option("header", True).csv(path)
    return edge_files.read_edges(spark, path).select("src", "dst", "timestamp", "label")


def headerless_edges(spark, sf_dir):
    path = _scratch(spark, "headerless")
    _edge_text(spark, sf_dir).drop("event_id").write.csv(path)
    return edge_files.read_edges(spark, path).select("src", "dst", "timestamp", "label")


def _untidy_lines(spark, sf_dir) -> str:
    """Edge lines of which some are short, some have no time and some have a field too many."""
    path = _scratch(spark, "untidy")
    kind = F.pmod("event_id", F.lit(50))
    line = (
        F.when(kind == 1, F.concat_ws(",", "src", "dst"))
        .when(kind == 2, F.concat_ws(",", "src", "dst", F.lit("soon"), "label"))
        .when(kind == 3, F.concat_ws(",", "src", "dst", "timestamp", "label", F.lit("more")))
        .otherwise(F.concat_ws(",", "src", "dst", "timestamp", "label"))
    )
    # the first line decides the number of fields
    rows = _edge_text(spark, sf_dir).select(line.alias("value"))
    header = spark.createDataFrame([("src,dst,timestamp,label",)], "value string")
    header.unionByName(rows).repartition(1).sortWithinPartitions(F.desc(F.col("value") == "src,dst,timestamp,label")).write.text(path)
    return path


def quarantined_edges(spark, sf_dir):
    found = edge_files.read_edges(spark, _untidy_lines(spark, sf_dir), malformed="quarantine")
    return found.select("src", "dst", "timestamp", "label")


def malformed_lines(spark, sf_dir):
    return edge_files.malformed_rows(spark, _untidy_lines(spark, sf_dir)).select("line")


def _messages(spark, sf_dir):
    """Event messages as a topic has them, some cut off."""
    message = F.to_json(F.struct("src", "dst", "timestamp", "label"))
    broken = F.pmod("event_id", F.lit(40)) == 0
    return _edge_text(spark, sf_dir).select(
        F.when(broken, F.substring(message, 1, 20)).otherwise(message).alias("value"), "event_id"
    )


def quarantined_messages(spark, sf_dir):
    return streams.decode_events(_messages(spark, sf_dir), "quarantine").select("e.*", "event_id")


def malformed_messages(spark, sf_dir):
    return streams.malformed_events(_messages(spark, sf_dir))


def stacked_flow_files(spark, sf_dir):
    """Two folders of CSV files with other column orders and padded names, found by three patterns."""
    path = _scratch(spark, "flows")
    flows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    odd = F.pmod("l_linenumber", F.lit(2)) == 1
    flows.filter(odd).toDF(" l_orderkey", "l_partkey ", "l_suppkey", "l_linenumber").write.option("header", True).csv(f"{path}/odd")
    flows.filter(~odd).select(*reversed(flows.columns)).write.option("header", True).csv(f"{path}/even")
    stacked = flow_files.read_flow_files(spark, f"{path}/odd/*.csv", f"{path}/even/*.csv", f"{path}/none/*.csv")
    tidy = clean.require_columns(clean.trim_column_names(stacked), *flows.columns)
    return tidy.select(*[F.col(c).cast("bigint").alias(c) for c in flows.columns])


def stored_flows(spark, sf_dir):
    path = _scratch(spark, "flows")
    tables.write_flows(_flows(spark, sf_dir).select("attack_type", *FEATURES), path)
    return flow_files.read_flows(spark, path)


def stored_scores(spark, sf_dir):
    path = _scratch(spark, "scores")
    scored = score_edges(_events(spark, sf_dir), SELECTIVE)
    tables.write_table(alert_ops.score_rows(scored, _ingested_at()), path, 3)
    rows = _round(stored_tables.read_scores(spark, path), "anomaly_score")
    seconds = {c: F.unix_seconds(c) for c in ("event_time", "ingested_at")}
    return rows.withColumns(seconds).withColumn("event_date", F.col("event_date").cast("string"))


STREAM_BATCHES = 4


def _parts(events: DataFrame, column: str) -> list[DataFrame]:
    """The events in ``STREAM_BATCHES`` ranges of a column, in order."""
    low, high = events.agg(F.min(column), F.max(column)).first()
    step = (high - low) // STREAM_BATCHES + 1
    return [events.filter(F.col(column).between(low + i * step, low + (i + 1) * step - 1)) for i in range(STREAM_BATCHES)]


def _streamed(spark, parts: list[DataFrame], job, after_each=None) -> None:
    """Each part appears as files that the job's query then finds; the query is restarted for each."""
    folder = _scratch(spark, "stream")
    for part in parts:
        part.write.mode("append").json(folder)
        job.start(streams.file_edges(spark, folder), availableNow=True).awaitTermination()
        if after_each:
            after_each()


def _job(spark, cfg, **options):
    return scoring_job(spark, f"edgewatch/job-{uuid.uuid4().hex}", cfg, **options)


def _stored_scores_of(spark, job):
    rows = _round(stored_tables.read_scores(spark, f"{job.path}/scores"), "anomaly_score")
    return rows.select("id", "src", "dst", F.unix_seconds("event_time").alias("event_time"), "anomaly_score", "is_alert", "label")


def streamed_scores(spark, sf_dir):
    """A streaming query over files that is stopped and started again, with state between its batches."""
    job = _job(spark, SELECTIVE)
    _streamed(spark, _parts(_edge_text(spark, sf_dir), "timestamp"), job)
    return _stored_scores_of(spark, job)


def compacted_alerts(spark, sf_dir):
    """The alerts of a stream, three of four batches merged into days; what one half of the days holds."""
    job = _job(spark, SELECTIVE)
    events = _edge_text(spark, sf_dir)
    _streamed(spark, _parts(events, "timestamp"), job)
    compaction.compact_table(spark, f"{job.path}/alerts", STREAM_BATCHES - 2)
    low, high = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    middle = datetime.fromtimestamp((low + high) // 2, timezone.utc).date()
    rows = _round(stored_tables.read_alerts(spark, f"{job.path}/alerts", last=middle), "score")
    return rows.select("alert_id", "src", "dst", F.unix_seconds("event_time").alias("event_time"), "score", F.array_join("subgraph_nodes", ",").alias("subgraph_nodes"))


def watermarked_scores(spark, sf_dir):
    """Events that arrive by id and jump back in time; those an hour behind earlier batches are set aside."""
    back = F.pmod(F.col("event_id") * 7919, F.lit(9000))
    events = _edge_text(spark, sf_dir).withColumn("timestamp", F.col("timestamp") - back)
    job = _job(spark, LATE_ORDER, delay_seconds=HOUR, late="divert")
    _streamed(spark, _parts(events, "event_id"), job)
    kept = _stored_scores_of(spark, job).select("id", "event_time", "anomaly_score", F.lit(False).alias("late"))
    late = spark.read.schema("event_id long, timestamp long").parquet(f"{job.path}/late")
    return kept.unionByName(
        late.select(F.col("event_id").alias("id"), F.col("timestamp").alias("event_time"), F.lit(None).cast("double").alias("anomaly_score"), F.lit(True).alias("late"))
    )


def streamed_alert_rate(spark, sf_dir):
    """The sliding rate of a stream over the alerts table, which another stream writes."""
    job = _job(spark, SELECTIVE)
    rates = RateTable(f"{job.path}/rates")

    def follow():
        alerts = spark.readStream.schema(ALERT_TABLE_SCHEMA).parquet(f"{job.path}/alerts")
        rates.start(alerts, seconds=1, availableNow=True).awaitTermination()

    _streamed(spark, _parts(_edge_text(spark, sf_dir), "timestamp"), job, follow)
    return rates.read(spark)


def logged_scores(spark, sf_dir):
    """Messages appended to a log of four partitions, and scored in order of arrival by a query that follows it."""
    job = _job(spark, ScorerConfig(tick_seconds=HOUR, alpha=0.5, threshold=80.0, order="arrival", arrival="arrival"))
    path = f"{job.path}/log"
    for part in _parts(_edge_text(spark, sf_dir), "timestamp"):
        message = part.withColumn("value", F.to_json(F.struct("src", "dst", "timestamp", "label")))
        place = F.pmod("event_id", F.lit(LOG_PARTITIONS))
        ordered = message.repartition(LOG_PARTITIONS, place).sortWithinPartitions("timestamp", "event_id")
        edge_log.append_log(spark, edge_log.log_rows(ordered, place, F.timestamp_seconds("timestamp")), path)
        job.start(streams.topic_events(edge_log.follow_log(spark, path)), availableNow=True).awaitTermination()
    return _stored_scores_of(spark, job).drop("id")


def entity_clock_counts(spark, sf_dir):
    """Counts that fade per edge, kept in the state store of a query that is restarted for each part."""
    path = _scratch(spark, "clocks")
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        for part in _parts(_edge_text(spark, sf_dir), "timestamp"):
            part.write.mode("append").json(f"{path}/in")
            counted = count_with_entity_clocks(streams.file_edges(spark, f"{path}/in"), SELECTIVE, FORGET)
            writer = counted.writeStream.format("parquet").option("path", f"{path}/out")
            writer.option("checkpointLocation", f"{path}/at").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STATE_STORE[0], before)
    found = spark.read.parquet(f"{path}/out").select("event_id", "current", "total", "age_ticks", "score")
    return _round(found, "current", "score")


def report_file(spark, sf_dir):
    path = _scratch(spark, "report")
    reports.write_csv_report(clean.class_counts(_flows(spark, sf_dir)), path)
    return spark.read.option("header", True).csv(path).withColumn("rows", F.col("rows").cast("bigint"))


def without_test_rows(spark, sf_dir):
    own = F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit(alert_ops.TEST_SOURCE)).otherwise(F.col("src"))
    return alert_ops.without_test_rows(_edge_text(spark, sf_dir).withColumn("src", own))


def sketch_bound(spark, sf_dir):
    """The bound on overestimates, and how the estimates of all sources and all edges keep it."""
    events = _events(spark, sf_dir).withColumn("edge", F.concat_ws(">", "src", "dst"))
    epsilon, delta = sketch.error_bounds(SMALL_SKETCH)
    parts = [
        sketch.estimate_quality(events, key, SMALL_SKETCH).select(F.lit(key).alias("key"), "*", F.lit(epsilon).alias("epsilon"), F.lit(delta).alias("delta"))
        for key in ("src", "edge")
    ]
    found = parts[0].unionByName(parts[1]).withColumn("bound", F.col("epsilon") * F.col("items"))
    return _round(found, "epsilon", "delta", "bound")


_QUERIES = (
    edge_bucket_counts, history_moments, batch_zscore, sparse_zscore, flag_totals, truth_edges,
    caught_edges, batch_eval, method_comparison, tick_assign, chi_squared, midas_score,
    midas_score_slow_decay, midas_score_sparse, midas_score_late, midas_sketch_score, midas_f_score,
    cms_cells, cms_estimate, cms_merge_decay, score_stats, scores_table, alerts_table,
    alert_messages, alert_rate, alert_feed, alert_graph_edges, alert_graph_edges_all,
    alert_graph_nodes, alert_graph_nodes_all, positional_label_join, replay_timeline,
    replay_events_json, replay_events, sample_per_group, label_normalize, unknown_labels,
    median_impute, parse_timestamps, dedupe_keep_first, class_counts, dataset_summary, quantiles,
    feature_statistics, sketched_medians, cliffs_delta, feature_importance, correlation_matrix, attribute_table,
    decision_tree_rules, decision_tree_metrics, decision_tree_nodes, decision_tree_importances,
    attribute_table_with_trees,
    feature_importance_with_nan, correlation_matrix_with_nan, trees_with_nan, headed_edges,
    headerless_edges, quarantined_edges, malformed_lines, quarantined_messages, malformed_messages,
    stacked_flow_files, stored_flows, stored_scores, streamed_scores, report_file,
    compacted_alerts, watermarked_scores, streamed_alert_rate, logged_scores, entity_clock_counts, live_graph_edges, live_graph_nodes,
    threshold_curve, score_separation,
    without_test_rows, sketch_bound,
)


def entry(spark: SparkSession) -> DataFrame:
    """Which edges burst in which window, on the smallest tables."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return batch_zscore(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {q.__name__: q for q in _QUERIES}
    return {name: _in_utc(query) for name, query in (own | _CORPUS).items()}


def _in_utc(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


# --- SQL ---------------------------------------------------------------------------------------

_EV = """ev AS (
  SELECT 'u' || user_id AS src, event_type AS dst, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
         event_id, CAST(value >= 100 AS SMALLINT) AS label
  FROM events)"""

_SHIP = """ev AS (
  SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS timestamp,
         CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15) AS BIGINT) AS event_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_LATE = _EV.replace(
    "CAST(floor(epoch(ts)) AS BIGINT) AS timestamp",
    "CAST(floor(epoch(ts)) AS BIGINT) - (event_id * 7919) % 9000 AS timestamp",
)


def _baseline_ctes(events: str, window: int) -> str:
    return f"""{events},
b AS (SELECT (timestamp - (SELECT min(timestamp) FROM ev)) // {window} AS bucket, src, dst FROM ev),
eb AS (SELECT bucket, src, dst, count(*) AS k FROM b GROUP BY ALL),
pre AS (SELECT *, coalesce(sum(k) OVER (PARTITION BY src, dst ORDER BY bucket
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM eb),
step AS (SELECT bucket, sum(k) AS dn, sum(CASE WHEN p = 0 THEN 1 ELSE 0 END) AS de,
         sum((p + k) * (p + k) - p * p) AS dq FROM pre GROUP BY bucket),
acc AS (SELECT bucket, coalesce(sum(dn) OVER w, 0) AS n, coalesce(sum(de) OVER w, 0) AS e,
        coalesce(sum(dq) OVER w, 0) AS q FROM step
        WINDOW w AS (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
moments AS (SELECT bucket, CAST(n AS BIGINT) AS history_events, CAST(e AS BIGINT) AS history_edges,
        CASE WHEN e > 0 THEN CAST(n AS DOUBLE) / e ELSE 0 END AS mean_count,
        CASE WHEN e <= 1 OR q * e = n * n THEN 1.0
             ELSE sqrt((CAST(q AS DOUBLE) - CAST(n AS DOUBLE) * n / e) / (e - 1)) END AS std_count
        FROM acc),
flags AS (SELECT src, dst, bucket, k AS count_in_window, (k - mean_count) / std_count AS z_score,
        CAST((SELECT min(timestamp) FROM ev) + (bucket + 1) * {window} AS BIGINT) AS flagged_at_time
        FROM eb JOIN moments USING (bucket) WHERE (k - mean_count) / std_count >= {ZSCORE})"""


def _chi(kind: str) -> str:
    a, s = f"{kind}_current", f"{kind}_total"
    d = f"({a} - CAST({s} AS DOUBLE) / tick)"
    return (
        f"CASE WHEN {s} > 0 AND tick > 1 AND {a} > 0 "
        f"THEN {d} * {d} * tick * tick / ({s} * (CAST(tick AS DOUBLE) - 1)) ELSE 0.0 END"
    )


def _fold_ctes(cfg: ScorerConfig, entities: str) -> str:
    """Counters before each (entity, tick), from ``ent(kind, key, tk, n)``."""
    return f"""
ranks AS (SELECT tk, row_number() OVER (ORDER BY tk) AS r FROM (SELECT DISTINCT tk FROM t)),
{entities},
seq AS (SELECT kind, key, tk, r, n, row_number() OVER (PARTITION BY kind, key ORDER BY r) AS i
        FROM ent JOIN ranks USING (tk)),
fold AS (
  SELECT kind, key, tk, i, r, n, CAST(0 AS BIGINT) AS cur0, CAST(0 AS BIGINT) AS tot0
  FROM seq WHERE i = 1
  UNION ALL
  SELECT s.kind, s.key, s.tk, s.i, s.r, s.n,
         CAST(list_reduce(range(0, s.r - f.r), lambda acc, x: floor(acc * {cfg.alpha}),
              CAST(f.cur0 + f.n AS DOUBLE)) AS BIGINT),
         CAST(f.tot0 + f.n AS BIGINT)
  FROM fold f JOIN seq s ON s.kind = f.kind AND s.key = f.key AND s.i = f.i + 1)"""


def _ticks(cfg: ScorerConfig) -> str:
    if cfg.order == "arrival":
        return f"""
t0 AS (SELECT *, greatest(1, greatest(0, timestamp - (SELECT arg_min(timestamp, event_id) FROM ev))
       // {cfg.tick_seconds} + 1) AS tick FROM ev),
t AS (SELECT *, max(tick) OVER (ORDER BY event_id) AS tk FROM t0)"""
    return f"""
t0 AS (SELECT *, greatest(1, (timestamp - (SELECT min(timestamp) FROM ev))
       // {cfg.tick_seconds} + 1) AS tick FROM ev),
t AS (SELECT *, tick AS tk FROM t0)"""


_ENTITIES = """ent AS (
  SELECT 'edge' AS kind, src || '>' || dst AS key, tk, count(*) AS n FROM t GROUP BY ALL
  UNION ALL SELECT 'src', src, tk, count(*) FROM t GROUP BY ALL
  UNION ALL SELECT 'dst', dst, tk, count(*) FROM t GROUP BY ALL)"""


def _score_ctes(events: str, cfg: ScorerConfig) -> str:
    order = "timestamp, event_id" if cfg.order == "event_time" else "event_id"
    parts = []
    for kind, key in (("edge", "src || '>' || dst"), ("src", "src"), ("dst", "dst")):
        parts.append(
            f"""{kind}_c AS (SELECT t.event_id, f.cur0 + j AS {kind}_current, f.tot0 + j AS {kind}_total
  FROM (SELECT event_id, tk, {key} AS key,
        row_number() OVER (PARTITION BY {key}, tk ORDER BY {order}) AS j FROM t) t
  JOIN fold f ON f.kind = '{kind}' AND f.key = t.key AND f.tk = t.tk)"""
        )
    return f"""{events},{_ticks(cfg)},{_fold_ctes(cfg, _ENTITIES)},
{', '.join(parts)},
counted AS (SELECT t.*, edge_current, edge_total, src_current, src_total, dst_current, dst_total
  FROM t JOIN edge_c USING (event_id) JOIN src_c USING (event_id) JOIN dst_c USING (event_id)),
{_scored(cfg)}"""


def _scored(cfg: ScorerConfig) -> str:
    return f"""chi AS (SELECT *, {_chi('edge')} AS edge_score, {_chi('src')} AS src_score,
  {_chi('dst')} AS dst_score FROM counted),
scored AS (SELECT *, greatest(edge_score, src_score, dst_score) AS score,
  greatest(edge_score, src_score, dst_score) >= {cfg.threshold} AS is_alert,
  CAST(edge_total AS DOUBLE) / tick AS expected_edge FROM chi)"""


def _sketch_ctes(events: str, cfg: ScorerConfig) -> str:
    rows = []
    for i, (kind, key) in enumerate((("edge", "src || '→' || dst"), ("src", "src"), ("dst", "dst"))):
        for r in range(i * cfg.depth, (i + 1) * cfg.depth):
            rows.append(
                f"SELECT event_id, timestamp, tk, '{kind}' AS kind, '{r}:' || (CAST('0x' || "
                f"substr(md5('{cfg.seed + r}:' || {key}), 1, 15) AS BIGINT) % {cfg.width}) AS key FROM t"
            )
    estimates = ", ".join(
        f"min(CASE WHEN c.kind = '{k}' THEN f.{c}0 + j END) AS {k}_{n}"
        for k in ("edge", "src", "dst")
        for c, n in (("cur", "current"), ("tot", "total"))
    )
    entities = "ent AS (SELECT kind, key, tk, count(*) AS n FROM cells GROUP BY ALL)"
    return f"""{events},{_ticks(cfg)},
cells AS ({' UNION ALL '.join(rows)}),{_fold_ctes(cfg, entities)},
placed AS (SELECT *, row_number() OVER (PARTITION BY kind, key, tk ORDER BY timestamp, event_id) AS j
  FROM cells),
est AS (SELECT c.event_id, {estimates}
  FROM placed c JOIN fold f ON f.kind = c.kind AND f.key = c.key AND f.tk = c.tk GROUP BY c.event_id),
counted AS (SELECT t.*, est.* EXCLUDE (event_id) FROM t JOIN est USING (event_id)),
{_scored(cfg)}"""


def _filtered_ctes(events: str, cfg: ScorerConfig, passes: int = 16) -> str:
    """Repeats the choice of filtered events often enough for it to settle.

    The current counters do not depend on it. A total is the number of earlier events that were kept,
    plus one.
    """
    unfiltered = _score_ctes(events, cfg)
    steps = ["s0 AS (SELECT * EXCLUDE (edge_total, src_total, dst_total), 1 AS k FROM counted)"]
    for i in range(1, passes + 1):
        totals = ", ".join(
            f"coalesce(sum(k) OVER (PARTITION BY {key} ORDER BY timestamp, event_id "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS {kind}_total"
            for kind, key in (("edge", "src, dst"), ("src", "src"), ("dst", "dst"))
        )
        chis = ", ".join(f"{_chi(kind)} AS {kind}_score" for kind in ("edge", "src", "dst"))
        gone = "edge_total, src_total, dst_total, edge_score, src_score, dst_score, score"
        source = f"s{i - 1}" if i == 1 else f"(SELECT * EXCLUDE ({gone}) FROM s{i - 1})"
        steps.append(f"p{i} AS (SELECT * EXCLUDE (k), {totals} FROM {source})")
        steps.append(f"c{i} AS (SELECT *, {chis} FROM p{i})")
        steps.append(
            f"s{i} AS (SELECT *, greatest(edge_score, src_score, dst_score) AS score, CASE WHEN "
            f"greatest(edge_score, src_score, dst_score) > {cfg.filter_cutoff} THEN 0 ELSE 1 END AS k "
            f"FROM c{i})"
        )
    return f"""{unfiltered}, {', '.join(steps)},
settled AS (SELECT *, score >= {cfg.threshold} AS is_alert,
  CAST(edge_total AS DOUBLE) / tick AS expected_edge FROM s{passes})"""


def _score_select(label: bool, source: str = "scored") -> str:
    return f"""SELECT round(score, 6) AS score, is_alert, timestamp, round(edge_score, 6) AS edge_score,
 round(src_score, 6) AS src_score, round(dst_score, 6) AS dst_score,
 CAST(edge_current AS BIGINT) AS edge_current, CAST(edge_total AS BIGINT) AS edge_total,
 CAST(src_current AS BIGINT) AS src_current, CAST(src_total AS BIGINT) AS src_total,
 CAST(dst_current AS BIGINT) AS dst_current, CAST(dst_total AS BIGINT) AS dst_total,
 CAST(tick AS BIGINT) AS tick, round(expected_edge, 6) AS expected_edge, src, dst,
 event_id{', label' if label else ''} FROM {source}"""


_UUID = (
    "regexp_replace(md5('edges|' || event_id), "
    "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"
)

_RAW_LABEL = """CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN 'Heartbleed'
  WHEN l_returnflag = 'N' THEN ' BENIGN ' WHEN l_returnflag = 'A' THEN 'DDOS' ELSE 'port scan' END"""
_LABEL_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in LABEL_CLASSES.items()) + "}"
_CLASSED = f"""classed AS (SELECT *, coalesce({_LABEL_MAP}[trim({_RAW_LABEL})], 'Benign') AS attack_type
  FROM lineitem)"""

_FLOWS = """flows AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'Benign' WHEN 'A' THEN 'DDoS' ELSE 'PortScan' END AS attack_type,
         l_quantity AS quantity,
         CASE WHEN l_orderkey % 19 > 0 THEN l_extendedprice END AS extendedprice,
         l_discount AS discount, l_tax AS tax FROM lineitem)"""
_CELLS = "cells AS (" + " UNION ALL ".join(
    f"SELECT attack_type, '{f}' AS feature, {i + 1} AS pos, {f} AS value FROM flows WHERE {f} IS NOT NULL"
    for i, f in enumerate(FEATURES)
) + ")"
_FILLED = """filled AS (SELECT attack_type, quantity,
  coalesce(extendedprice, (SELECT quantile_cont(extendedprice, 0.5) FROM flows)) AS extendedprice,
  discount, tax FROM flows)"""
_FILLED_CELLS = "cells AS (" + " UNION ALL ".join(
    f"SELECT attack_type, '{f}' AS feature, {i + 1} AS pos, {f} AS value FROM filled"
    for i, f in enumerate(FEATURES)
) + ")"
_SIDES = """sides AS (SELECT attack_type, feature, any_value(pos) AS pos, count(*) AS n,
  quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr,
  max(value) - min(value) AS span FROM cells GROUP BY attack_type, feature)"""
_DELTAS = """vc AS (SELECT feature, value, attack_type, count(*) AS n FROM cells GROUP BY ALL),
bc AS (SELECT feature, value, sum(CASE WHEN attack_type = 'Benign' THEN n ELSE 0 END) AS b
       FROM vc GROUP BY ALL),
cum AS (SELECT feature, value, b, sum(b) OVER (PARTITION BY feature ORDER BY value) AS upto,
        sum(b) OVER (PARTITION BY feature) AS total FROM bc),
deltas AS (SELECT attack_type, feature,
        CAST(sum(n * ((total - upto) - (upto - b))) AS DOUBLE) / max(total) / sum(n) AS cliff_delta
        FROM vc JOIN cum USING (feature, value) WHERE attack_type <> 'Benign'
        GROUP BY attack_type, feature)"""
_STATS = f"""{_FLOWS}, {_CELLS}, {_SIDES}, {_DELTAS},
stats AS (SELECT a.attack_type, a.feature, a.pos, b.med AS benign_median, b.iqr AS benign_iqr,
  a.med AS attack_median, a.iqr AS attack_iqr, cliff_delta,
  CASE WHEN greatest(a.span, b.span) > 0 THEN abs(a.med - b.med) / greatest(a.span, b.span)
       ELSE 0.0 END AS discrimination
  FROM sides a JOIN sides b ON b.feature = a.feature AND b.attack_type = 'Benign'
  JOIN deltas d ON d.attack_type = a.attack_type AND d.feature = a.feature
  WHERE a.attack_type <> 'Benign')"""


def _correlations() -> str:
    rows = [
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS correlation FROM filled"
        for a in FEATURES
        for b in FEATURES
    ]
    return f"WITH {_FLOWS}, {_FILLED} " + " UNION ALL ".join(rows)


def _cell_rows(cfg: ScorerConfig, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {r} AS row, CAST('0x' || substr(md5('{cfg.seed + r}:' || src), 1, 15) AS BIGINT) "
        f"% {cfg.width} AS col, src FROM {source}"
        for r in range(cfg.depth)
    )


#: The trees that separate the classes of the tree flows, read from the data's own neighbouring values.
_TREE_FLOWS = """flows AS (SELECT CASE WHEN quantity > 40 AND discount > 5 THEN 'DDoS'
    WHEN tax > 6 THEN 'PortScan' ELSE 'Benign' END AS attack_type, * FROM (
  SELECT l_quantity AS quantity, l_extendedprice AS extendedprice, round(l_discount * 100) AS discount,
         round(l_tax * 100) AS tax FROM lineitem))"""
_TREE_RULES = f"""WITH {_TREE_FLOWS}, cuts AS (SELECT
  (max(quantity) FILTER (quantity <= 40) + min(quantity) FILTER (quantity > 40)) / 2 AS quantity,
  (max(discount) FILTER (discount <= 5) + min(discount) FILTER (discount > 5)) / 2 AS discount,
  (max(tax) FILTER (tax <= 6) + min(tax) FILTER (tax > 6)) / 2 AS tax FROM flows),
splits AS (SELECT 'DDoS' AS attack_type, 0 AS place, 'quantity' AS feature, quantity AS threshold FROM cuts
  UNION ALL SELECT 'DDoS', 1, 'discount', discount FROM cuts
  UNION ALL SELECT 'PortScan', 0, 'tax', tax FROM cuts
  UNION ALL SELECT 'PortScan', 1, 'quantity', quantity FROM cuts
  UNION ALL SELECT 'PortScan', 2, 'discount', discount FROM cuts)
SELECT attack_type, CAST(2 * place + side AS INT) AS position, feature, round(threshold, 6) AS threshold,
  CASE side WHEN 0 THEN '<=' ELSE '>' END AS direction
FROM splits, (SELECT unnest([0, 1]) AS side)"""
_TREE_METRICS = f"""WITH {_TREE_FLOWS} SELECT attack_type, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision,
  1.0::DOUBLE AS recall FROM flows WHERE attack_type <> 'Benign' GROUP BY attack_type"""


def _tree_ctes(depth: int = 3, min_leaf: int = 10) -> str:
    """``nodes(attack_type, node, n, p, feature, place, threshold)`` of trees by exhaustive search."""
    purity = "(({p}) * ({p}) + (({n}) - ({p})) * (({n}) - ({p})))::DOUBLE / ({n})"
    sides = [purity.format(n=n, p=p) for n, p in (("n", "p"), ("all_n - n", "all_p - p"))]
    ctes = ["""flows AS (SELECT row_number() OVER () AS id, CASE WHEN l_extendedprice > 38000 + 260000 * l_discount THEN 'DDoS'
    WHEN l_extendedprice < 4000 + 50000 * l_tax THEN 'PortScan' ELSE 'Benign' END AS kind, l_quantity AS quantity,
  l_extendedprice AS extendedprice, l_discount AS discount, l_tax AS tax FROM lineitem)"""]
    cells = " UNION ALL ".join(f"SELECT id, kind, {i} AS place, '{f}' AS feature, {f} AS value FROM flows" for i, f in enumerate(FEATURES))
    ctes += [
        f"cells AS MATERIALIZED ({cells})",
        """attacks AS (SELECT kind AS attack_type FROM flows WHERE kind <> 'Benign' GROUP BY kind HAVING count(*) >= 20)""",
        "at0 AS (SELECT id, attack_type, 1 AS node FROM flows, attacks)",
    ]
    for level in range(depth):
        ctes += [
            f"""counted{level} AS (SELECT attack_type, node, place, feature, value, count(*) AS own,
  count(*) FILTER (kind = attack_type) AS hits FROM at{level} JOIN cells USING (id) GROUP BY ALL)""",
            f"""cuts{level} AS (SELECT *, lead(value) OVER up AS after, sum(own) OVER up AS n, sum(hits) OVER up AS p,
  sum(own) OVER whole AS all_n, sum(hits) OVER whole AS all_p FROM counted{level}
  WINDOW whole AS (PARTITION BY attack_type, node, place),
  up AS (PARTITION BY attack_type, node, place ORDER BY value ROWS UNBOUNDED PRECEDING))""",
            f"""best{level} AS MATERIALIZED (SELECT * FROM cuts{level} WHERE n >= {min_leaf} AND all_n - n >= {min_leaf}
  AND p * all_n <> all_p * n AND after IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY attack_type, node ORDER BY {sides[0]} + {sides[1]} DESC, place, value) = 1)""",
            f"""at{level + 1} AS (SELECT a.id, a.attack_type,
  CASE WHEN c.value <= (b.value + b.after) / 2 THEN 2 * a.node ELSE 2 * a.node + 1 END AS node FROM at{level} a
  JOIN best{level} b USING (attack_type, node) JOIN cells c ON c.id = a.id AND c.place = b.place)""",
        ]
    every = " UNION ALL ".join(f"SELECT * FROM at{level}" for level in range(depth + 1))
    split = " UNION ALL ".join(f"SELECT attack_type, node, feature, (value + after) / 2 AS threshold FROM best{level}" for level in range(depth))
    ctes += [
        f"""sizes AS (SELECT attack_type, node, count(*) AS n, count(*) FILTER (kind = attack_type) AS p
  FROM ({every}) JOIN flows USING (id) GROUP BY ALL)""",
        f"nodes AS (SELECT * FROM sizes LEFT JOIN ({split}) USING (attack_type, node))",
    ]
    return ",\n".join(ctes)


_TREE_SEARCH = {
    "decision_tree_nodes": f"""WITH {_tree_ctes()} SELECT attack_type, CAST(node AS INT) AS node, n AS rows, p AS positives,
  feature, round(threshold, 6) AS threshold FROM nodes""",
    "decision_tree_importances": f"""WITH {_tree_ctes()},
pure AS (SELECT *, (p * p + (n - p) * (n - p))::DOUBLE / n AS purity FROM nodes),
gains AS (SELECT a.attack_type, a.feature, sum(l.purity + r.purity - a.purity) AS gain FROM pure a
  JOIN pure l ON l.attack_type = a.attack_type AND l.node = 2 * a.node
  JOIN pure r ON r.attack_type = a.attack_type AND r.node = 2 * a.node + 1 GROUP BY ALL),
used AS (SELECT attack_type, unnest({FEATURES!r}) AS feature FROM attacks)
SELECT attack_type, feature, round(coalesce(gain, 0) / sum(gain) OVER (PARTITION BY attack_type), 6) AS importance
FROM used LEFT JOIN gains USING (attack_type, feature)""",
}


def _live_ctes(alerts: str, keys: str, limit: int) -> str:
    """``held(keys, scores)``: what a display shows after hourly flushes, replayed one after another."""
    return f"""flushes AS (SELECT timestamp // {HOUR} AS flush, {keys}, arg_max(score, (timestamp, event_id)) AS score
  FROM {alerts} GROUP BY ALL),
steps AS (SELECT row_number() OVER (ORDER BY flush) AS step, list([src, dst] ORDER BY place) AS came,
  list(score ORDER BY place) AS news FROM flushes GROUP BY flush),
shown AS (SELECT 0::BIGINT AS step, []::VARCHAR[][] AS keys, []::DOUBLE[] AS scores
  UNION ALL SELECT step, list_slice(k, greatest(len(k) - {limit}, 0) + 1, len(k)), list_slice(s, greatest(len(s) - {limit}, 0) + 1, len(s))
  FROM (SELECT step, k, list_transform(k, lambda x: coalesce(news[list_position(came, x)], scores[list_position(keys, x)])) AS s
    FROM (SELECT steps.step, came, news, keys, scores,
        list_concat(keys, list_filter(came, lambda x: list_position(keys, x) IS NULL)) AS k
      FROM shown JOIN steps ON steps.step = shown.step + 1))),
held AS (SELECT keys, scores FROM shown ORDER BY step DESC LIMIT 1)"""


def _quality_ctes(key: str, epsilon: float) -> str:
    """``<key>_quality``: estimates of all keys beside their true counts."""
    cells = _cell_rows(SMALL_SKETCH, f"(SELECT {key} AS src FROM keyed)")
    return f"""{key}_hits AS ({cells}), {key}_sums AS (SELECT row, col, count(*) AS cnt FROM {key}_hits GROUP BY ALL),
{key}_estimates AS (SELECT src, min(cnt) AS estimate FROM (SELECT DISTINCT row, col, src FROM {key}_hits)
  JOIN {key}_sums USING (row, col) GROUP BY src),
{key}_counts AS (SELECT {key} AS src, count(*) AS cnt FROM keyed GROUP BY ALL),
{key}_quality AS (SELECT '{key}' AS key, count(*) AS keys, CAST(sum(cnt) AS BIGINT) AS items,
  count(*) FILTER (estimate < cnt) AS underestimated, max(estimate - cnt) AS largest_overestimate,
  count(*) FILTER (estimate - cnt > {epsilon!r}::DOUBLE * (SELECT count(*) FROM keyed)) AS beyond_bound
  FROM {key}_counts JOIN {key}_estimates USING (src))"""


def _read_back_sql(score: str) -> dict[str, str]:
    """SQL of the tables that are written and read back."""
    edges_read = f"WITH {_EV} SELECT src, dst, timestamp, label FROM ev"
    epsilon, delta = math.e / SMALL_SKETCH.width, math.exp(-SMALL_SKETCH.depth)
    scores = f"""WITH RECURSIVE {score} SELECT event_id AS id, src, dst, timestamp AS event_time,
  round(score, 6) AS anomaly_score, is_alert, label"""
    return {
        "headed_edges": edges_read,
        "headerless_edges": edges_read,
        "quarantined_edges": f"{edges_read} WHERE event_id % 50 NOT IN (1, 2)",
        "malformed_lines": f"""WITH {_EV} SELECT CASE event_id % 50 WHEN 1 THEN src || ',' || dst
  ELSE src || ',' || dst || ',soon,' || label END AS line FROM ev WHERE event_id % 50 IN (1, 2)""",
        "quarantined_messages": f"""WITH {_EV} SELECT src, dst, timestamp, label, event_id FROM ev
WHERE event_id % 40 <> 0""",
        "malformed_messages": f"""WITH {_EV} SELECT substr('{{"src":"' || src || '","dst":"' || dst, 1, 20) AS value,
  event_id FROM ev WHERE event_id % 40 = 0""",
        "stacked_flow_files": "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem",
        "stored_flows": f"WITH {_FLOWS} SELECT * FROM flows",
        "stored_scores": f"""{scores}, timestamp + event_id % 7 AS ingested_at,
  strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS event_date, 3 AS batch_id FROM scored""",
        "streamed_scores": f"{scores} FROM scored",
        "watermarked_scores": f"""WITH RECURSIVE {_LATE.replace("ev AS", "came AS", 1)},
cut AS (SELECT *, (event_id - (SELECT min(event_id) FROM came)) // ((SELECT max(event_id) - min(event_id) FROM came)
  // {STREAM_BATCHES} + 1) AS part FROM came),
marks AS (SELECT part, max(max(timestamp)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - {HOUR} AS mark FROM cut GROUP BY part),
timed AS (SELECT cut.*, coalesce(timestamp < mark, false) AS late FROM cut JOIN marks USING (part)),
{_score_ctes("ev AS (SELECT * FROM timed WHERE NOT late)", LATE_ORDER)}
SELECT event_id AS id, timestamp AS event_time, round(score, 6) AS anomaly_score, false AS late FROM scored
UNION ALL SELECT event_id, timestamp, NULL, true FROM timed WHERE late""",
        "entity_clock_counts": f"""WITH {_EV},
gaps AS (SELECT *, coalesce(timestamp - lag(timestamp) OVER own > {FORGET}, false) AS fresh FROM ev
  WINDOW own AS (PARTITION BY src, dst ORDER BY timestamp, event_id)),
lives AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY src, dst ORDER BY timestamp, event_id) AS life FROM gaps),
placed AS (SELECT *, row_number() OVER own AS total, (timestamp - min(timestamp) OVER own) // {SELECTIVE.tick_seconds} + 1 AS ticks
  FROM lives WINDOW own AS (PARTITION BY src, dst, life ORDER BY timestamp, event_id)),
summed AS (SELECT a.event_id, a.total, a.ticks, sum(pow({SELECTIVE.alpha}::DOUBLE, (a.timestamp - b.timestamp)::DOUBLE / {SELECTIVE.tick_seconds})) AS cur
  FROM placed a JOIN placed b ON a.src = b.src AND a.dst = b.dst AND a.life = b.life AND b.total <= a.total GROUP BY ALL)
SELECT event_id, round(cur, 6) AS current, total, ticks AS age_ticks, round(CASE WHEN ticks > 1 THEN (cur - total / ticks)
  * (cur - total / ticks) * ticks * ticks / (total * (ticks - 1)) ELSE 0 END, 6) AS score FROM summed""",
        "logged_scores": f"""WITH RECURSIVE {_EV.replace("ev AS", "came AS", 1)},
{_score_ctes(f"ev AS (SELECT * REPLACE (event_id % {LOG_PARTITIONS} * 281474976710656 + event_id AS event_id) FROM came)", SELECTIVE)}
SELECT src, dst, timestamp AS event_time, round(score, 6) AS anomaly_score, is_alert, label FROM scored""",
        "report_file": f"WITH {_FLOWS} SELECT attack_type, count(*) AS rows FROM flows GROUP BY attack_type",
        "without_test_rows": f"WITH {_EV} SELECT * FROM ev WHERE event_id % 10 <> 0",
        "sketch_bound": f"""WITH {_EV}, keyed AS (SELECT *, src || '>' || dst AS edge FROM ev),
{_quality_ctes("src", epsilon)}, {_quality_ctes("edge", epsilon)}
SELECT *, round({epsilon!r}::DOUBLE, 6) AS epsilon, round({delta!r}::DOUBLE, 6) AS delta,
  round({epsilon!r}::DOUBLE * items, 6) AS bound FROM (SELECT * FROM src_quality UNION ALL SELECT * FROM edge_quality)""",
        "decision_tree_rules": _TREE_RULES,
        "decision_tree_metrics": _TREE_METRICS,
        "trees_with_nan": _TREE_METRICS,
        **_TREE_SEARCH,
    }


def oracle_sql() -> dict[str, str]:
    base = _baseline_ctes(_EV, DAY)
    score = _score_ctes(_EV, SELECTIVE)
    cells = f"WITH {_EV}, hits AS ({_cell_rows(SMALL_SKETCH, 'ev')})"
    alerts = f"WITH RECURSIVE {score}, alerts AS (SELECT *, {_UUID} AS alert_id FROM scored WHERE is_alert)"
    judged = f"""WITH RECURSIVE {score}, per AS (SELECT round(score, 6) AS score, count(*) AS n, count(*) FILTER (label = 1) AS p
  FROM scored WHERE label IS NOT NULL GROUP BY ALL),
summed AS (SELECT *, CAST(sum(n) OVER down AS BIGINT) AS flagged, CAST(sum(p) OVER down AS BIGINT) AS true_positives,
  coalesce(sum(n - p) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per
  WINDOW down AS (ORDER BY score DESC))"""
    first_seen = """fe AS (SELECT src, dst, arg_max(score, (timestamp, event_id)) AS score,
  count(*) AS alerts, min((timestamp, event_id)) AS tk FROM alerts GROUP BY src, dst)"""

    def graph_nodes(node_limit: str, edge_limit: str) -> str:
        return f"""{alerts}, {first_seen},
ends AS (SELECT src AS node, (tk[1], tk[2], 0) AS place FROM fe
  UNION ALL SELECT dst, (tk[1], tk[2], 1) FROM fe),
nodes AS (SELECT node, min(place) AS place FROM ends GROUP BY node ORDER BY place DESC {node_limit}),
ve AS (SELECT src, dst FROM fe ORDER BY tk DESC {edge_limit}),
deg AS (SELECT node, sum(o) AS o, sum(i) AS i FROM (
  SELECT src AS node, 1 AS o, 0 AS i FROM ve UNION ALL SELECT dst, 0, 1 FROM ve) GROUP BY node)
SELECT node, CAST(coalesce(o, 0) AS BIGINT) AS out_degree, CAST(coalesce(i, 0) AS BIGINT) AS in_degree,
  CAST(coalesce(o, 0) + coalesce(i, 0) AS BIGINT) AS degree,
  CASE WHEN coalesce(o, 0) > coalesce(i, 0) + 1 THEN 'source'
       WHEN coalesce(i, 0) > coalesce(o, 0) + 1 THEN 'sink' ELSE 'balanced' END AS role,
  o IS NOT NULL AS alerted
FROM nodes LEFT JOIN deg USING (node)"""

    def graph_edges(limit: str) -> str:
        return f"""{alerts}, {first_seen}
SELECT src AS source, dst AS target, round(score, 6) AS score, CAST(alerts AS BIGINT) AS alerts
FROM fe ORDER BY tk DESC {limit}"""

    sql = {
        "edge_bucket_counts": f"WITH {base} SELECT bucket, src, dst, k AS count_in_window FROM eb",
        "history_moments": f"""WITH {base} SELECT bucket, history_events, history_edges,
  round(mean_count, 6) AS mean_count, round(std_count, 6) AS std_count FROM moments""",
        "batch_zscore": f"""WITH {base} SELECT src, dst, bucket, count_in_window,
  round(z_score, 6) AS z_score, flagged_at_time FROM flags""",
        "sparse_zscore": f"""WITH {_baseline_ctes(_SHIP, 30 * DAY)} SELECT src, dst, bucket,
  count_in_window, round(z_score, 6) AS z_score, flagged_at_time FROM flags""",
        "flag_totals": f"""WITH {base} SELECT (SELECT count(DISTINCT bucket) FROM eb) AS windows,
  count(*) AS flagged_events, count(DISTINCT (src, dst)) AS flagged_edges FROM flags""",
        "truth_edges": f"WITH {_EV} SELECT DISTINCT src, dst FROM ev WHERE label = 1",
        "caught_edges": f"""WITH {base} SELECT src, dst FROM ev WHERE label = 1
  INTERSECT SELECT src, dst FROM flags""",
        "batch_eval": f"""WITH {base},
truth AS (SELECT DISTINCT src, dst FROM ev WHERE label = 1),
flagged AS (SELECT DISTINCT src, dst FROM flags),
n AS (SELECT (SELECT count(*) FROM flagged) AS f, (SELECT count(*) FROM truth) AS t,
      (SELECT count(*) FROM (FROM truth INTERSECT FROM flagged)) AS tp)
SELECT 'batch' AS method, f AS flagged_edges, t AS true_edges, tp AS true_positives,
  CASE WHEN f > 0 THEN round(tp / f, 6) ELSE 0 END AS precision,
  CASE WHEN t > 0 THEN round(tp / t, 6) ELSE 0 END AS recall FROM n""",
        "method_comparison": f"""WITH RECURSIVE {score},
{base[len(_EV) + 2:]},
truth AS (SELECT DISTINCT src, dst FROM ev WHERE label = 1),
raised AS (SELECT 'batch' AS method, src, dst, CAST(NULL AS DOUBLE) AS delay FROM flags
  UNION ALL SELECT 'streaming', src, dst, CAST(event_id % 7 AS DOUBLE) FROM scored WHERE is_alert),
per AS (SELECT method, count(*) AS flagged_events, count(DISTINCT (src, dst)) AS f,
  count(DISTINCT CASE WHEN (src, dst) IN (SELECT (src, dst) FROM truth) THEN (src, dst) END) AS tp,
  max(delay) AS max_delay, avg(delay) AS avg_delay FROM raised GROUP BY method)
SELECT method, f AS flagged_edges, (SELECT count(*) FROM truth) AS true_edges, tp AS true_positives,
  round(tp / f, 6) AS precision, round(tp / (SELECT count(*) FROM truth), 6) AS recall,
  flagged_events, round(max_delay, 6) AS max_detection_delay,
  round(avg_delay, 6) AS avg_detection_delay FROM per""",
        "tick_assign": f"""WITH {_EV},{_ticks(SELECTIVE)}
SELECT event_id, timestamp, CAST(tick AS BIGINT) AS tick FROM t""",
        "chi_squared": f"""WITH RECURSIVE {_score_ctes(_EV, SLOW_DECAY)}
SELECT event_id, CAST(edge_current AS BIGINT) AS edge_current, CAST(edge_total AS BIGINT) AS edge_total,
  CAST(tick AS BIGINT) AS tick, round(edge_score, 6) AS edge_score FROM scored""",
        "midas_score": f"WITH RECURSIVE {score} {_score_select(True)}",
        "midas_score_slow_decay": f"WITH RECURSIVE {_score_ctes(_EV, SLOW_DECAY)} {_score_select(True)}",
        "midas_score_sparse": f"WITH RECURSIVE {_score_ctes(_SHIP, DAILY)} {_score_select(False)}",
        "midas_score_late": "WITH RECURSIVE "
        + _score_ctes(
            _LATE, ScorerConfig(tick_seconds=HOUR, alpha=0.5, threshold=80.0, order="arrival")
        )
        + " " + _score_select(True),
        "midas_sketch_score": f"WITH RECURSIVE {_sketch_ctes(_EV, SKETCHED)} {_score_select(True)}",
        "midas_f_score": f"WITH RECURSIVE {_filtered_ctes(_EV, FILTERED)} "
        + _score_select(True, "settled"),
        "cms_cells": f"""{cells} SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col,
  count(*) AS cnt FROM hits GROUP BY ALL""",
        "cms_estimate": f"""{cells},
sums AS (SELECT row, col, count(*) AS cnt FROM hits GROUP BY ALL)
SELECT src, min(cnt) AS estimate FROM (SELECT DISTINCT row, col, src FROM hits)
JOIN sums USING (row, col) GROUP BY src""",
        "cms_merge_decay": f"""{cells} SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col,
  CAST(floor(count(*) * 0.9::DOUBLE) AS BIGINT) AS cnt FROM hits GROUP BY row, col""",
        "score_stats": f"""WITH RECURSIVE {score}
SELECT count(*) AS total_events, count(*) FILTER (is_alert) AS total_alerts,
  round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, round(avg(score), 6) AS avg_score,
  round(max(CAST(event_id % 7 AS DOUBLE)) FILTER (is_alert), 6) AS max_detection_delay,
  round(avg(CAST(event_id % 7 AS DOUBLE)) FILTER (is_alert), 6) AS avg_detection_delay FROM scored""",
        "scores_table": f"""WITH RECURSIVE {score} SELECT event_id AS id, src, dst,
  timestamp AS event_time, round(score, 6) AS anomaly_score, is_alert, label,
  timestamp + event_id % 7 AS ingested_at FROM scored""",
        "alerts_table": f"""{alerts} SELECT alert_id, src, dst, timestamp AS event_time,
  round(score, 6) AS score, src || ',' || dst AS subgraph_nodes FROM alerts""",
        "alert_messages": f"""{alerts} SELECT alert_id, 'alert' AS type, src, dst, timestamp,
  round(score, 6) AS score, src || ',' || dst AS subgraph_nodes FROM alerts""",
        "alert_rate": f"""{alerts}, s AS (SELECT timestamp AS second, count(*) AS n FROM alerts GROUP BY ALL)
SELECT a.second, CAST(sum(b.n) AS BIGINT) AS alerts FROM s a JOIN s b
ON b.second BETWEEN a.second - 1 AND a.second GROUP BY a.second""",
        "live_graph_edges": f"""{alerts}, {_live_ctes("alerts", "src, dst, min((timestamp, event_id)) AS place", monitor.VISIBLE_EDGES)}
SELECT CAST(spot - 1 AS INT) AS place, keys[spot][1] AS source, keys[spot][2] AS target, round(scores[spot], 6) AS score
FROM held, unnest(range(1, len(keys) + 1)) AS u(spot)""",
        "live_graph_nodes": f"""{alerts}, ends AS (SELECT event_id, timestamp, score, src AS node, 0 AS side FROM alerts
  UNION ALL SELECT event_id, timestamp, score, dst, 1 FROM alerts),
{_live_ctes("ends", "node AS src, '' AS dst, min((timestamp, event_id, side)) AS place", monitor.VISIBLE_NODES)}
SELECT CAST(spot - 1 AS INT) AS place, keys[spot][1] AS node FROM held, unnest(range(1, len(keys) + 1)) AS u(spot)""",
        "threshold_curve": f"""{judged}
SELECT score AS threshold, flagged, true_positives, round(true_positives / flagged, 6) AS precision,
  round(true_positives / (SELECT sum(p) FROM per), 6) AS recall FROM summed""",
        "score_separation": f"""{judged}, whole AS (SELECT sum(p) AS positives, sum(n - p) AS negatives FROM per)
SELECT CAST(any_value(positives) AS BIGINT) AS positives, CAST(any_value(negatives) AS BIGINT) AS negatives,
  round(sum(p * (below + (n - p) / 2)) / any_value(positives) / any_value(negatives), 6) AS auc,
  round(sum(p * true_positives / flagged) / any_value(positives), 6) AS average_precision FROM summed, whole""",
        "compacted_alerts": f"""{alerts} SELECT alert_id, src, dst, timestamp AS event_time,
  round(score, 6) AS score, src || ',' || dst AS subgraph_nodes FROM alerts
WHERE timestamp // {DAY} <= (SELECT (min(timestamp) + max(timestamp)) // 2 FROM ev) // {DAY}""",
        "streamed_alert_rate": f"""{alerts}, s AS (SELECT timestamp AS second, count(*) AS n FROM alerts GROUP BY ALL)
SELECT a.second, CAST(sum(b.n) AS BIGINT) AS alerts FROM s a JOIN s b
ON b.second BETWEEN a.second - 1 AND a.second GROUP BY a.second""",
        "alert_feed": f"""{alerts} SELECT alert_id, src, dst, round(score, 6) AS score, event_id
FROM alerts ORDER BY timestamp DESC, event_id DESC LIMIT {monitor.FEED_SIZE}""",
        "alert_graph_edges": graph_edges(f"LIMIT {monitor.VISIBLE_EDGES}"),
        "alert_graph_edges_all": graph_edges(""),
        "alert_graph_nodes": graph_nodes(
            f"LIMIT {monitor.VISIBLE_NODES}", f"LIMIT {monitor.VISIBLE_EDGES}"
        ),
        "alert_graph_nodes_all": graph_nodes("", ""),
        "positional_label_join": """SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_idx, event_id,
  user_id, CAST(value >= 100 AS SMALLINT) AS label FROM events""",
        "replay_timeline": """SELECT row_idx, event_id, 1700000000 + row_idx // 100 AS timestamp FROM (
  SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_idx, event_id FROM events)""",
        "replay_events_json": """SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_idx,
  'u' || user_id AS src, CASE WHEN event_type <> 'error' THEN event_type ELSE '0.0.0.0' END AS dst,
  1700000000 + (row_number() OVER (ORDER BY event_id) - 1) // 100 AS timestamp,
  CAST(value >= 100 AS INT) AS label, CASE WHEN value >= 100 THEN 'DDoS' ELSE 'Benign' END AS attack_type,
  value AS "Flow Duration", CASE WHEN user_id > 5 THEN CAST(user_id AS DOUBLE) END AS "Flow Bytes/s",
  CAST(NULL AS VARCHAR) AS Protocol FROM events""",
        "replay_events": """SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_idx,
  'u' || user_id AS src, CASE WHEN event_type <> 'error' THEN event_type ELSE '0.0.0.0' END AS dst,
  CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, CAST(value >= 100 AS INT) AS label,
  CASE WHEN value >= 100 THEN 'DDoS' ELSE 'Benign' END AS attack_type, value AS flow_duration,
  CAST(CASE WHEN user_id > 5 THEN 2 ELSE 1 END AS BIGINT) AS n_features FROM events""",
        "sample_per_group": """SELECT event_id, event_type FROM (SELECT event_id, event_type,
  row_number() OVER (PARTITION BY event_type ORDER BY
    CAST('0x' || substr(md5('42:' || event_id), 1, 15) AS BIGINT), event_id) AS i FROM events)
WHERE i <= 5""",
        "label_normalize": f"""WITH {_CLASSED} SELECT l_orderkey, l_partkey, l_linenumber,
  attack_type AS "Label", attack_type <> 'Benign' AS is_attack, attack_type FROM classed""",
        "unknown_labels": f"""WITH l AS (SELECT trim({_RAW_LABEL}) AS label FROM lineitem)
SELECT label, count(*) AS rows FROM l WHERE {_LABEL_MAP}[label] IS NULL GROUP BY label""",
        "median_impute": """WITH raw AS (SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS a,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS b,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_tax END AS c FROM lineitem),
m AS (SELECT quantile_cont(a, 0.5) AS a, quantile_cont(b, 0.5) AS b, quantile_cont(c, 0.5) AS c FROM raw)
SELECT l_orderkey, l_partkey, l_linenumber, coalesce(a, (SELECT a FROM m)) AS "Flow Duration",
  coalesce(b, (SELECT b FROM m)) AS "Total Fwd Packets", coalesce(c, (SELECT c FROM m)) AS "Flow Bytes/s"
FROM raw""",
        "parse_timestamps": """WITH x AS (SELECT event_id, CASE event_id % 5
  WHEN 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S') WHEN 1 THEN strftime(ts, '%d/%m/%Y %I:%M:%S %p')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d %I:%M:%S %p')
  ELSE strftime(ts, '%Y%m%d') END AS s FROM events)
SELECT event_id, CAST(epoch(try_strptime(s, ['%d/%m/%Y %H:%M:%S', '%d/%m/%Y %I:%M:%S %p',
  '%Y-%m-%d %H:%M:%S', '%Y-%m-%d %I:%M:%S %p'])) AS BIGINT) AS parsed FROM x""",
        "dedupe_keep_first": """SELECT l_returnflag, l_linestatus, l_quantity, l_tax, l_discount,
  CAST(arg_min(epoch(l_shipdate), (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice))
    AS BIGINT) AS "Timestamp"
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity, l_tax, l_discount""",
        "class_counts": f"WITH {_CLASSED} SELECT attack_type, count(*) AS rows FROM classed GROUP BY 1",
        "dataset_summary": f"""WITH {_CLASSED} SELECT count(*) AS total_rows,
  count(*) FILTER (attack_type = 'Benign') AS benign_rows,
  count(*) FILTER (attack_type <> 'Benign') AS attack_rows,
  count(*) FILTER (attack_type = 'DDoS') AS ddos, count(*) FILTER (attack_type = 'PortScan') AS port_scan,
  3 AS numeric_columns, 1 AS files_loaded FROM classed""",
        "quantiles": f"""WITH {_FLOWS}, {_CELLS} SELECT attack_type, feature, count(*) AS n,
  round(min(value), 6) AS low, round(max(value), 6) AS high, round(quantile_cont(value, 0.25), 6) AS q0,
  round(quantile_cont(value, 0.5), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q2
FROM cells GROUP BY attack_type, feature""",
        "feature_statistics": f"""WITH {_STATS} SELECT attack_type, feature,
  round(benign_median, 6) AS benign_median, round(benign_iqr, 6) AS benign_iqr,
  round(attack_median, 6) AS attack_median, round(attack_iqr, 6) AS attack_iqr,
  round(cliff_delta, 6) AS cliff_delta, round(discrimination, 6) AS discrimination FROM stats""",
        "sketched_medians": f"""WITH {_FLOWS}, {_CELLS} SELECT attack_type, feature, count(*) AS n, true AS near
FROM cells GROUP BY ALL""",
        "cliffs_delta": f"""WITH {_FLOWS}, {_CELLS}, {_DELTAS}
SELECT attack_type, feature, round(cliff_delta, 6) AS cliff_delta FROM deltas""",
        "feature_importance": f"""WITH {_FLOWS}, {_FILLED}, {_FILLED_CELLS},
cuts AS (SELECT feature, list_distinct(quantile_cont(value, [0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS e
  FROM cells GROUP BY feature),
binned AS (SELECT attack_type, feature, pos,
  greatest(0, len(list_filter(e, lambda x: x < value)) - 1) AS bin FROM cells JOIN cuts USING (feature)),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM filled),
y AS (SELECT DISTINCT attack_type AS a FROM filled WHERE attack_type <> 'Benign'),
j AS (SELECT a, feature, any_value(pos) AS pos, bin, attack_type = a AS hit, count(*) / any_value(n) AS p
  FROM binned, y, total GROUP BY a, feature, bin, hit),
hj AS (SELECT a, feature, any_value(pos) AS pos, -sum(p * log2(p + 1e-10)) AS h FROM j GROUP BY a, feature),
hx AS (SELECT a, feature, -sum(p * log2(p + 1e-10)) AS h
  FROM (SELECT a, feature, bin, sum(p) AS p FROM j GROUP BY ALL) GROUP BY a, feature),
hy AS (SELECT a, feature, -sum(p * log2(p + 1e-10)) AS h
  FROM (SELECT a, feature, hit, sum(p) AS p FROM j GROUP BY ALL) GROUP BY a, feature),
mi AS (SELECT hj.a AS attack_type, hj.feature, hj.pos, greatest(0.0, hx.h + hy.h - hj.h) AS importance
  FROM hj JOIN hx USING (a, feature) JOIN hy USING (a, feature))
SELECT attack_type, CAST(row_number() OVER (PARTITION BY attack_type
    ORDER BY round(importance, 12) DESC, pos) AS INT) AS rank,
  feature, round(importance, 8) AS importance FROM mi""",
        "correlation_matrix": _correlations(),
        "attribute_table": f"""WITH {_STATS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY attack_type ORDER BY discrimination DESC, pos) AS place
  FROM stats),
top AS (SELECT attack_type, string_agg(feature, ', ' ORDER BY place) AS key_features
  FROM ranked WHERE place <= 3 GROUP BY attack_type)
SELECT r.attack_type, key_features,
  printf('%.0f±%.0f', benign_median, benign_iqr) AS benign_range,
  printf('%.0f±%.0f', attack_median, attack_iqr) AS attack_range,
  CASE WHEN attack_median > (CASE WHEN benign_median > 0 THEN benign_median * 1.5 ELSE 1.0 END)
       THEN printf('%s > %.2f', feature, CASE WHEN benign_median > 0 THEN benign_median * 1.5 ELSE 1.0 END)
       WHEN attack_median < benign_median * 0.5
       THEN printf('%s < %.2f', feature, benign_median * 0.5)
       ELSE feature || ' in anomaly distribution' END AS suggested_rule,
  round((SELECT count(*) FROM flows f WHERE f.attack_type = r.attack_type) * 100.0
        / (SELECT count(*) FROM flows), 6) AS support_percent
FROM ranked r JOIN top USING (attack_type) WHERE place = 1""",
    }
    sql |= _read_back_sql(score)
    sql["feature_importance_with_nan"] = sql["feature_importance"]
    sql["correlation_matrix_with_nan"] = sql["correlation_matrix"]
    trees = sql["attribute_table"].replace(_FLOWS, _TREE_FLOWS)
    sql["attribute_table_with_trees"] = f"""SELECT *, 1.0::DOUBLE AS rule_precision, 1.0::DOUBLE AS rule_recall
FROM ({trees})"""
    return sql | _CORPUS_SQL
