"""Flow files to cleaned Parquet, and cleaned flows to attribute reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewatch.functions.scalar import named
from edgewatch.operators.attributes import (
    CLASS,
    attribute_table,
    correlation_matrix,
    feature_importance,
    feature_statistics,
    profile_features,
)
from edgewatch.operators.clean import clean_flows, dataset_summary
from edgewatch.operators.trees import Trees, decision_trees
from edgewatch.session import materialize
from edgewatch.sinks.reports import markdown_report, write_csv_report
from edgewatch.sinks.tables import write_flows
from edgewatch.sources.flow_files import LOAD_ORDER, find_files, read_flow_files


def ingest_flows(spark: SparkSession, out: str, *patterns: str, sample: int | None = None) -> DataFrame:
    """Read, clean, write, and summarise what was written."""
    files = len(find_files(spark, *patterns))
    flows = clean_flows(read_flow_files(spark, *patterns, sample=sample), LOAD_ORDER)
    if "Timestamp" in flows.columns:
        flows = flows.orderBy("Timestamp", *LOAD_ORDER)
    write_flows(flows.drop(*LOAD_ORDER), out)
    return dataset_summary(spark.read.parquet(out), files)


@dataclass(frozen=True)
class FlowAnalysis:
    summary: DataFrame
    statistics: DataFrame
    importance: DataFrame
    correlation: DataFrame
    trees: Trees
    table: DataFrame
    features: list[str]

    def write(self, path: str) -> str:
        """CSV reports under ``path``; returns the Markdown findings."""
        write_csv_report(self.table, f"{path}/attribute_table")
        write_csv_report(self.statistics, f"{path}/feature_statistics")
        write_csv_report(self.importance, f"{path}/feature_importance")
        write_csv_report(self.correlation, f"{path}/feature_correlation")
        return markdown_report(
            self.summary,
            self.statistics,
            self.importance,
            self.trees.metrics,
            table=self.table,
            features=self.features,
        )


def analyze_flows(flows: DataFrame, features: list[str] | None = None) -> FlowAnalysis:
    """All attribute analyses over one column-pruned copy of the flows."""
    features = profile_features(flows, features)
    summary = dataset_summary(flows)
    narrow = materialize(flows.select(CLASS, *[named(f).cast("double").alias(f) for f in features]), "flows")
    rows = narrow.count()
    statistics = materialize(feature_statistics(narrow, features), "statistics")
    importance = materialize(feature_importance(narrow, features, rows), "importance")
    trees = decision_trees(narrow, features, rows)
    table = attribute_table(narrow, statistics, trees.metrics, features)
    return FlowAnalysis(
        summary, statistics, importance, correlation_matrix(narrow, features, rows), trees, table, features
    )
