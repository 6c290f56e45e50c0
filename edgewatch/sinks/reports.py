"""Reports over already aggregated frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small result frame as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def markdown_report(
    summary: DataFrame,
    statistics: DataFrame,
    importance: DataFrame,
    tree_metrics: DataFrame,
    per_class: int = 5,
    table: DataFrame | None = None,
    features: list[str] | None = None,
) -> str:
    """Findings per attack class as Markdown. Inputs have a few rows per class and feature.

    ``table`` is the attribute table; it adds key features, support and suggested rule of each class.
    """
    total = summary.first()
    lines = ["# Attribute analysis", "", "## Summary", ""]
    lines.append(f"- rows: {total.total_rows}")
    lines.append(f"- benign: {total.benign_rows}")
    lines.append(f"- attack: {total.attack_rows}")
    lines.append(f"- classes: {len(total.attack_types)}")
    if features is not None:
        lines += ["", f"Features analysed ({len(features)}): {', '.join(features)}"]
    named = {r.attack_type: r for r in table.collect()} if table is not None else {}
    best = sorted(statistics.collect(), key=lambda r: (r.attack_type, -r.discrimination, r.feature))
    ranked = sorted(importance.collect(), key=lambda r: (r.attack_type, r["rank"]))
    quality = {r.attack_type: r for r in tree_metrics.collect()}
    for attack in sorted({r.attack_type for r in best}):
        lines += ["", f"## {attack}", "", f"Rows: {total.attack_types.get(attack, 0)}", ""]
        if attack in named:
            row = named[attack]
            lines += [
                f"- key features: {row.key_features}",
                f"- support: {row.support_percent:.2f} %",
                f"- suggested rule: {row.suggested_rule}",
                "",
            ]
        lines += ["| feature | benign median | attack median | Cliff's delta | discrimination |"]
        lines += ["|---|---|---|---|---|"]
        for r in [r for r in best if r.attack_type == attack][:per_class]:
            lines.append(
                f"| {r.feature} | {r.benign_median:.2f} | {r.attack_median:.2f} "
                f"| {r.cliff_delta:.3f} | {r.discrimination:.3f} |"
            )
        top = [r for r in ranked if r.attack_type == attack][:per_class]
        if top:
            lines += ["", "Most informative features:", ""]
            lines += [f"{r['rank']}. {r.feature} ({r.importance:.4f} bits)" for r in top]
        if attack in quality:
            q = quality[attack]
            lines += [
                "",
                f"Tree: accuracy {q.accuracy:.3f}, precision {q.precision:.3f}, recall {q.recall:.3f}",
            ]
    return "\n".join(lines) + "\n"
