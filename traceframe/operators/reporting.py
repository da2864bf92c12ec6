"""Reports as rows of text, and their writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _line(section: int, text: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), text.alias("text"))


def quality_report(evaluation: DataFrame, style: str = "md") -> DataFrame:
    """The quality evaluation as (section, line_no, text) rows, Markdown or plain text."""
    bullet = "- **{}:** " if style == "md" else "{}: "
    head = "## {}" if style == "md" else "{}"

    def item(label: str, value: Column) -> Column:
        return F.concat(F.lit(bullet.format(label)), F.coalesce(value.cast("string"), F.lit("N/A")))

    title = "# Data Quality Evaluation Report" if style == "md" else "DATA QUALITY EVALUATION REPORT"
    lines = [
        _line(0, F.lit(title)),
        _line(0, item("Priority", F.col("priority"))),
        _line(0, item("Recommended Action", F.col("action"))),
        _line(0, item("Reasoning", F.col("reasoning"))),
        _line(1, F.lit(head.format("Validation Results"))),
        _line(1, item("Total Traces", F.col("total_traces"))),
        _line(1, item("Total Files", F.col("total_files"))),
        _line(1, item("Validation Passed", F.col("validation_passed"))),
        _line(1, item("Anomalies", F.size("anomalies"))),
        _line(2, F.lit(head.format("Statistical Analysis"))),
        _line(2, item("Mean of Means", F.round("statistics.mean_of_means", 4))),
        _line(2, item("Mean of Stds", F.round("statistics.mean_of_stds", 4))),
        _line(2, item("Balance Score", F.round("balance.balance_score", 4))),
        _line(3, F.lit(head.format("Domain-Specific Validation"))),
        _line(3, item("Dead Traces", F.col("domain.dead_traces"))),
        _line(3, item("Sample Rate Within Standards", F.col("domain.within_standards"))),
        _line(4, F.lit(head.format("Data Drift Detection"))),
        _line(4, item("Status", F.col("drift_status"))),
    ]
    found = F.transform(
        "anomalies", lambda a: F.struct(F.lit(1).alias("section"), F.concat(F.lit("  - "), a).alias("text"))
    )
    everything = F.concat(F.array(*lines[:9]), found, F.array(*lines[9:]))
    return evaluation.select(F.posexplode(everything).alias("line_no", "l")).select(
        "l.section", F.col("line_no").cast("long").alias("line_no"), "l.text"
    )


def comparison_report(comparison: DataFrame, verdict: DataFrame) -> DataFrame:
    """A dataset comparison and its verdicts as (section, line_no, text) rows."""
    pct = F.format_number("relative_diff_pct", 2)
    body = comparison.select(
        F.lit(1).alias("section"),
        F.concat(
            F.lit("- "), F.col("statistic"), F.lit(": "), F.format_number("base_value", 4), F.lit(" -> "),
            F.format_number("other_value", 4), F.lit(" ("), pct, F.lit("%)"),
        ).alias("text"),
    )
    found = [F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in verdict.columns]
    tail = verdict.select(F.inline(F.array(*[_line(2, t) for t in found])))
    # A report has tens of lines: numbering them in one window is bounded.
    from pyspark.sql import Window

    rows = body.unionByName(tail)
    return rows.withColumn("line_no", F.row_number().over(Window.partitionBy("section").orderBy("text")).cast("long"))


def write_report(lines: DataFrame, path: str) -> None:
    """One text file in line order; a report is small by nature."""
    lines.orderBy("section", "line_no").select("text").coalesce(1).write.mode("overwrite").text(path)
