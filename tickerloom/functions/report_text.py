"""Post-processing of a generated report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time labels after which a report ends, in order of preference.
TIME_LABELS = [
    "分析基准时间", "基准时间", "时间基准", "分析时间", "报告时间", "生成时间", "更新时间", "数据时间", "分析基准",
]


def _through_line(report: Column, pattern: Column) -> Column:
    """The report up to the end of the first line in which the pattern ends; null without a match."""
    upto = F.call_function("regexp_extract", report, F.concat(F.lit("(?is)^(.*?"), pattern, F.lit(r"[^\n]*)")), F.lit(1))
    return F.when(upto != "", F.regexp_replace(upto, r"^\s+|\s+$", ""))


def cut_after_marker(report: Column, time_info: Column) -> Column:
    """Cut after the line with a labelled time, else with the time, its date or its bracketed part."""

    def literal(value: Column) -> Column:
        return F.concat(F.lit(r"\Q"), value, F.lit(r"\E"))

    labelled = [_through_line(report, F.concat(F.lit(label + r"[：:]\s*"), literal(time_info))) for label in TIME_LABELS]
    parts = [time_info, F.split_part(time_info, F.lit(" "), F.lit(1)), F.split_part(time_info, F.lit(" "), F.lit(2))]
    return F.coalesce(*labelled, *[_through_line(report, literal(p)) for p in parts], report)
