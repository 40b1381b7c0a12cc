"""Staff workload and work-hours analytics on the Spark DataFrame API."""

from shiftgauge.checkpoints import scratch
from shiftgauge.plans.day_state import count_days, read_flags, update_days
from shiftgauge.plans.item_detail import processed_items
from shiftgauge.plans.item_store import read_items, write_items
from shiftgauge.plans.report import report_rows, write_report
from shiftgauge.plans.work_hours import (
    suspicious_days,
    suspicious_flags,
    team_day_stats,
    user_day_hours,
    user_day_with_stats,
)
from shiftgauge.sources.periods import read_period, read_period_table, write_period_table
from shiftgauge.sources.relations import read_relation

__all__ = [
    "count_days",
    "processed_items",
    "read_flags",
    "read_items",
    "read_period",
    "read_period_table",
    "read_relation",
    "report_rows",
    "scratch",
    "suspicious_days",
    "suspicious_flags",
    "team_day_stats",
    "update_days",
    "user_day_hours",
    "user_day_with_stats",
    "write_items",
    "write_period_table",
    "write_report",
]
