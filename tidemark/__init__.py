"""Incremental table sync and change-data analytics as Spark DataFrame operators."""

from .operators import (apply_changes, asof_date, compare_summary, compare_tables, date_to_rv, extract_changes,
                        extract_snapshot, high_water_mark, latest_per_key, repair_from_diff, runs_containing,
                        rv_to_date, stamp_versions, capture_deletes, upsert)
from .plans.publish import publish_snapshot
from .plans.spec import FeedSpec, VersionWindow
from .plans.sync import sync_table
from .sources.bucketed import BucketedTable
from .sources.changelog import ChangeLog
from .sources.runlog import RunLog

__version__ = "0.1.0"
