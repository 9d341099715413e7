from .extract import latest_per_key, extract_snapshot, extract_changes
from .apply import apply_changes, deleted_rows, upsert, load_full, stage_changes
from .versions import (number_rows, stamp_versions, capture_deletes, current_version, previous_per_key,
                       feed_from_log, segment_span)
from .asof import build_checkpoints, asof_join, rv_to_date, date_to_rv, asof_date, range_join, runs_containing
from .runs import (last_success, high_water_mark, run_window, open_run, due_feeds, recent_runs, latest_run,
                   run_detail_view, run_totals, table_stats, missing_from)
from .compare import classify_pairs, compare_tables, compare_summary, repair_from_diff, compare_all
