"""One batch sync run of one table: mark → window → extract → stage → apply → log."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.compress import compress_columns, decompress_columns
from ..functions.versions import BEGINNING
from ..operators.apply import load_full, stage_changes
from ..operators.extract import extract_changes, extract_snapshot
from ..operators.runs import high_water_mark
from ..operators.versions import current_version
from ..sources.bucketed import BucketedTable
from ..sources.runlog import RunLog
from ..sources.fs import folder_kbs
from .spec import VersionWindow


def sync_table(spark: SparkSession, name: str, keys: Sequence[str], source: DataFrame, delete_log: DataFrame | None,
               target: BucketedTable, log: RunLog, subscription_id: int, stage_root: str, current: int | None = None,
               initialize: bool = False, double_read: bool = False, identity: Sequence[str] = (), now=None,
               compress: Sequence[str] = (), ledger=None) -> dict:
    """Bring ``target`` up to ``current`` (default: the ledger's safe version, or the source's highest) and log the run.

    No successful run yet, an initialise request, or no target → full load of the snapshot (no stage).  Otherwise
    the changes of (mark, current] are collapsed per key, written to a stage folder, and applied bucket-wise.
    ``compress`` columns travel gzip-compressed in the staged incremental feed and are decompressed at apply.
    A failure closes the run with success 0, so the next run covers the window again.
    """
    if current is None:
        current = current_version(source, delete_log, ledger=ledger)
    runs = log.runs().where(F.col("subscription_id") == subscription_id)
    mark = high_water_mark(runs, double_read=double_read).first()       # None: never ran
    rv_from = BEGINNING if (initialize or mark is None or not target.exists()) else int(mark["hwm"])
    run_id = log.start_run(subscription_id, rv_from, current, now)
    window = VersionWindow(rv_from, current)
    try:
        moved = move_table(spark, name, keys, source, delete_log, target, window, f"{stage_root.rstrip('/')}/run={run_id}/{name}", identity, compress)
        log.log_table(run_id, moved["logged_as"], moved["rows"], moved["kbs"], moved["is_stage"])
        log.end_run(run_id, True, "ok", now)
        return dict(run_id=run_id, rv_from=rv_from, rv_to=current, **moved)
    except Exception as ex:
        log.end_run(run_id, False, f"{type(ex).__name__}: {ex}", now)
        raise


def move_table(spark: SparkSession, name: str, keys: Sequence[str], source: DataFrame, delete_log: DataFrame | None, target: BucketedTable,
               window: VersionWindow, stage_path: str, identity: Sequence[str] = (), compress: Sequence[str] = ()) -> dict:
    """Load the snapshot into ``target``, or stage and apply the window's changes; rows are observed while they are written.

    Returns mode, rows, kbs, the name the detail is logged under and whether it names a stage.
    """
    seen = Observation()
    counted = lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if window.is_snapshot:
        version = target.write_full(counted(load_full(extract_snapshot(source, window))))
        folders = sorted(set(target.manifest(version)["buckets"].values()))
        kbs = sum(folder_kbs(spark, f"{target.root}/{f}") for f in folders)
        return dict(mode="full", rows=int(seen.get["rows"]), kbs=kbs, logged_as=name, is_stage=False)
    changes = extract_changes(source, delete_log, keys, window)
    if compress:
        changes = compress_columns(changes, compress)
    stage = stage_changes(counted(changes), stage_path)
    rows = int(seen.get["rows"])
    applied = target.apply(decompress_columns(stage, compress) if compress else stage, identity=identity, stage_rows=rows)
    return dict(mode="incremental", rows=rows, kbs=folder_kbs(spark, stage_path), logged_as=f"stg_{name}", is_stage=True, **applied)
