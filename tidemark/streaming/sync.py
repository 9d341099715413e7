"""Near-real-time sync with Structured Streaming.

The publisher side writes each window's collapsed change records (op, columns, ``sourcerv``) as parquet files into
a change folder; ``readStream.parquet`` picks new files up, and ``foreachBatch`` collapses each micro-batch to the
last change per key and applies it bucket-wise to the target.  The stream's checkpoint holds the offsets (which
files are done; new files are taken in commit order); the apply is idempotent (re-applying a batch changes
nothing), and ``guard='newer'`` keeps a retried batch from moving any row back to an older version.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.versions import BEGINNING
from ..operators.apply import next_tombstones, without_stale
from ..operators.extract import extract_changes, extract_snapshot, latest_per_key
from ..operators.runs import closed_windows, contiguous_marks
from ..plans.fixtures import FEED_KEYS, FEED_VALUES, Fixtures
from ..plans.spec import OP_COL, SOURCE_VERSION, VersionWindow
from ..plans.sync import sync_table
from ..session import checkpoint_dir, scratch_path
from ..sources.bucketed import BucketedTable
from ..sources.changelog import BLOCK_COL, ChangeLog
from ..sources.fs import HadoopFs
from ..sources.runlog import RunLog


WINDOW_COL = "window_to"          # upper bound of the published window that a change record belongs to
WINDOWS_SCHEMA = "subscription_id bigint, rv_from bigint, rv_to bigint, rows bigint"
RECEIVED_SCHEMA = "rv_to bigint, batch bigint, rows bigint"


def publish_window(changes: DataFrame, change_dir: str, window: VersionWindow | None = None, windows_dir: str | None = None,
                   subscription_id: int = 0) -> None:
    """Append one window's change records to the change folder (the stream's source).

    With ``window`` the records carry its upper bound, and once they are written the window is listed in ``windows_dir``
    with the number of its records, observed while they were written: it is closed when a subscriber has seen as many.
    """
    if window is None:
        changes.write.mode("append").parquet(change_dir)
        return
    seen = Observation()
    out = changes.withColumn(WINDOW_COL, F.lit(window.hi).cast("bigint")).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("append").parquet(change_dir)
    row = [(subscription_id, window.lo, window.hi, int(seen.get["rows"]))]
    changes.sparkSession.createDataFrame(row, WINDOWS_SCHEMA).coalesce(1).write.mode("append").parquet(windows_dir)


class StreamState:
    """What a stream remembers beside its offsets: rows received of each window, and tombstones, one folder a batch.

    A batch that is run again writes its own folders again, from those of the batches before it.
    """

    def __init__(self, spark: SparkSession, root: str, windows_dir: str):
        self.spark, self.root, self.windows_dir = spark, root.rstrip("/"), windows_dir

    def _batches(self, name: str) -> list:
        names = HadoopFs(self.spark, f"{self.root}/{name}").list_names()
        return sorted(int(n.split("-")[1]) for n in names if n.startswith("batch-"))

    def received(self, before: int | None = None) -> DataFrame:
        paths = [f"{self.root}/received/batch-{b}" for b in self._batches("received") if before is None or b < before]
        return self.spark.read.schema(RECEIVED_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], RECEIVED_SCHEMA)

    def tombstones(self, before: int) -> DataFrame | None:
        held = [b for b in self._batches("tombstones") if b < before]
        return self.spark.read.parquet(f"{self.root}/tombstones/batch-{held[-1]}") if held else None

    def marks(self, received: DataFrame | None = None) -> DataFrame:
        """(subscription_id, mark, waiting): how far closed windows reach without a gap, and how many wait beyond it."""
        published = self.spark.read.schema(WINDOWS_SCHEMA).parquet(self.windows_dir)
        return contiguous_marks(closed_windows(published, self.received() if received is None else received))

    def mark(self, received: DataFrame | None = None) -> int:
        return max((int(r["mark"]) for r in self.marks(received).collect()), default=BEGINNING)        # a row a subscription

    def keep(self, batch_id: int, received: DataFrame, tombstones: DataFrame) -> None:
        tombstones.write.mode("overwrite").parquet(f"{self.root}/tombstones/batch-{batch_id}")
        received.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/received/batch-{batch_id}")


def sync_stream(spark: SparkSession, change_dir: str, schema: T.StructType, target: BucketedTable,
                checkpoint: str, keys: Sequence[str], log: RunLog | None = None, subscription_id: int = 0,
                max_files_per_trigger: int | None = None, available_now: bool = True, processing_time: str | None = None,
                state: StreamState | None = None):
    """Start the stream; returns the ``StreamingQuery`` (``available_now`` runs what is there and stops).

    With ``state`` windows may arrive in any order: a run is logged up to the end of the contiguous closed windows, never
    a batch's maximum, and the deletes above that mark are kept as tombstones, so an older insert that arrives late does
    not bring a deleted row back.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = reader.parquet(change_dir)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        checkpoint_dir(batch.sparkSession)
        counts = batch.groupBy(F.col(WINDOW_COL).alias("rv_to")).agg(F.count(F.lit(1)).alias("rows")) if state else None
        batch = batch.drop(BLOCK_COL, WINDOW_COL)
        # Materialise the collapsed batch once (shared checkpoint folder): the stats, the touched-bucket list and
        # the apply all read it.
        stage = latest_per_key(batch, keys, SOURCE_VERSION)
        old = state.tombstones(batch_id) if state else None
        stage = (without_stale(stage, old, keys) if old is not None else stage).checkpoint(eager=True)
        lo_hi = stage.agg(F.min(SOURCE_VERSION), F.max(SOURCE_VERSION), F.count(F.lit(1))).first()
        if state:
            before = state.received(batch_id)
            got = counts.select("rv_to", F.lit(batch_id).cast("bigint").alias("batch"), "rows").checkpoint(eager=True)    # a row a window
            rv_from, rv_to = state.mark(before), state.mark(before.unionByName(got))
        elif not lo_hi[2]:
            return
        else:
            rv_from, rv_to = int(lo_hi[0]) - 1, int(lo_hi[1])
        run_id = log.start_run(subscription_id, rv_from, rv_to) if log else None
        try:
            if lo_hi[2]:
                target.apply(stage, guard="newer", stage_rows=int(lo_hi[2]))
            if state:
                state.keep(batch_id, got, next_tombstones(old, stage, keys, rv_to))
            if log:
                log.log_table(run_id, "stream", int(lo_hi[2]))
                log.end_run(run_id, True, f"batch {batch_id}")
        except Exception as ex:
            if log:
                log.end_run(run_id, False, f"batch {batch_id}: {ex}")
            raise

    writer = changes.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# ---- registered queries: replay the events feed in three windows and return the target --------------------------

def _window_ends(fx: Fixtures):
    return [fx.lo, (fx.lo + fx.hi) // 2, fx.hi]


def _source_at(fx: Fixtures, v: int):
    """Publisher state as of version ``v``: the log reduced up to ``v``, deletes logged up to ``v``."""
    from ..operators.versions import feed_from_log, segment_span
    chg = fx.chg.where(F.col("rv") <= F.lit(v))
    src, dels = feed_from_log(chg, list(FEED_KEYS), ["event_type", "value"], "rv", "op", "ts", segment_span(0, v))
    return src, dels


def sync_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batch sync runs — full load to 60 %, then two incremental windows — must rebuild the source state."""
    fx = Fixtures(spark, sf_dir)
    root = scratch_path(spark, "sync-table")
    target = BucketedTable(spark, f"{root}/target", list(FEED_KEYS), num_buckets=16)
    log = RunLog(spark, f"{root}/log")
    for v in _window_ends(fx):
        src, dels = _source_at(fx, v)
        sync_table(spark, "feed", list(FEED_KEYS), src, dels, target, log, 1, f"{root}/stage", current=v)
    return target.read()


def sync_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three windows published as change files and applied by a Structured Streaming query."""
    fx = Fixtures(spark, sf_dir)
    root = scratch_path(spark, "sync-stream")
    change_log = ChangeLog(spark, f"{root}/changes", list(FEED_KEYS), block=max(fx.hi // 8, 1))
    ends = _window_ends(fx)
    prev = 0
    schema = None
    for v in ends:
        src, dels = _source_at(fx, v)
        w = VersionWindow(prev, v)
        ch = extract_snapshot(src, w) if w.is_snapshot else extract_changes(src, dels, list(FEED_KEYS), w)
        schema = schema or ch.schema
        change_log.append(ch)          # the publisher's side: one append per window, by version block
        prev = v
    target = BucketedTable(spark, f"{root}/target", list(FEED_KEYS), num_buckets=16)
    empty = spark.createDataFrame([], T.StructType([f for f in schema.fields if f.name != "rpl_operation"]))
    target.write_full(empty)
    stream_schema = T.StructType(schema.fields + [T.StructField(BLOCK_COL, T.LongType())])
    q = sync_stream(spark, change_log.root, stream_schema, target, f"{root}/checkpoint", list(FEED_KEYS),
                    RunLog(spark, f"{root}/log"), max_files_per_trigger=8)
    q.awaitTermination()
    return target.read()


def raw_window(fx: Fixtures, lo: int, hi: int) -> DataFrame:
    """The feed's last change per key inside (lo, hi], as a publisher sends it: deletes with NULL values."""
    live = F.col("op") == "U"
    inside = latest_per_key(fx.chg.where((F.col("rv") > F.lit(lo)) & (F.col("rv") <= F.lit(hi))), list(FEED_KEYS), "rv")
    return inside.select(F.col("op").alias(OP_COL), *FEED_KEYS, *[F.when(live, F.col(c)).alias(c) for c in FEED_VALUES], F.col("rv").alias(SOURCE_VERSION))


def _out_of_order(spark: SparkSession, sf_dir: str):
    """Windows one, three and two published in this order, the stream run after each; (target, marks after each)."""
    fx = Fixtures(spark, sf_dir)
    root = scratch_path(spark, "stream-marks")
    ends = [0, *_window_ends(fx)]
    target, log, marks = BucketedTable(spark, f"{root}/target", list(FEED_KEYS), num_buckets=16), RunLog(spark, f"{root}/log"), []
    state = StreamState(spark, f"{root}/state", f"{root}/windows")
    schema = raw_window(fx, 0, 0).schema
    target.write_full(spark.createDataFrame([], T.StructType([f for f in schema.fields if f.name != OP_COL])))
    for k in (0, 2, 1):
        publish_window(raw_window(fx, ends[k], ends[k + 1]), f"{root}/changes", VersionWindow(ends[k], ends[k + 1]), f"{root}/windows", 1)
        q = sync_stream(spark, f"{root}/changes", T.StructType([*schema.fields, T.StructField(WINDOW_COL, T.LongType())]), target,
                        f"{root}/checkpoint", list(FEED_KEYS), log, 1, state=state)
        q.awaitTermination()
        marks.append(state.marks().withColumn("step", F.lit(len(marks) + 1)).select("step", "mark", "waiting"))
        marks[-1] = spark.createDataFrame(marks[-1].collect(), "step int, mark bigint, waiting bigint")     # one row, before the next step
    return target, marks


def stream_marks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark and the windows waiting after each of three windows that arrive out of order."""
    _, marks = _out_of_order(spark, sf_dir)
    return marks[0].unionByName(marks[1]).unionByName(marks[2])


def stream_late_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after the same windows: rows deleted in the third stay deleted when the second brings them late."""
    target, _ = _out_of_order(spark, sf_dir)
    return target.read()
