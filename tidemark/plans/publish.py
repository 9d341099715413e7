"""Publisher side for tables that arrive as whole snapshots: give them versions and a delete log.

The reference stamps every insert/update with a database-wide version and logs deletes from a trigger.  Here a new
snapshot is compared with the previous versioned one: changed or new rows get fresh versions above the current
mark, unchanged rows keep theirs, and keys that disappeared are appended to the delete log with their own versions.
"""
from __future__ import annotations

from contextlib import nullcontext
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.versions import classify_snapshot, current_version, number_classified, stamp_versions
from ..session import checkpoint_dir
from .spec import require_key, user_columns


def publish_snapshot(prev: DataFrame | None, snapshot: DataFrame, keys: Sequence[str],
                     delete_log: DataFrame | None = None, at=None, track: Sequence[str] = (), ledger=None):
    """(versioned table, delete-log rows added, new current version) for a new ``snapshot`` of a keyed table.

    A snapshot whose key is NULL or repeated is refused before anything is written.  Both outputs come from one join.
    With a ``ledger`` the versions are claimed from it, so tables published side by side share one version order; else
    they follow the highest version found in the table and its log.
    """
    checkpoint_dir(snapshot.sparkSession)
    require_key(snapshot, keys)
    if prev is None:
        n, rows = snapshot.count() if ledger else 0, None
    else:
        rows = classify_snapshot(prev, snapshot, keys, track)
        n = rows.where("_kind > 0").count() if ledger else 0
    found = [x.select("rv") for x in (prev, delete_log) if x is not None]
    with ledger.versions(n) if ledger else nullcontext(current_version(*found) if found else 0) as base:
        if prev is None:
            table, deletes = stamp_versions(None, snapshot, keys, base).checkpoint(eager=True), None
            issued = table.select("rv")
        else:
            table, deletes = number_classified(rows, user_columns(snapshot), keys, base, at, track)
            table, deletes = table.checkpoint(eager=True), deletes.checkpoint(eager=True)
            issued = table.select("rv").unionByName(deletes.select("rv"))
        return table, deletes, int(max(base, issued.agg(F.max("rv")).first()[0] or 0))
