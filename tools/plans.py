"""Write PLANS.md: the physical plans of the core operators on stored inputs (sf0.01), as Spark prints them.

Usage: python tools/plans.py [sf_dir]
"""
from __future__ import annotations

import io
import os
import sys
import tempfile
from contextlib import nullcontext, redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.operators import apply as ap  # noqa: E402
from tidemark.operators import asof, compare, extract, versions  # noqa: E402
from tidemark.plans.fixtures import FEED_KEYS, PAIR_COLUMNS, PAIR_KEYS, Fixtures  # noqa: E402
from tidemark.plans.spec import VersionWindow, validate_key  # noqa: E402
from tidemark.session import get_spark  # noqa: E402
from tidemark.sources.bucketed import BucketedTable, co_partition_on_subset  # noqa: E402

NOTES = {
    "extract_changes": "Range bounds are literals: both filters reach the parquet scans (PushedFilters). The union is "
                       "shuffled once by key; WindowGroupLimit Partial keeps one row per key per map task.",
    "feed_from_log (delete log)": "One scan and one exchange by (key, version segment); the second use of that "
                                  "exchange is reused at run time. Only segment-edge rows take the key-level window.",
    "apply_changes broadcast": "Stage size measured first. Target streamed through a broadcast left join — no target "
                               "exchange; inserts from a key-only semi-join against the same broadcast.",
    "apply_changes shuffle": "Beyond the broadcast limit: one full outer sort-merge join, both sides by key.",
    "compare_tables": "Full outer sort-merge join by key; the as-of lookup is an equi-join on version buckets "
                      "against the broadcast interval table (bounded by checkpoint rows + 4096).",
    "date_to_rv": "As-of on time: checkpoints → disjoint intervals with running max; points join on their bucket.",
    "BucketedTable large apply (co-partitioned)": "Stage over the broadcast limit: target and stage are each "
                                                  "hash-partitioned once by (bucket, slice); the full outer sort-merge "
                                                  "join on (bucket, slice, keys) adds no exchange of its own.",
    "number_rows": "Range partition + sort, checkpoint, per-partition counts → broadcast offsets (size = partitions).",
    "validate_key": "One shuffle by key with map-side partial counts.",
}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(partitions=16)
    fx = Fixtures(spark, sf_dir)
    tmp = tempfile.mkdtemp(prefix="tm-plans-")
    K = list(FEED_KEYS)
    # store the derived inputs, as a deployment would: source table sorted by version, delete log, target, stage
    fx.src.sortWithinPartitions("rv").write.parquet(f"{tmp}/src")
    fx.del_log.write.parquet(f"{tmp}/del")
    fx.tgt.write.parquet(f"{tmp}/tgt")
    fx.stg.write.parquet(f"{tmp}/stg")
    src, dels = spark.read.parquet(f"{tmp}/src"), spark.read.parquet(f"{tmp}/del")
    tgt, stg = spark.read.parquet(f"{tmp}/tgt"), spark.read.parquet(f"{tmp}/stg")
    p, s = fx.pair
    store = BucketedTable(spark, f"{tmp}/store", K, num_buckets=8)
    store.write_full(tgt)
    cases = {
        "extract_changes": lambda: extract.extract_changes(src, dels, K, VersionWindow(fx.lo, fx.hi)),
        "feed_from_log (delete log)": lambda: versions.feed_from_log(fx.chg, K, ["event_type", "value"], "rv", "op",
                                                                     "ts", versions.segment_span(0, fx.hi))[1],
        "apply_changes broadcast": lambda: ap.apply_changes(tgt, stg, K, strategy="broadcast"),
        "apply_changes shuffle": lambda: ap.apply_changes(tgt, stg, K, strategy="shuffle"),
        "compare_tables": lambda: compare.compare_tables(p, s, list(PAIR_KEYS), list(PAIR_COLUMNS), checkpoints=fx.ck,
                                                         now="2024-01-31 00:00:00"),
        "date_to_rv": lambda: asof.date_to_rv(fx.table("events").select("event_id", "ts"), fx.ck, "ts"),
        "BucketedTable large apply (co-partitioned)": lambda: store.co_partitioned_rows(store.read(), stg, slices=2),
        "number_rows": lambda: versions.number_rows(tgt.select(*K), K, 0, "rv"),
        "validate_key": lambda: validate_key(fx.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
    }
    out = ["# Physical plans of the core operators", "",
           "Generated by `python tools/plans.py` on sf0.01 with stored (parquet) inputs; AQE enabled, "
           "16 shuffle partitions.  Plans are the final adaptive plans after execution.", ""]
    for name, build in cases.items():
        with co_partition_on_subset(spark) if "co-partitioned" in name else nullcontext():
            df = build()
            df.collect()
            buf = io.StringIO()
            with redirect_stdout(buf):
                df.explain()
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", buf.getvalue().strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
