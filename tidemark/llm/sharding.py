"""Sharding by balanced bytes: Karmarkar-Karp differencing over groups of equal texts, which stay in one shard.

A partial partition is a list of loads, one a shard, each with its members.  Differencing starts from one partial
partition for each group (its bytes, and nothing in the other places) and repeatedly combines the two with the largest
spread, the heaviest load of one with the lightest of the other, until one is left.  Its spread is the imbalance; with
many groups it comes down to a few bytes.

At scale the work is split without passing the groups through one task.  Groups with over one ``heavy_share``-th of
all bytes or rows, at most twice ``heavy_share`` in number, are partitioned first, on the driver.  The others are dealt
by the hash of their text into chunks of about ``chunk_groups``, and each chunk is differenced in a task of its own.
Shards that the heavy groups filled need less of the others, or nothing: water is poured over the heavy loads, and each
chunk starts with a further partial partition that holds its share of every open shard's lead.  Combining it like any
other makes the chunk fill up what is missing; its place in the result names the shard.

Rows join their group's shard: of heavy groups by a broadcast of the heavy list, of the others, none of which holds more
than that share of the rows, by a shuffle.  Places in a shard are numbered in the order of (shard, id) without a window.

Defined cases: a null text has no bytes and is one group with empty texts; a null id comes first in its shard;
repeated rows are a group and get a place each; fewer groups than shards leave shards empty; an empty table gives an
empty result.  Only the id and text are read.
"""
from __future__ import annotations

import heapq
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import numbered, written

HEAVY_SHARE = 1000
CHUNK_GROUPS = 50_000


def difference(sizes: list[int], shards: int, lead: list[int] | None = None) -> list[int]:
    """The shard of each of ``sizes``; ``lead`` is what the shards already hold."""
    by_load = itemgetter(0)
    heap = [(-size, i, [(0, None)] * (shards - 1) + [(size, i)]) for i, size in enumerate(sizes)]
    first = sorted(((load, ~s) for s, load in enumerate(lead or [0] * shards)), key=by_load)       # ~s: a shard's name
    heap.append((first[0][0] - first[-1][0], len(sizes), first))
    heapq.heapify(heap)
    at = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        both = [(x + y, q if p is None else p if q is None else (p, q)) for (x, p), (y, q) in zip(a, reversed(b))]
        both.sort(key=by_load)
        at += 1
        heapq.heapreplace(heap, (both[0][0] - both[-1][0], at, both))
    out = [0] * len(sizes)
    for _, members in heap[0][2]:
        found, shard, open_ = [], None, [members]
        while open_:
            node = open_.pop()
            if isinstance(node, tuple):
                open_ += node
            elif node < 0:
                shard = ~node
            else:
                found.append(node)
        for i in found:
            out[i] = shard
    return out


def poured(loads: list[int], water: int) -> list[float]:
    """How much of ``water`` each shard takes if all are filled to one level."""
    low, total = sorted(loads), 0
    for n, load in enumerate(low, 1):
        total += load
        level = (water + total) / n
        if n == len(low) or level <= low[n]:
            return [max(0.0, level - x) for x in loads]
    return []


def assign(groups: DataFrame, rows: int, size: int, *, shards: int, heavy_share: int = HEAVY_SHARE,
           chunk_groups: int = CHUNK_GROUPS) -> tuple[DataFrame, DataFrame]:
    """(key, shard) of the heavy and of the other ``groups`` (key, n, bytes), which hold ``rows`` and ``size`` in all."""
    spark = groups.sparkSession
    is_heavy = (F.col("bytes") * heavy_share > size) | (F.col("n") * heavy_share > rows)
    big = sorted(groups.filter(is_heavy).select("key", "bytes").collect(), key=lambda r: (-r["bytes"], bytes(r["key"])))   # at most 2 * heavy_share
    place = difference([r["bytes"] for r in big], shards)
    loads = [0] * shards
    for r, s in zip(big, place):
        loads[s] += r["bytes"]
    heavy = spark.createDataFrame([(r["key"], s) for r, s in zip(big, place)], "key binary, shard int")
    light = groups.filter(~is_heavy).select("key", "bytes")
    water = size - sum(loads)
    room = poured(loads, water)
    open_ = [s for s, x in enumerate(room) if x] or [0]              # shards not full of heavy groups alone
    lead = [(max(room) - room[s]) / max(water, 1) for s in open_]    # for each byte of the other groups

    def place_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["bytes", "key"], ascending=[False, True])
        sizes = chunk["bytes"].tolist()
        place = difference(sizes, len(open_), [int(x * sum(sizes)) for x in lead])
        return pd.DataFrame({"key": chunk["key"], "shard": [open_[s] for s in place]})

    chunks = -(-light.count() // chunk_groups)
    dealt = light.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(max(1, chunks))))
    return heavy, dealt.groupBy("chunk").applyInPandas(place_chunk, "key binary, shard int")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 40, row_bytes: int = 16,
          heavy_share: int = HEAVY_SHARE, chunk_groups: int = CHUNK_GROUPS) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row of ``docs``; sizes are UTF-8 bytes plus ``row_bytes``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(row_bytes).cast("long")).alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")), "shard-rows")
    groups = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-groups")
    n, size = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    heavy, light = assign(groups, n, size, shards=shards, heavy_share=heavy_share, chunk_groups=chunk_groups)
    tagged = rows.join(F.broadcast(heavy), "key", "left")
    others = tagged.filter("shard is null").drop("shard").join(written(light, "shard-light"), "key")
    placed = written(tagged.filter("shard is not null").unionByName(others).drop("key"), "shard-placed")
    ordered = numbered(placed, ["shard", "id", "size", "text_crc32"], "shard-slots")
    before, firsts = 0, []
    for r in sorted(placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect(), key=itemgetter("shard")):      # a row a shard
        firsts.append((r["shard"], before))
        before += r["n"]
    first = F.broadcast(docs.sparkSession.createDataFrame(firsts, "shard int, first long"))
    return ordered.join(first, "shard").select("id", "size", "text_crc32", "shard", (F.col("number") - F.col("first")).alias("slot"))
