"""Packing of documents into fixed windows by minimum bin slack.

Every document is encoded once and cut into full windows and one remainder.  A full window is a sequence of its own.
The remainders are packed: the longest one left opens a window, and a bitset subset-sum over the lengths still left
(one bit for each reachable sum, one layer for each length, lengths taken as often as they are left) finds the
multiset that fills the rest of the window closest to its capacity; walking the layers back gives how many pieces of
each length go in.  Packing needs lengths only, so remainders are dealt evenly by hash into groups of about
``group_size`` pieces, each packed in one task, whatever the size of the corpus.

The encoded pieces are written to the shared folder first; a lost executor does not make the plan inconsistent.

Defined cases: a null text counts as empty and yields the end id alone; repeated rows are packed each; rows with a
null id are packed like others; an empty table gives no pieces.  Only the id and text columns are read.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .byte_words import groups_of
from .common import release_memory, written
from .tokens import GROUP_CHARS, encoder

CAPACITY = 2048
PIECES = "id long, start long, length long, doc_tokens long, ids binary, ids_crc32 long"


def fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best; ``lengths`` are the keys of ``counts``, longest first."""
    full, mask = 1 << room, (2 << room) - 1
    bits, layers = 1, []
    for n in lengths:
        if n > room:
            continue
        layers.append((n, bits))
        once = bits
        for _ in range(min(counts[n], room // n)):
            once = (once << n) & mask
            if not once:
                break
            bits |= once
        if bits & full:
            break
    at, chosen = bits.bit_length() - 1, {}
    for n, before in reversed(layers):
        while not before >> at & 1:
            at -= n
            chosen[n] = chosen.get(n, 0) + 1
    return chosen


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece; pieces of one length are taken in the order given."""
    window, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    values, first, number = np.unique(-lengths[order], return_index=True, return_counts=True)
    nexts = {int(-v): int(f) for v, f in zip(values, first)}
    counts = {int(-v): int(n) for v, n in zip(values, number)}
    left, k = sorted(counts, reverse=True), 0
    while left:
        longest = left[0]
        counts[longest] -= 1
        chosen = fill(left, counts, capacity - longest)
        at = 0
        for n, times in [(longest, 1), *chosen.items()]:
            for _ in range(times):
                i = order[nexts[n]]
                nexts[n] += 1
                window[i], offset[i] = k, at
                at += n
        for n, times in chosen.items():
            counts[n] -= times
        if not all(counts[n] for n in (longest, *chosen)):
            left = [n for n in left if counts[n]]
        k += 1
    return window, offset


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        for batch in batches:
            coder = encoder(path)
            for a, b in groups_of(batch.column(1), GROUP_CHARS):            # few texts at a time are Python strings
                texts, keys = batch.column(1).slice(a, b - a).to_pylist(), batch.column(0).slice(a, b - a).to_pylist()
                cols = [[] for _ in range(6)]
                for key, ids in zip(keys, coder.encode(texts)):
                    ids = np.append(ids, end_id).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        raw = ids[start:start + capacity].tobytes()
                        for col, v in zip(cols, (key, start, len(raw) // 4, len(ids), raw, zlib.crc32(raw))):
                            col.append(v)
                    if len(cols[0]) >= 1000:
                        yield _pieces(cols)
                        cols = [[] for _ in range(6)]
                if cols[0]:
                    yield _pieces(cols)
        release_memory()

    return run


def _pieces(cols):
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=["id", "start", "length", "doc_tokens", "ids", "ids_crc32"])


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY,
         end_id: int = 1, group_size: int = 20_000) -> DataFrame:
    """(id, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset): one row per piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    """
    coded = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
             .mapInArrow(_cut(tokenizer, capacity, end_id), PIECES).withColumn("piece", F.monotonically_increasing_id()))
    pieces = written(coded, "pieces")
    whole = pieces.filter(F.col("length") == capacity).select("*", (F.col("piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_size))

    def windows(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["piece"])
        window, offset = pack_lengths(frame["length"].to_numpy(), capacity)
        return pd.DataFrame({"placed": frame["piece"].to_numpy(), "sequence_id": 2 * ((int(key[0]) << 32) + window), "offset": offset})

    plan = (rest.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("g"))
            .groupBy("g").applyInPandas(windows, "placed long, sequence_id long, offset long"))
    packed = rest.join(plan, rest["piece"] == plan["placed"]).drop("placed")
    return whole.unionByName(packed).drop("piece")
