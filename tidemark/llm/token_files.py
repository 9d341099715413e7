"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

A file holds a run of documents in ascending id order.  Its head has a table of the ids that occur in it, most
frequent first; the body stores each id's rank in 1 to 4 bytes.  The byte counts of four ids share one control byte,
and all control bytes lie before all data bytes.  A reader takes the counts of each control byte from a table of 256
rows, sums them up to find where every rank starts, and gathers the bytes, all in numpy.  Each file can be read alone.

Layout of a file (little-endian): magic ``TIDS1``; u4 documents, u4 ids in the table, u8 ids in the body; i8 document
ids (u1 before each: 1 if null); u4 lengths; u4 table; control bytes; data bytes.

Files are the rows of a Parquet dataset in the shared folder, so Spark's committer writes them and any file system
that Spark reads can hold them: ``part`` and ``seq`` give their order.  Documents are dealt by ranges of ids, and a
file is closed when it holds ``file_ids`` ids, so memory does not grow with the corpus.

Defined cases: a null text counts as empty and yields the end id alone; documents with a null id come first; rows
that repeat an id follow each other, in the order of their texts' hashes; an empty table gives an empty dataset.
"""
from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

from .tokens import encoder

MAGIC = b"TIDS1"
HEAD = "<IIQ"
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)   # by control byte
SCHEMA = "seq long, earlier long, n_ids long, body binary"      # earlier: ids of the task's files before this one


def write_file(keys: list, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file of the documents' ids, laid one after the other in ``ids``."""
    seen = np.bincount(ids) if len(ids) else np.zeros(0, dtype=np.int64)
    table = np.argsort(-seen, kind="stable")[:np.count_nonzero(seen)].astype("<u4")
    rank_of = np.zeros(len(seen), dtype=np.uint32)
    rank_of[table] = np.arange(len(table), dtype=np.uint32)
    rank = rank_of[ids] if len(ids) else np.zeros(0, dtype=np.uint32)
    size = 1 + (rank > 0xFF).astype(np.uint8) + (rank > 0xFFFF) + (rank > 0xFFFFFF)
    padded = np.zeros(-(-len(rank) // 4) * 4, dtype=np.uint8)
    padded[:len(rank)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(1).astype(np.uint8)
    data = rank.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    null = np.array([k is None for k in keys], dtype=np.uint8)
    names = np.array([k or 0 for k in keys], dtype="<i8")
    return b"".join([MAGIC, struct.pack(HEAD, len(keys), len(table), len(ids)), null.tobytes(), names.tobytes(), sizes.astype("<u4").tobytes(), table.tobytes(), control.tobytes(), data.tobytes()])


def read_file(body: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of one file."""
    if body[:5] != MAGIC:
        raise ValueError("not a token-id file")
    docs, kinds, total = struct.unpack_from(HEAD, body, 5)
    at = 5 + struct.calcsize(HEAD)
    take = lambda kind, n: np.frombuffer(body, dtype=kind, count=n, offset=at)
    null = take("u1", docs); at += docs  # noqa: E702
    names = take("<i8", docs); at += 8 * docs  # noqa: E702
    sizes = take("<u4", docs).astype(np.int64); at += 4 * docs  # noqa: E702
    table = take("<u4", kinds); at += 4 * kinds  # noqa: E702
    control = take("u1", -(-total // 4)); at += len(control)  # noqa: E702
    data = np.frombuffer(body, dtype=np.uint8, offset=at)
    size = LENGTHS[control].reshape(-1)[:total].astype(np.int64)
    if size.sum() != len(data):
        raise ValueError("token-id file is cut off")
    start = np.cumsum(size) - size
    rank = data[start].astype(np.int64) if total else np.zeros(0, dtype=np.int64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        rank[more] |= data[start[more] + k].astype(np.int64) << 8 * k
    return [None if z else int(n) for z, n in zip(null, names)], sizes, table[rank]


def _encode(path: str, end_id: int, file_ids: int):
    def run(batches):
        keys, parts, held, seq, earlier = [], [], 0, 0, 0

        def close():
            sizes = np.array([len(p) for p in parts], dtype=np.int64)
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([pa.array([seq], pa.int64()), pa.array([earlier], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([write_file(keys, sizes, ids)], pa.binary())], names=["seq", "earlier", "n_ids", "body"])

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist())):
                keys.append(key)
                parts.append(np.append(ids, end_id).astype(np.uint32))
                held += len(parts[-1])
                if held >= file_ids:
                    yield close()
                    keys, parts, held, seq, earlier = [], [], 0, seq + 1, earlier + held
        if keys:
            yield close()
    return run


def write(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 2,
          file_ids: int = 2_000_000) -> None:
    """Encode whole texts, append ``end_id`` to each, and write the files of all documents to ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), F.xxhash64(F.col(text_col)).alias("h"))
    dealt = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "t")
    coded = dealt.mapInArrow(_encode(tokenizer, end_id, file_ids), SCHEMA)
    coded.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids, ids_crc32): every document of the files, ``start`` counting all ids before it."""
    files = spark.read.schema("part int, " + SCHEMA).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())   # a row for each writing task
    before, offsets = 0, {}
    for part, n in totals:
        offsets[part], before = before, before + n
    sizes = F.broadcast(spark.createDataFrame(list(offsets.items()), "at int, before long"))
    placed = files.join(sizes, F.col("part") == F.col("at")).select((F.col("before") + F.col("earlier")).alias("base"), "body")

    def decode(batches):
        for batch in batches:
            for base, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, lengths, ids = read_file(body.as_py())
                ends, ids = np.cumsum(lengths), ids.astype("<u4")
                for a in range(0, len(keys), 2000):
                    raw = [ids[e - n:e].tobytes() for e, n in zip(ends[a:a + 2000], lengths[a:a + 2000])]
                    n = len(raw)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + n], pa.int64()), pa.array(base + (ends - lengths)[a:a + n]), pa.array(lengths[a:a + n]), pa.array(raw, pa.binary()), pa.array([zlib.crc32(r) for r in raw], pa.int64())], names=["id", "start", "n_tokens", "ids", "ids_crc32"])

    return placed.mapInArrow(decode, "id long, start long, n_tokens long, ids binary, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The documents as read back from files written to a new folder below the shared one."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, tokenizer, path, **options)
    return read(docs.sparkSession, path)
