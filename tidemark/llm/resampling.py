"""Importance resampling towards a target distribution, over hashed runs of words, with segment deduplication.

A feature is a run of 1 to ``width`` consecutive words; it is hashed into one of ``buckets``.  A bucket's gain is the
log ratio of its smoothed share among the target's features to that among the documents'.  A document's weight is the
sum of its features' gains; Gumbel noise from its id is added and the highest scores are drawn, which samples without
replacement in proportion to exp(weight).

Counting by segments: newlines cut texts into lines.  Equal lines of all documents are folded into one with its number
of occurrences, so a line's features are hashed once and multiplied, however often it is repeated.  The runs that go
over line ends belong to documents, not lines; they are counted apart from the few words next to each line end.  Both
counts add up to those of the whole texts.  Weights are found the same way: each batch of documents scores its distinct
lines once, adds a line's sum for each occurrence, and adds the gains of the runs over its line ends.

Per corpus the driver sees ``buckets`` counts and a few totals.  Hot lines leave each task as one row.

Defined cases: a null text has no words (0 features, weight 0) and still gets a score; a null id is hashed as empty
text and sorts before others among equal scores; repeated rows are scored and drawn each; ties go to the smaller id;
an empty table gives an empty result, and an empty target gains from no features.  Only the id and text are read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .byte_words import Words, cut, groups_of, shift
from .common import numbered, written

BUCKETS = 10_000
WIDTH = 3
WORD_BYTES = np.zeros(256, dtype=bool)           # digits, lower-cased letters and all bytes of characters outside ASCII
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
SPACE_CRC = np.uint32(0xE96CCF45)                # CRC-32 of one space
NEWLINE = 0x0A


def words_of(texts: pa.Array) -> Words:
    return cut(texts, lambda data: WORD_BYTES[data])


def runs(words: Words, owner: np.ndarray, width: int):
    """For each length 1 to ``width``: the CRC-32 of the run that starts at each word, and whether it has one owner."""
    crc = words.crc()
    spaced = shift(np.full(len(crc), SPACE_CRC, dtype=np.uint32), words.size) ^ crc         # of the word after a space
    for n in range(width):
        if n:
            crc = shift(crc[:-1], words.size[n:] + 1) ^ spaced[n:] if len(crc) else crc
        yield crc, owner[:len(crc)] == owner[n:] if len(crc) else np.zeros(0, dtype=bool)


def near_line_ends(words: Words, width: int) -> tuple[Words, np.ndarray]:
    """The first and last ``width`` - 1 words of each line, and the line of each; all runs over line ends lie in them."""
    breaks = np.flatnonzero(words.data == NEWLINE)
    line = np.searchsorted(breaks, words.start) + words.row                 # rises from text to text and line to line
    first = np.flatnonzero(np.diff(line, prepend=-1))
    count = np.diff(np.append(first, len(line)))
    place = np.arange(len(line)) - np.repeat(first, count)
    keep = np.flatnonzero((place < width - 1) | (np.repeat(count, count) - place < width))
    return words.pick(keep), line[keep]


def line_sums(words: Words, rows: int, width: int, gains: np.ndarray) -> np.ndarray:
    """The sum of gains of each row's features, for rows that are lines."""
    total = np.zeros(rows, dtype=np.int64)
    for crc, whole in runs(words, words.row, width):
        np.add.at(total, words.row[:len(crc)][whole], gains[crc[whole] % len(gains)])
    return total


def across(words: Words, width: int):
    """(text, CRC-32) of the runs that go over line ends, for each length from 2."""
    edge, line = near_line_ends(words, width)
    for n, ((crc, same_line), (_, same_text)) in enumerate(zip(runs(edge, line, width), runs(edge, edge.row, width))):
        if n:
            over = same_text & ~same_line
            yield edge.row[:len(crc)][over], crc[over]


def _counts(buckets: int, width: int, lines: bool):
    """Bucket counts of a task: of lines (text, n) times their occurrences, or over the line ends of texts."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in groups_of(texts):
                words = words_of(texts.slice(a, b - a))
                if lines:
                    times = batch.column(1).to_numpy(zero_copy_only=False)[a:b]
                    for crc, whole in runs(words, words.row, width):
                        np.add.at(total, crc[whole] % buckets, times[words.row[:len(crc)][whole]])
                else:
                    for _, crc in across(words, width):
                        total += np.bincount(crc % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str, *, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """(bucket, n): how many features of all texts lie in each bucket; buckets without any are left out."""
    own = texts.select(F.col(text_col).alias("t")).filter("t is not null")
    lines = own.select(F.explode(F.split("t", "\n")).alias("line")).filter("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    within = lines.mapInArrow(_counts(buckets, width, True), "bucket int, n long")
    over = own.filter(F.col("t").contains("\n")).mapInArrow(_counts(buckets, width, False), "bucket int, n long")
    return within.union(over).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str, target_text: str, *, buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, target over documents, of each bucket."""

    def table(frame, col):
        n = np.zeros(buckets, dtype=np.int64)
        for r in bucket_counts(frame, col, buckets=buckets, width=width).collect():      # at most ``buckets`` rows
            n[r["bucket"]] = r["n"]
        return n.tolist()

    s, t = table(docs, text_col), table(target, target_text)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((float(y + 1) * all_s) / (float(x + 1) * all_t))) for x, y in zip(s, t)], dtype=np.int64)


def _weigh(gain: np.ndarray, width: int):
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, texts, hashed = batch.column(0), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
            noise = np.array([math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in hashed.tolist()], dtype=np.int64)
            for a, b in groups_of(texts):
                part = pc.fill_null(texts.slice(a, b - a), "")
                lists = pc.split_pattern(part, "\n")
                kinds = lists.flatten().dictionary_encode()
                sums = line_sums(words_of(kinds.dictionary), len(kinds.dictionary), width, gain)[kinds.indices.to_numpy()]
                owner = np.repeat(np.arange(b - a), pc.list_value_length(lists).to_numpy())
                weight = np.zeros(b - a, dtype=np.int64)
                np.add.at(weight, owner, sums)
                words = words_of(part)
                for text, crc in across(words, width):
                    np.add.at(weight, text, gain[crc % len(gain)])
                n = np.bincount(words.row, minlength=b - a).astype(np.int64)
                features = sum(np.maximum(n - k, 0) for k in range(width))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(n), pa.array(features), pa.array(weight),
                                                  pa.array(weight + noise[a:b])], schema=schema)

    return run


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, *, width: int = WIDTH, seed: int = 42) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every document; ``score`` is the weight plus the id's Gumbel noise."""
    salted = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    noise = F.conv(F.substring(salted, 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), noise.alias("h"))
    return rows.mapInArrow(_weigh(gain, width), "id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", *,
             percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, width: int = WIDTH, seed: int = 42) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document.

    ``rank`` counts from 1 in falling order of the score over the floor(percent * N / 100) documents drawn, of the N
    with at least ``min_words`` words; it is null for the others.
    """
    gain = gains(docs, target, text_col, target_text, buckets=buckets, width=width)
    scored = written(weights(docs, gain, id_col, text_col, width=width, seed=seed), "resampling-scores")
    able = F.col("n_words") >= min_words
    drawn = percent * scored.filter(able).count() // 100
    in_order = numbered(scored.filter(able).withColumn("lowest", -F.col("score")), ["lowest", "id", "n_features"], "resampling-ranks").drop("lowest")
    ranked = in_order.withColumn("rank", F.when(F.col("number") < drawn, F.col("number") + 1)).drop("number")
    return ranked.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
