"""Encoding, packing and token-id files against the tokenizer itself and exact round trips."""
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.llm import packing, queries, token_files
from tidemark.llm.tokens import Encoder

ODD = ["a  b", "a \n b\n\nc  ", "\x1c a\x1cb \x85c", "it's  don't", "<|endoftext|> a", "Σας ΟΔΟΣ.", "é ́x", "日本 語　テ", " lead", "x\x01y z",
       "tab\t\tx\ty ", "'s a", "'s\n's", "İ, x", "a\nb.\n, c .", "12 34  5", "...\n...,, (a)", "é" * 5000,
       "a., b;; c!? d", "a.", ".", "x.\ny. z", "ab.c d.", "É. ß, ×. 1. a'. Σ. don't.", "Straße. Über, naïve; Ǆ. ŉ. ſ, ÿ:"]
DOCS = [(3, "a b c"), (1, None), (2, ""), (2, ""), (None, "x y"), (7, "word " * 9000), (5, "The cat. " * 700)] + [(i, f"text {i} " * i) for i in range(10, 60)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_tokenizers(spark, name):
    coder = Encoder(queries.tokenizer(name))
    real = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()] + ODD
    want = [e.ids for e in coder.tokenizer.encode_batch(real, add_special_tokens=False)]
    assert [a.tolist() for a in coder.encode(real)] == want
    assert [list(coder.encode([t]))[0].tolist() for t in ODD] == want[-len(ODD):]
    assert [len(a) for a in coder.encode([None, "", "a"])] == [0, 0, 1]


class Counted(dict):
    """A dictionary that counts its look-ups."""
    asked = 0

    def __contains__(self, key):
        self.asked += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_known_word_is_looked_up_once_a_group(name):
    coder = Encoder(queries.tokenizer(name))
    texts = [t for t in ODD if len(t) < 100] + ["a b c\nb été a", "Über x\x00y ß"]
    want = [a.tolist() for a in coder.encode(texts)]
    assert want == [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    coder.place = Counted(coder.place)
    assert [a.tolist() for a in coder.encode(texts)] == want
    assert 0 < coder.place.asked <= len(coder.place)


def test_fill_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 30), 4, replace=False), rng.integers(1, 4, 4))}
        room = int(rng.integers(1, 60))
        got = packing.fill(sorted(counts, reverse=True), counts, room)
        best = max(s for s in (sum(n * k for n, k in zip(counts, take)) for take in product(*(range(c + 1) for c in counts.values()))) if s <= room)
        assert sum(n * k for n, k in got.items()) == best and all(k <= counts[n] for n, k in got.items())


def check_pieces(rows, want):
    place = {}
    for r in rows:
        place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in place.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    return place


def test_packing_keeps_every_id(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("offset", F.lit(1)).withColumn("ids", F.lit("x"))
    path = queries.tokenizer("byte_bpe_50k.json")
    rows = packing.pack(docs, path, group_size=20).collect()
    coder = Encoder(path).tokenizer
    want = [coder.encode(t or "", add_special_tokens=False).ids + [1] for _, t in DOCS]
    check_pieces(rows, want)
    by = {}
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
    for (key, _), ids in zip(DOCS, want):
        pieces = dict(by[(key, len(ids))])
        assert sum((pieces[s] for s in sorted(pieces)), []) == ids
    assert packing.pack(docs.limit(0), path).count() == 0


def test_little_padding(spark):
    rows = queries.op4_packing(spark, "/root/testdata/sf0.01").collect()
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert sum(2048 - n for n in used.values()) <= 0.005 * sum(used.values())


def test_file_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 70_000):
        ids = np.minimum(rng.zipf(1.2, n), 200_000).astype(np.uint32)
        sizes = np.array([n // 2, n - n // 2])
        keys, lengths, back = token_files.read_file(token_files.write_file([None, 9], sizes, ids))
        assert keys == [None, 9] and lengths.tolist() == sizes.tolist() and (back == ids).all()
    with pytest.raises(ValueError):
        token_files.read_file(token_files.write_file([1], np.array([3]), np.array([1, 2, 3], dtype=np.uint32))[:-1])


def test_token_files_in_ascending_order(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("part", F.lit(0))
    path = queries.tokenizer("word_bpe_49k.json")
    rows = sorted(token_files.round_trip(docs, path, file_ids=500).collect(), key=lambda r: r["start"])
    coder = Encoder(path).tokenizer
    want = sorted(((k, tuple(coder.encode(t or "", add_special_tokens=False).ids + [2])) for k, t in DOCS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r["id"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in rows] == want
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(w) for _, w in want])[:-1].tolist()
    assert token_files.round_trip(docs.limit(0), path).count() == 0
