"""Importance resampling, spelling variants and sharding against brute force, and their defined cases."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.llm import byte_words, queries, resampling, sharding, variants

LONG = "Wörter und Worte " * 20000
ODD = [(1, None, 7), (2, "", 7), (2, "", 7), (3, "one two\nthree\n\nfour\nfive six seven\n", 7), (4, "\n\n\n", 7), (None, "no id at all", 7),
       (5, LONG, 7), (6, "A\nb\nC\nd", 7), (7, "Straße Ünder ÉÀ été×x 日本 x" * 3, 7), (7, "other text", 7), (8, "one two\nthree\r\nfour\x00five", 7)]


def documents(spark, name):
    rows = spark.read.parquet(f"{SF001}/{name}.parquet")
    return rows, [tuple(r) for r in rows.select(rows.columns[0], "text").collect()]


def test_words_and_checksums():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abZ é日\n .") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "x" * 500]
    words = resampling.words_of(pa.array(texts))
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    want = [(i, w) for i, t in enumerate(low) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]
    assert list(zip(words.row.tolist(), words.strings().to_pylist())) == want
    assert words.crc().tolist() == [zlib.crc32(w.encode()) for _, w in want]
    for by in (0, 1, 64, 65, 3000):
        moved = byte_words.shift(words.crc(), np.full(len(want), by))
        assert moved.tolist() == [zlib.crc32(w.encode() + b"q" * by) ^ zlib.crc32(b"q" * by) for _, w in want]
    found = variants.words_of(pa.array(texts + ["×÷ÿÀ Ā aĀb ß¿c"]))
    assert found.strings().to_pylist() == [w for t in low + ["×÷ÿÀ Ā aĀb ß¿c"] for w in re.findall("[A-Za-zÀ-ÿ]+", t)]
    assert [b - a for a, b in byte_words.groups_of(pa.array(["a" * 9, "b", "c", None, "d" * 30]), 10)] == [2, 2, 1]


# ---------------------------------------------------------------- importance resampling

def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(docs, target):
    """(doc_id, n_features, weight, score, rank) by the definition, one feature after the other."""
    count = lambda texts: Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])
    s, t = count(x for _, x in docs), count(x for _, x in target)
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    rows = []
    for key, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in (zlib.crc32(f.encode()) % 10000 for f in found))
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0], r[2]))
    for i, r in enumerate(able[:5 * len(able) // 100]):
        r[5] = i + 1
    return sorted((tuple(r[:1] + r[2:]) for r in rows), key=str)


def test_resampling_query_equals_brute_force(spark):
    got = queries.op11_resampling(spark, SF001)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect()), key=str) == resampled(documents(spark, "documents")[1], documents(spark, "benchmark")[1])


def test_resampling_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, weight int").withColumn("line", F.lit(1)).withColumn("a.b", F.lit(1))
    target = spark.createDataFrame([("one two three four five six",), (None,), ("été " * 30,)], "text string")
    got = resampling.resample(docs, target, percent=50).select("id", "n_features", "weight", "score", "rank")
    # brute force draws 5 %: compare the rest of the columns, then the ranks' order
    want = resampled([r[:2] for r in ODD], [(0, r["text"]) for r in target.collect()])
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted((r[:4] for r in want), key=str)
    ranked = sorted((r["rank"], -r["score"]) for r in got.collect() if r["rank"])
    assert [r for r, _ in ranked] == list(range(1, len(ranked) + 1)) and ranked == sorted(ranked, key=lambda r: r[1])
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(ODD)
    assert resampling.resample(docs.limit(0), target.limit(0)).count() == 0


def test_lines_and_line_ends_add_up_to_whole_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b", "c ", " ", "\n", "\nx\n"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for width in (1, 2, 3, 5):
        rows = spark.createDataFrame([(t,) for t in texts + texts[:100]], "text string")
        got = {r["bucket"]: r["n"] for r in resampling.bucket_counts(rows, "text", buckets=97, width=width).collect()}
        want = Counter()
        for t in texts + texts[:100]:
            words = features(t)[0]
            want.update(zlib.crc32(" ".join(words[i:i + n]).encode()) % 97 for n in range(1, width + 1) for i in range(len(words) - n + 1))
        assert got == want


# ---------------------------------------------------------------- spelling variants

def counted(docs, every=199, min_length=6, min_count=5):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(n):
    near, shapes = defaultdict(set), defaultdict(list)
    for w in n:                                            # words that agree but for one place
        for i in range(len(w) + 1):
            shapes[w[:i], w[i:]].append(w)
            if i < len(w):
                shapes[w[:i], w[i + 1:]].append(w)
    for alike in shapes.values():
        for a in alike:
            near[a] |= {b for b in alike if one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows)


@pytest.mark.parametrize("sf", [SF001, SF001.replace("0.001", "0.01")])
def test_variants_query_equals_brute_force(spark, sf):
    got = queries.op12_variants(spark, sf)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == grouped(counted(docs))


def test_variants_at_every_place_and_in_crowded_groups(spark):
    rng = random.Random(1)
    vocabulary = {"".join(rng.choice("abéÿ") for _ in range(rng.randint(1, 8))): rng.choice([1, 1, 5, 30, 200]) for _ in range(900)}
    vocabulary.update({"x" * 300: 40, "x" * 301: 5, "y" + "x" * 299: 3})
    rows = spark.createDataFrame(list(vocabulary.items()), "word string, n long").withColumn("key", F.lit(1))
    for limit in (8192, 5):                                # the second deals nearly all groups anew, down to one character
        got = variants.group(rows.select("word", "n"), max_group=limit).select("word", "form", "root", "n", "n_near", "form_n")
        assert sorted(map(tuple, got.collect())) == grouped(vocabulary)


def test_chains_of_forms_are_followed_to_the_end(spark):
    chain = [("a" * (6 + i), 5 ** (20 - i)) for i in range(15)]
    got = {r["word"]: r["root"] for r in variants.group(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {"aaaaaa"} and len(got) == 15


def test_word_counts_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, n int").withColumn("word", F.lit("clash"))
    for every in (None, 199, 2, 1):
        got = variants.word_counts(docs, drop_every=every, min_length=1, min_count=1)
        want = counted([r[:2] for r in ODD], every, 1, 1)
        assert {r["word"]: r["n"] for r in got.collect()} == want
    assert variants.group(variants.word_counts(docs.limit(0))).count() == 0


# ---------------------------------------------------------------- sharding

def test_differencing_keeps_items_and_balances():
    rng = random.Random(4)
    for n in (0, 1, 3, 40, 500, 5000):
        sizes = [rng.randint(16, 9000) for _ in range(n)]
        loads = [0] * 8
        for size, s in zip(sizes, sharding.difference(sizes, 8)):
            loads[s] += size
        assert sum(loads) == sum(sizes) and max(loads) - min(loads) <= (max(sizes, default=0) if n < 100 else 40 if n < 1000 else 2)
    assert sorted(sharding.difference([8, 7, 6, 5, 4], 2)) in ([0, 0, 0, 1, 1], [0, 0, 1, 1, 1])
    a = sharding.difference([8, 7, 6, 5, 4], 2)            # the textbook case: differencing leaves 2
    assert abs(sum(x if s else -x for x, s in zip([8, 7, 6, 5, 4], a))) == 2
    lead, sizes = [500, 0, 0, 300], [rng.randint(1, 9) for _ in range(300)]
    filled = list(lead)
    for size, s in zip(sizes, sharding.difference(sizes, 4, lead)):
        filled[s] += size
    assert max(filled) - min(filled) <= 1
    assert sharding.poured([10, 0, 3], 9) == [0, 6, 3] and sum(sharding.poured([100, 1, 1, 1], 9)) == 9


def check_shards(docs, rows, shards, spread):
    """Every row once, equal texts together, slots without gaps, bytes near equal."""
    want = Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    home, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        assert home.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    loads = [load[s] for s in range(shards)]
    assert max(loads) - min(loads) <= spread, loads
    return loads


def test_sharding_query(spark):
    got = queries.op13_sharding(spark, SF001)
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    rows, docs = got.collect(), documents(spark, "documents")[1]
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    check_shards(docs, rows, 40, max(len((t or "").encode()) + 16 for _, t in docs))


def test_sharding_by_chunks_with_heavy_groups(spark):
    rng = random.Random(6)
    docs = [(i, "x" * rng.randint(0, 400) + str(i)) for i in range(6000)] + [(9000 + i, "copied " * 30) for i in range(3000)] + [(20000 + i, None) for i in range(900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(0)).withColumn("shard", F.lit(-1))
    rows = sharding.shard(frame, shards=10, heavy_share=200, chunk_groups=700).withColumnRenamed("id", "doc_id").collect()
    loads = sorted(check_shards(docs, rows, 10, 10 ** 9))
    assert loads[-1] >= 3000 * 226 and loads[8] - loads[0] <= 30        # the copies fill one shard, the others are level


def test_sharding_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, size int").withColumn("a.b", F.lit(1))
    rows = sharding.shard(docs, shards=3).withColumnRenamed("id", "doc_id").collect()
    check_shards([r[:2] for r in ODD], rows, 3, 10 ** 9)
    assert sharding.shard(docs.limit(0)).count() == 0
