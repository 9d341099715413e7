"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A text becomes the array of its words' hashes (runs of letters and digits, lower case).  A seed is a window of
``SPAN`` words of which a fixed mask keeps some; the others may differ, so a passage with substituted words still
shares seeds with its source.  Documents and benchmark items are joined on the seeds' hashes.  Each hit names a
diagonal (place in the document minus place in the item), and the words of document and item along it are compared:
the run from an equal word to an equal word that has the most of them, at least ``min_share`` of its words, is the
overlap.  It is reported if at least ``min_overlap`` words match (or ``min_share`` of an item shorter than that).

Until texts are compared only numbers move.  Seeds that no item has are dropped where they arise, by the items' distinct
seeds, which are broadcast while at most ``max_broadcast``.  A seed that comes again and again, as in a repeated word or
phrase, is folded into runs of equal steps on both sides before they are joined, so its hits are not multiplied out:
two runs give their diagonals as a sequence.  Each pair of texts then meets once, with the set of its diagonals.

Defined cases: null and empty texts, and texts or items with fewer than ``SPAN`` words, have no seed and no overlap;
repeated rows of a document are reported once for each item; repeated items are reported each under their id, and
rows with a null id under null; several overlaps of one document and item are reported by the longest, ties by the
place in the document; empty tables give an empty result.  Only the id and text columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, written

MASKS = ("110011011", "111101001", "101011011")      # 1: the word counts; all of one length
SPAN = len(MASKS[0])
MIN_OVERLAP = 10
MIN_SHARE = 0.75


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(words: Column) -> Column:
    """The seeds of all windows for one mask after the other: window i of mask m is at m * windows + i."""
    at = F.sequence(F.lit(0), F.size(words) - SPAN)

    def of(number: int, mask: str) -> Column:
        kept = [k for k, c in enumerate(mask) if c == "1"]
        return F.transform(at, lambda i: F.xxhash64(F.lit(number), *[F.get(words, i + k) for k in kept]))

    masks = [of(n, m) for n, m in enumerate(MASKS)]
    return F.when(F.size(words) >= SPAN, F.concat(*masks)).otherwise(F.array().cast("array<bigint>"))


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(col(id_col), col(text_col))


def _seeded(rows: DataFrame, id_col: str, text_col: str, prefix: str) -> DataFrame:
    """(<prefix>_key, seed, at): one row per seed of the rows, with the window's place."""
    words = rows.select(_key(id_col, text_col).alias(f"{prefix}_key"), word_hashes(col(text_col)).alias("words"))
    out = words.select(f"{prefix}_key", F.size("words").alias("size"), F.posexplode(seeds(F.col("words"))).alias("k", "seed"))
    return out.select(f"{prefix}_key", "seed", (F.col("k") % (F.col("size") - SPAN + 1)).alias("at"))


def _strides(places: DataFrame, prefix: str) -> DataFrame:
    """(<prefix>_key, seed, first, step, n): the places of each seed in a text as runs of equal steps.

    A repeated word or phrase gives one or two rows, however long it goes on.
    """
    key = f"{prefix}_key"
    order = Window.partitionBy(key, "seed").orderBy("at")
    stepped = places.distinct().withColumn("step", F.coalesce(F.col("at") - F.lag("at").over(order), F.lit(0)))
    turns = stepped.withColumn("run", F.sum((F.col("step") != F.lag("step", 1, -1).over(order)).cast("int")).over(order))
    return turns.groupBy(key, "seed", "run").agg(F.min("at").alias("first"), F.max("step").alias("step"), F.count(F.lit(1)).cast("int").alias("n")).drop("run")


def _diagonals(x: str, y: str) -> Column:
    """All differences of a place of the run ``x`` and one of the run ``y`` (prefixes of first, step and n)."""
    f, s, n = (lambda c: F.col(f"{x}_{c}")), (lambda c: F.col(f"{y}_{c}")), F.lit(1)
    last = lambda r: r("first") + (r("n") - 1) * r("step")
    step = F.greatest(F.when(f("n") > 1, f("step")).otherwise(s("step")), n)
    whole = F.sequence(f("first") - last(s), last(f) - s("first"), step)
    alone = F.flatten(F.transform(F.sequence(F.lit(0), f("n") - 1), lambda i: F.sequence(
        f("first") + i * f("step") - last(s), f("first") + i * f("step") - s("first"), F.greatest(s("step"), n))))
    return F.when((f("n") == 1) | (s("n") == 1) | (f("step") == s("step")), whole).otherwise(alone)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _best_run(equal: Column, min_share: float) -> Column:
    """(matched, first, length) of the run with ``min_share`` equal words that has the most; of equals the first."""
    return _best_of(F.filter(F.sequence(F.lit(0), F.size(equal) - 1), lambda i: F.get(equal, i)), min_share)


def _best_of(places: Column, min_share: float) -> Column:
    """As ``_best_run``, from the places of the equal words.

    The run from the a-th to the b-th equal word, at p_a and p_b, has the share if f(b) + 1 - share >= f(a), where
    f(k) = k - share * p_k.  Starts and ends are sorted by these values together; on the way the smallest start so far
    is the best for every end that follows.
    """
    share = round(min_share * 10_000)
    none = F.lit(None).cast("int")
    f = lambda p, k: k.cast("long") * 10_000 - p.cast("long") * share
    starts = F.transform(places, lambda p, k: F.struct(f(p, k).alias("at"), F.lit(0).alias("end"), k.alias("k"), p.alias("p")))
    ends = F.transform(places, lambda p, k: F.struct((f(p, k) + (10_000 - share)).alias("at"), F.lit(1).alias("end"), k.alias("k"), p.alias("p")))
    zero = F.struct(none.alias("k"), none.alias("p"), F.lit(0).alias("matched"), none.alias("first"), F.lit(0).alias("length"))

    def step(acc, x):
        start, size = x["end"] == 0, x["k"] - acc["k"] + 1
        lower = start & (acc["k"].isNull() | (x["k"] < acc["k"]))
        better = ~start & ((size > acc["matched"]) | ((size == acc["matched"]) & (acc["p"] < acc["first"])))
        pick = lambda cond, new, old: F.when(cond, new).otherwise(old)
        return F.struct(pick(lower, x["k"], acc["k"]).alias("k"), pick(lower, x["p"], acc["p"]).alias("p"), pick(better, size, acc["matched"]).alias("matched"),
                        pick(better, acc["p"], acc["first"]).alias("first"), pick(better, x["p"] - acc["p"] + 1, acc["length"]).alias("length"))

    walked = F.aggregate(F.array_sort(F.concat(starts, ends)), zero, step)
    return _let(walked, lambda w: F.struct(w["matched"].alias("matched"), F.coalesce(w["first"], F.lit(0)).alias("first"), w["length"].alias("length")))


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
             item_text: str = "text", *, min_overlap: int = MIN_OVERLAP, min_share: float = MIN_SHARE, max_broadcast: int = 1_000_000) -> DataFrame:
    """(id, item_id, matched, length, share, coverage, doc_start, item_start): one row per document and item that overlap.

    Places count words from 0; ``share`` is matched / length, ``coverage`` matched / words of the item.
    """
    item_places = written(_strides(_seeded(items, item_id, item_text, "item"), "item"), "benchmark-seeds")
    known = item_places.select("seed").distinct()
    known = F.broadcast(known) if item_places.count() <= max_broadcast else known
    doc_places = _strides(_seeded(docs, id_col, text_col, "doc").join(known, "seed", "left_semi"), "doc")
    run = lambda frame, p: frame.select(f"{p}_key", "seed", *[F.col(c).alias(f"{p}_{c}") for c in ("first", "step", "n")])
    hits = run(doc_places, "doc").join(run(item_places, "item"), "seed").select("doc_key", "item_key", F.explode(_diagonals("doc", "item")).alias("d"))
    pairs = written(hits.groupBy("doc_key", "item_key").agg(F.collect_set("d").alias("diagonals")), "benchmark-pairs")
    hit = pairs.select("doc_key").distinct()
    hit = F.broadcast(hit) if hit.count() <= max_broadcast else hit          # one number a row

    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("t"), _key(id_col, text_col).alias("doc_key")).join(hit, "doc_key", "left_semi")
    doc_words = texts.dropDuplicates(["doc_key"]).select("doc_key", "doc_id", word_hashes(F.col("t")).alias("doc_words"))
    item_words = items.select(_key(item_id, item_text).alias("item_key"), col(item_id).alias("item_id"), word_hashes(col(item_text)).alias("item_words")).dropDuplicates(["item_key"])
    both = pairs.join(doc_words, "doc_key").join(item_words, "item_key")
    needed = F.least(F.lit(float(min_overlap)), F.ceil(F.size("item_words") * min_share))

    def judged(d):
        first, item_first = F.greatest(d, F.lit(0)), F.greatest(-d, F.lit(0))
        length = F.least(F.size("doc_words") - first, F.size("item_words") - item_first)
        equal = F.filter(F.sequence(F.lit(0), length - 1), lambda i: F.get("doc_words", first + i) == F.get("item_words", item_first + i))
        all_ = F.struct(length.alias("matched"), F.lit(0).alias("first"), length.alias("length"))
        best = lambda p: F.when(F.size(p) == length, all_).when(F.size(p) >= needed, _best_of(p, min_share))
        return _let(_let(equal, best), lambda r: F.struct(r["matched"].alias("matched"), (-r["length"]).alias("l"), (-first - r["first"]).alias("d"), (-item_first - r["first"]).alias("i")))

    good = both.select("doc_id", "item_id", F.size("item_words").alias("item_size"), F.array_max(F.filter(F.transform("diagonals", judged), lambda r: r["matched"] >= needed)).alias("best"))
    best = F.max(F.struct("best.matched", "best.l", "best.d", "best.i", "item_size")).alias("best")
    return good.filter("best is not null").groupBy("doc_id", "item_id").agg(best).select(
        F.col("doc_id").alias("id"), "item_id", "best.matched", (-F.col("best.l")).alias("length"), (F.col("best.matched") / -F.col("best.l")).alias("share"),
        (F.col("best.matched") / F.col("best.item_size")).alias("coverage"), (-F.col("best.d")).alias("doc_start"), (-F.col("best.i")).alias("item_start"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without an overlap; columns and repeated rows as they are.  Rows with a null id stay."""
    found = overlaps(docs, items, id_col, text_col, **options).select(F.col("id").alias("_hit_")).distinct()
    return docs.join(found, col(id_col) == found["_hit_"], "left_anti")
