"""Toxicity by class-conditional Kneser-Ney models.

Two character n-gram models of words, one per class, are estimated from the labelled documents.  The highest order
keeps each class's own counts; everything below it is one Kneser-Ney model of continuation counts pooled over both
classes.  A rare expression therefore falls back to the same probability in both models and says nothing, while an
expression that one class favours, also with an ending not met before, separates them.

A word counts once per document, so one document repeating itself is one observation.  All labelled rows of the
training fold are counted, in Spark, and no entry of the model is left out.  While its counted entries are at most
``max_shipped`` the sorted tables travel to the tasks (16 bytes an entry); beyond that the distinct words' grams are
joined with the tables, which gives the same evidence.

A document's evidence, normalised for its length, is three figures over its distinct words' log-likelihood ratios:
the mean ratio, the largest ratio, and the ratio of a mixture in which a small share of words follows the toxic
model, divided by the square root of the number of words.  A logistic curve fitted on a part of the training fold
whose words the calibration models have not seen turns them into a score from 0 to 1.

Defined cases: null text counts as empty; a text without words gets the score of zero evidence; repeated rows are
scored each; an empty table gives an empty result; with no labelled rows every score is 0.5 or the label share.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .byte_words import groups_of
from .common import all_columns, logistic, release_memory, row_key, written

ORDER = 5                 # characters in a gram
DISCOUNT = 0.9            # taken off each class count of the highest order
SHARED_DISCOUNT = 0.75    # taken off each pooled continuation count
SHARE = 0.02              # share of toxic words in the mixture
MEMO_WORDS = 200_000      # words whose ratio a task remembers at once
GROUP_BYTES = 8_000_000   # texts of about so many bytes are counted together
NEW_WORDS = 20_000        # words whose ratios are worked out together
HELD_WORDS = 200_000      # words of texts whose figures are still to be worked out
MAX_SHIPPED = 4_000_000   # entries of the model that travel to the tasks: at most 64 MB a task
WORD = re.compile(r"[^\W_]+")
PAD, END = "\x02", "\x03"
FEATURES = ("mean_ratio", "max_ratio", "mixture_ratio")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _codes(words: list[str], order: int):
    """64-bit codes of all n-grams of the padded words, the codes of their contexts, and each word's gram count."""
    joined = "".join(PAD * (order - 1) + w + END for w in words)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    starts = np.repeat(np.cumsum(sizes + order - 1) - (sizes + order - 1), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = starts + within
    prime, code = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(at), dtype=np.uint64)
    context = code
    with np.errstate(over="ignore"):
        for k in range(order):
            context = code
            code = (code ^ (cp[at + k] + np.uint64(0x51ED27))) * prime
            code ^= code >> np.uint64(29)
    return code, context, sizes, at, joined


def _count_grams(order: int):
    schema = pa.schema([("gram", pa.string()), ("c1", pa.int64()), ("c0", pa.int64())])

    def run(batches):
        for batch in batches:
            for a, b in groups_of(batch.column(0), GROUP_BYTES):             # few texts at a time are Python strings
                seen = {0: Counter(), 1: Counter()}
                for text, label in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist()):
                    seen[label].update(set(words_of(text)))
                words = list(seen[0].keys() | seen[1].keys())
                if not words:
                    continue
                code, _, sizes, at, joined = _codes(words, order)
                _, first, place = np.unique(code, return_index=True, return_inverse=True)
                counts = []
                for label in (1, 0):
                    c = np.fromiter((seen[label][w] for w in words), dtype=np.int64, count=len(words))
                    counts.append(np.bincount(place, weights=np.repeat(c, sizes)).astype(np.int64))
                grams = [joined[i:i + order] for i in at[first].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts[0]), pa.array(counts[1])], schema=schema)
        release_memory()

    return run


def gram_counts(labelled: DataFrame, text_col: str, label_col: str, order: int = ORDER) -> DataFrame:
    """(gram, c1, c0): in how many (document, word) occurrences of either class each gram lies, over all rows."""
    pairs = labelled.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y")).filter("t is not null and y in (0, 1)")
    parts = pairs.mapInArrow(_count_grams(order), "gram string, c1 long, c0 long")
    return parts.groupBy("gram").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))


def _shared(grams: DataFrame, order: int) -> DataFrame:
    """(tail, p): pooled Kneser-Ney probability of the last character of every observed gram of order - 1."""
    levels = []
    current = grams.select("gram")
    for n in range(order - 1, 0, -1):
        current = current.groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.append((n, current))
    lower = None
    for n, level in reversed(levels):
        if n == 1:
            total, kinds = level.agg(F.sum("n"), F.count(F.lit(1))).first()   # two numbers
            lower = level.select("gram", ((F.col("n") + 0.1) / F.lit((total or 0) + 0.1 * kinds + 1e-9)).alias("p"))
            continue
        head = F.substring("gram", 1, n - 1)
        context = level.groupBy(head.alias("head")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        lower = (level.withColumn("head", head).withColumn("tail", F.substring("gram", 2, n - 1)).join(context, "head")
                 .join(lower.select(F.col("gram").alias("tail"), "p"), "tail")
                 .select("gram", ((F.col("n") - SHARED_DISCOUNT + SHARED_DISCOUNT * F.col("kinds") * F.col("p")) / F.col("total")).alias("p")))
    return lower


def gram_ratios(grams: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio) and (head, ratio): log-likelihood ratio of every observed gram, and of an unseen character."""
    cut = lambda c: F.least(F.col(c).cast("double"), F.lit(discount))
    with_head = grams.withColumn("head", F.substring("gram", 1, order - 1)).withColumn("tail", F.substring("gram", 2, order - 1))
    heads = with_head.groupBy("head").agg(F.sum("c1").alias("n1"), F.sum("c0").alias("n0"), F.sum(cut("c1")).alias("d1"), F.sum(cut("c0")).alias("d0"))
    p = lambda c, n, d: F.when(F.col(n) > 0, (F.greatest(F.col(c) - discount, F.lit(0.0)) + F.col(d) * F.col("p")) / F.col(n)).otherwise(F.col("p"))
    seen = (with_head.join(heads, "head").join(_shared(grams, order).withColumnRenamed("gram", "tail"), "tail")
            .select("gram", (F.log(p("c1", "n1", "d1")) - F.log(p("c0", "n0", "d0"))).alias("ratio")))
    left = lambda n, d: F.when(F.col(n) > 0, F.log(F.col(d) / F.col(n))).otherwise(F.lit(0.0))
    unseen = heads.select("head", (left("n1", "d1") - left("n0", "d0")).alias("ratio"))
    return seen, unseen


def _table(frame: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and ratios of all entries."""

    @F.pandas_udf("long")
    def code(grams: pd.Series) -> pd.Series:
        return pd.Series([_code_of(g) - (1 << 63) for g in grams], dtype="int64")

    got = frame.select(code(key).alias("code"), "ratio").toArrow()          # two numbers an entry
    codes = got["code"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    if not len(codes):
        return np.zeros(1, dtype=np.uint64), np.zeros(1)
    at = np.argsort(codes)
    return codes[at], got["ratio"].to_numpy()[at]


def _code_of(chars: str) -> int:
    code, mask = 0, (1 << 64) - 1
    for ch in chars:
        code = ((code ^ (ord(ch) + 0x51ED27)) * 0x9E3779B97F4A7C15) & mask
        code ^= code >> 29
    return code


@dataclass
class ToxicityModel:
    order: int
    grams: tuple[np.ndarray, np.ndarray]
    heads: tuple[np.ndarray, np.ndarray]
    curve: tuple = None

    def parts(self) -> tuple:
        return self.order, self.grams, self.heads, self.curve

    def ratios(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio, toxic over ordinary, of each word."""
        if not words:
            return np.zeros(0)
        code, context, sizes, _, _ = _codes(words, self.order)
        out, missing = _look_up(self.grams, code)
        rest, _ = _look_up(self.heads, context[missing])
        out[missing] = rest
        return np.add.reduceat(out, np.cumsum(sizes) - sizes)

    def evidence(self, texts) -> np.ndarray:
        """One row of FEATURES for each text; the words' ratios are worked out once for many texts."""
        out, memo, group, fresh, held = np.zeros((len(texts), len(FEATURES))), {}, [], {}, 0

        def settle():
            memo.update(zip(fresh, self.ratios(list(fresh)).tolist()))
            for i, words in group:
                z = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
                out[i] = z.mean(), z.max(), np.log1p(SHARE * np.expm1(np.minimum(z, 50))).sum() / np.sqrt(len(z))
            group.clear()
            fresh.clear()
            if len(memo) > MEMO_WORDS:
                memo.clear()

        for i, text in enumerate(texts):
            words = list(dict.fromkeys(words_of(text)))
            if words:
                group.append((i, words))
                held += len(words)
                fresh.update((w, None) for w in words if w not in memo)
                if len(fresh) > NEW_WORDS or held > HELD_WORDS:
                    settle()
                    held = 0
        settle()
        return out

    def scores(self, texts) -> np.ndarray:
        mean, scale, beta, intercept = self.curve
        return 1 / (1 + np.exp(-np.clip((self.evidence(texts) - mean) / scale @ beta + intercept, -30, 30)))


def _look_up(table, codes):
    at = np.minimum(np.searchsorted(table[0], codes), len(table[0]) - 1)
    found = table[0][at] == codes
    return np.where(found, table[1][at], 0.0), ~found


@dataclass
class JoinedModel:
    """A model whose tables, (gram, ratio) and (head, ratio), stay DataFrames."""
    order: int
    grams: DataFrame
    heads: DataFrame
    curve: tuple = None

    def ratios(self, words: DataFrame) -> DataFrame:
        """(word, ratio) of distinct ``words`` (word)."""
        order = self.order
        schema = pa.schema([("word", pa.string()), ("gram", pa.string())])

        def run(batches):
            for batch in batches:
                found = batch.column(0).to_pylist()
                if found:
                    _, _, sizes, at, joined = _codes(found, order)
                    names = pa.array(found, pa.string()).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
                    yield pa.RecordBatch.from_arrays([names, pa.array([joined[i:i + order] for i in at.tolist()], pa.string())], schema=schema)

        grams = words.mapInArrow(run, "word string, gram string").withColumn("head", F.substring("gram", 1, order - 1))
        seen, unseen = self.grams.withColumnRenamed("ratio", "seen"), self.heads.withColumnRenamed("ratio", "unseen")
        both = grams.join(seen, "gram", "left").join(unseen, "head", "left")
        return both.groupBy("word").agg(F.sum(F.coalesce("seen", "unseen", F.lit(0.0))).alias("ratio"))

    def with_evidence(self, docs: DataFrame, text: Column, name: str) -> DataFrame:
        """``docs`` with their FEATURES as an array; worked out once for each distinct text."""
        key = F.sha2(F.coalesce(text, F.lit("")), 256)
        schema = pa.schema([("_key_", pa.string()), ("word", pa.string())])

        def run(batches):
            for batch in batches:
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = list(dict.fromkeys(words_of(t)))
                    if words:
                        yield pa.RecordBatch.from_arrays([pa.array([k] * len(words)), pa.array(words)], schema=schema)

        pairs = docs.select(key.alias("k"), text.alias("t")).mapInArrow(run, "_key_ string, word string").distinct()
        z = F.col("ratio")
        mixture = F.sum(F.log1p(SHARE * F.expm1(F.least(z, F.lit(50.0))))) / F.sqrt(F.count(F.lit(1)))
        found = (pairs.join(self.ratios(pairs.select("word").distinct()), "word").groupBy("_key_")
                 .agg(F.array(F.avg(z), F.max(z), mixture).alias("_found_")))
        zero = F.array(*[F.lit(0.0)] * len(FEATURES))
        return (docs.withColumn("_text_key_", key).join(found, F.col("_text_key_") == F.col("_key_"), "left")
                .select(*[c for c, n in zip(all_columns(docs), docs.columns) if n != name], F.coalesce("_found_", zero).alias(name)))


def _model(labelled, text_col, label_col, order, max_shipped) -> ToxicityModel | JoinedModel:
    grams = written(gram_counts(labelled, text_col, label_col, order), "toxic-grams")
    seen, unseen = gram_ratios(grams, order)
    heads = grams.select(F.substring("gram", 1, order - 1)).distinct().count()
    if grams.count() + heads <= max_shipped:
        return ToxicityModel(order, _table(seen, "gram"), _table(unseen, "head"))
    return JoinedModel(order, written(seen, "toxic-ratios"), written(unseen, "toxic-heads"))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", part: Column | None = None, *,
        order: int = ORDER, max_shipped: int = MAX_SHIPPED, max_curve_rows: int = 50_000, id_col: str = "doc_id") -> ToxicityModel | JoinedModel:
    """Fit both models on all rows of ``labelled``.

    ``part`` (a condition on the rows) marks the share used for the curve: a first pair of models is counted without
it, its documents' evidence under those models gives the curve (from at most about ``max_curve_rows`` of them,
    chosen by the hash of ``id_col`` and text, so copies of one text do not come all together), and the final models
    are counted on all rows.  Without ``part`` a fifth by the hash of the text is used.
    """
    part = F.pmod(F.xxhash64(F.col(text_col)), F.lit(5)) == 0 if part is None else part
    rows = labelled.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y"), part.alias("part"), row_key(labelled, id_col, text_col).alias("key")).filter("t is not null and y in (0, 1)")
    first = _model(rows.filter("not part"), "t", "y", order, max_shipped)
    n = rows.filter("part").count()
    share = min(1.0, max_curve_rows / max(n, 1))
    chosen = rows.filter("part") if share == 1.0 else rows.filter(F.col("part") & (F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)))).limit(2 * max_curve_rows)
    if isinstance(first, JoinedModel):
        seen = first.with_evidence(chosen.select("t", "y"), F.col("t"), "x").select("x", "y").toPandas()
    else:
        shared = rows.sparkSession.sparkContext.broadcast(first.parts())

        @F.pandas_udf("array<double>")
        def evidence(texts: pd.Series) -> pd.Series:
            return pd.Series(list(ToxicityModel(*shared.value).evidence(texts)))

        seen = chosen.select(evidence("t").alias("x"), "y").toPandas()
    x = np.array(seen["x"].tolist()).reshape(-1, len(FEATURES))
    curve = logistic(x, seen["y"].to_numpy(dtype=float), np.ones(len(x)))
    model = _model(rows, "t", "y", order, max_shipped)
    model.curve = curve
    return model


def score(model: ToxicityModel, spark, text: Column) -> Column:
    """The score of a text column, as a column; for a model whose tables are shipped."""
    shared = spark.sparkContext.broadcast(model.parts())

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(*shared.value)
        for texts in batches:
            yield pd.Series(own.scores(texts))
        release_memory()

    return scored(text)


def with_score(docs: DataFrame, model: ToxicityModel | JoinedModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of their texts as column ``name``, whichever way the model is looked up."""
    if isinstance(model, ToxicityModel):
        return docs.withColumn(name, score(model, docs.sparkSession, F.col(text_col)))
    mean, scale, beta, intercept = model.curve
    total = F.lit(float(intercept))
    for i in range(len(FEATURES)):
        total = total + (F.get("_evidence_", F.lit(i)) - float(mean[i])) / float(scale[i]) * float(beta[i])
    found = model.with_evidence(docs, F.col(text_col), "_evidence_")
    return found.withColumn(name, 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))).drop("_evidence_")
