"""Quality classification by supervised subword embeddings.

A document is the average of learned vectors, looked up by hash: one for every token (split at white space, case and
punctuation kept), one for every character n-gram of a token, and one for every pair of neighbouring tokens.  Pairs
of the same token share one vector, so plain repetition is a feature of its own.  A softmax layer on the average
gives the class shares.  Vectors and layer are trained together by stochastic gradient descent in numpy.

The classifier is fitted on a bounded sample of the labelled rows: at most about ``max_rows`` rows and ``max_chars``
characters, whole texts, chosen by the hash of the text.  Scoring reads every whole text.  Because average and layer
are linear up to the softmax, scoring needs one number per vector (the difference of the two classes).

Defined cases: null text counts as empty; a text without tokens is scored from the layer's intercept alone; repeated
rows are scored each; an empty table gives an empty result; without labelled rows all scores are 0.5.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import row_key

BUCKETS = 1 << 16
REPEATED = 0              # bucket of a pair of equal tokens
GRAMS = (3, 4, 5)
DIM = 12
GROUP_WORDS = 60_000       # different tokens whose features are worked out together
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x * _PRIME
        x ^= x >> np.uint64(31)
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, word number of each bucket, 64-bit code of each word) of the words and their character n-grams."""
    sizes = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    joined = "".join(f"\x02{w}\x03" for w in words)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    left = np.repeat(starts + sizes, sizes) - np.arange(len(cp))      # characters up to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    buckets, owners = [], []
    code = np.zeros(len(cp), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        keep = left >= n
        at = np.flatnonzero(keep)
        code[at] = _mix(code[at] ^ (cp[at + n - 1] + np.uint64(n << 32)))
        if n in GRAMS:
            buckets.append(_bucket(code[at]))
            owners.append(owner[at])
    with np.errstate(over="ignore"):
        place = np.arange(len(cp), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
        whole = _mix(np.add.reduceat(_mix(cp + (place << np.uint64(32))), starts)) if len(words) else np.zeros(0, np.uint64)
    buckets.append(_bucket(whole))
    owners.append(np.arange(len(words)))
    return np.concatenate(buckets), np.concatenate(owners), whole


def pair_buckets(codes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring tokens, given the codes of a text's tokens."""
    a, b = codes[:-1], codes[1:]
    with np.errstate(over="ignore"):
        return np.where(a == b, REPEATED, _bucket(_mix(a * np.uint64(3) + b)))


def _sparse(texts: pd.Series) -> pd.Series:
    """Each text as {bucket: share of all its features}, two parallel arrays."""
    out = []
    for t in texts:
        tokens = t.split() if t else []
        if not tokens:
            out.append({"b": np.zeros(0, np.int32), "w": np.zeros(0, np.float32)})
            continue
        words, place = np.unique(np.array(tokens, dtype=object), return_inverse=True)
        buckets, owner, code = word_features(list(words))
        times = np.bincount(place)
        weight = np.bincount(buckets, weights=times[owner], minlength=BUCKETS)
        if len(tokens) > 1:
            weight += np.bincount(pair_buckets(code[place]), minlength=BUCKETS)
        b = np.flatnonzero(weight)
        out.append({"b": b.astype(np.int32), "w": (weight[b] / weight.sum()).astype(np.float32)})
    return pd.DataFrame(out, columns=["b", "w"])


@dataclass
class QualityModel:
    weight: np.ndarray        # per bucket: how much it speaks for class 1
    intercept: float

    def scores(self, texts) -> np.ndarray:
        out, group, known = np.full(len(texts), self.intercept), [], {}

        def settle():
            buckets, owner, code = word_features(list(known))
            total = np.bincount(owner, weights=self.weight[buckets], minlength=len(known))
            feats = np.bincount(owner, minlength=len(known))
            for i, at in group:
                pairs = pair_buckets(code[at])
                out[i] += (total[at].sum() + self.weight[pairs].sum()) / (feats[at].sum() + len(pairs))
            group.clear()
            known.clear()

        for i, text in enumerate(texts):
            tokens = text.split() if text else []
            if tokens:
                for w in dict.fromkeys(tokens):
                    known.setdefault(w, len(known))
                group.append((i, np.fromiter(map(known.__getitem__, tokens), dtype=np.int32, count=len(tokens))))
                if len(known) > GROUP_WORDS:
                    settle()
        if group:
            settle()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, dim: int = DIM, epochs: int = 12,
          rate: float = 4.0, seed: int = 1) -> QualityModel:
    """Vectors and softmax layer by stochastic gradient descent, one document a step, the rate falling to zero."""
    if not len(docs):
        return QualityModel(np.zeros(BUCKETS), 0.0)
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1, 1, (BUCKETS, dim)).astype(np.float32) / dim
    layer, bias = np.zeros((dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            lr = rate * (1 - done / steps)
            done += 1
            b, w = docs[i]
            mean = w @ vec[b] if len(b) else np.zeros(dim, dtype=np.float32)
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            back = layer @ p
            layer -= lr * np.outer(mean, p)
            bias -= 0.1 * lr * p
            if len(b):
                vec[b] -= (lr * w)[:, None] * back
    return QualityModel(vec.astype(np.float64) @ (layer[:, 1] - layer[:, 0]).astype(np.float64), float(bias[1] - bias[0]))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "quality", *, max_rows: int = 4000,
        max_chars: int = 16_000_000, id_col: str = "doc_id", **training) -> QualityModel:
    """Fit on a sample of about ``max_rows`` rows and ``max_chars`` characters of ``labelled``, never twice as many rows.

    Rows are chosen by the hash of ``id_col`` and text, so copies of one text do not come all together.
    """
    rows = labelled.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y"), row_key(labelled, id_col, text_col).alias("key")).filter("t is not null and y in (0, 1)")
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    share = min(1.0, max_rows / max(n, 1), max_chars / max(chars, 1))
    pick = F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30))
    sparse = F.pandas_udf(_sparse, "b array<int>, w array<float>")
    got = (rows if share == 1.0 else rows.filter(pick).limit(2 * max_rows)).select(sparse("t").alias("f"), "y").select("f.b", "f.w", "y").toArrow()
    docs = [(b.values.to_numpy(), w.values.to_numpy(), y.as_py()) for b, w, y in zip(got["b"], got["w"], got["y"])]
    docs.sort(key=lambda d: (len(d[0]), d[0].tobytes(), d[2]))                # the same fit for any row order
    return train([d[:2] for d in docs], np.array([d[2] for d in docs]), **training)


def score(model: QualityModel, spark, text: Column) -> Column:
    """The share of class 1 for a text column, as a column."""
    shared = spark.sparkContext.broadcast((model.weight, model.intercept))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(QualityModel(*shared.value).scores(list(texts)))

    return scored(text)
