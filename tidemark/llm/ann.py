"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hash tables has ``hashes`` functions floor((a.v + b) / width) with normally distributed a; vectors
are scaled to unit length, so the nearest by distance are those of largest cosine.  A query looks into its own bucket
of every table and into buckets whose functions are shifted by one down or up.  How likely a shifted bucket holds a
near vector falls with the sum of squared distances from the query to the boundaries it crosses; buckets are visited
in that order, ``probes`` of each table, with at most three functions shifted.  The candidates of all tables are merged
and compared exactly, in double precision, on the original vectors.

How selective the tables may be depends on the data, so functions, width and probes are fitted: the true neighbours of
``SAMPLE_QUERIES`` queries are found by one exact pass over all rows, and of the settings tried the one is taken that
finds ``target`` of them with the fewest candidates among ``SAMPLE_ROWS`` rows (both samples are chosen by hash, for
each length of vectors).  Only these settings come from a sample; every row is indexed and every query asked.

Rows and queries meet in blocks: the index is built over every row, where the row lies, and blocks of at most
``query_block`` query vectors and ``QUERY_BYTES`` bytes (a bounded broadcast) visit it.  Equal vectors are folded first,
keeping the k + 1 smallest ids: ties go to smaller ids, so no answer needs more.  Each task returns its best k + 1 for
a query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; only vectors of
the query's length are its candidates; a row that repeats id and vector counts once; an id is never its own answer;
ties go to the smaller id; an empty table gives an empty result.  Only the id and vector columns are read.
"""
from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

ROWS = 8192                  # rows indexed at once in a task
QUERIES = 1024               # queries compared with them at once
QUERY_BYTES = 32 << 20       # vectors of a block of queries
SAMPLE_QUERIES, SAMPLE_ROWS = 64, 2048
LOOSE = {"hashes": 4, "width": 1.5, "probes": 12}


class Tables:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng((seed, dim))
        self.lines = rng.standard_normal((tables, dim, hashes))
        self.shift = rng.uniform(0, 1, (tables, hashes))
        self.mix = rng.integers(1, 1 << 62, hashes, dtype=np.int64) | 1
        self.width, self.probes, self.tables = width, probes, tables
        self.moves = np.array([[dict(zip(at, steps)).get(h, 0) for h in range(hashes)] for n in range(min(3, hashes) + 1)
                               for at in combinations(range(hashes), n) for steps in product((-1, 1), repeat=n)], dtype=np.int64)

    def _places(self, unit: np.ndarray, t: int) -> np.ndarray:
        return unit @ self.lines[t] / self.width + self.shift[t]

    def _codes(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mix).sum(-1)

    def buckets(self, unit: np.ndarray, t: int) -> np.ndarray:
        return self._codes(np.floor(self._places(unit, t)).astype(np.int64))

    def visits(self, unit: np.ndarray, t: int) -> np.ndarray:
        """Buckets that each query visits in table ``t``, the likeliest first."""
        place = self._places(unit, t)
        cell = np.floor(place)
        below = place - cell
        cost = below ** 2 @ (self.moves == -1).T + (1 - below) ** 2 @ (self.moves == 1).T
        first = np.argpartition(cost, min(self.probes, cost.shape[1]) - 1, axis=1)[:, :self.probes]
        first = np.take_along_axis(first, np.take_along_axis(cost, first, 1).argsort(axis=1, kind="stable"), 1)
        return self._codes(cell.astype(np.int64)[:, None, :] + self.moves[first])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of every row of x with q; a row's figure does not depend on the other rows."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def _candidates(hashed: Tables, cells: list, unit_q: np.ndarray) -> np.ndarray:
    """Which rows are candidates of which queries; ``cells`` holds each table's buckets and every row's place in them."""
    near = np.zeros((len(cells[0][1]), -(-len(unit_q) // 8)), dtype=np.uint8)          # a bit for each query
    for t, (codes, cell_of) in enumerate(cells):
        seen = hashed.visits(unit_q, t)
        at = np.minimum(np.searchsorted(codes, seen), len(codes) - 1)
        hit, table = codes[at] == seen, np.zeros((len(codes), len(unit_q)), dtype=bool)
        table[at[hit], np.broadcast_to(np.arange(len(unit_q))[:, None], at.shape)[hit]] = True
        near |= np.packbits(table, axis=1)[cell_of]
    return np.unpackbits(near, axis=1, count=len(unit_q)).T.astype(bool)


def _index(hashed: Tables, unit: np.ndarray) -> list:
    return [np.unique(hashed.buckets(unit, t), return_inverse=True) for t in range(hashed.tables)]


def _best(x: np.ndarray, unit: np.ndarray, ids: list, cand: np.ndarray, q: np.ndarray, unit_q: np.ndarray, k: int):
    """The k best of the candidates (place, exact cosine), ties to the smaller first id."""
    rough = unit[cand] @ unit_q
    if len(cand) > k:
        cand = cand[rough >= np.partition(rough, -k)[-k] - 1e-9]
    exact = cosines(x[cand], q)
    return [(cand[j], float(exact[j])) for j in sorted(range(len(cand)), key=lambda j: (-exact[j], ids[cand[j]][0]))[:k]]


def _visit(queries: dict[int, np.ndarray], query_keys: dict[int, list], k: int, options: dict[int, dict] | None):
    """Rows (vec, ids) in; for each query vector its best rows of this task out.  Without ``options`` all rows are candidates."""
    names = ["query", "ids", "score"]

    def block(dim, vectors, ids):
        x, q = np.array(vectors), queries[dim]
        unit, unit_q = _unit(x), _unit(q)
        hashed = Tables(dim, **options[dim]) if options else None
        cells = _index(hashed, unit) if options else None
        for start in range(0, len(q), QUERIES):
            some = unit_q[start:start + QUERIES]
            near = _candidates(hashed, cells, some) if options else np.ones((len(some), len(x)), dtype=bool)
            for i, found in enumerate(near, start):
                for j, score in _best(x, unit, ids, np.flatnonzero(found), q[i], unit_q[i], k):
                    yield query_keys[dim][i], ids[j], score

    def run(batches):
        held = {}
        for batch in batches:
            for vec, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(vec) in queries:
                    rows = held.setdefault(len(vec), ([], []))
                    rows[0].append(vec)
                    rows[1].append(ids)
                    if len(rows[0]) >= ROWS:
                        yield from table(list(block(len(vec), *held.pop(len(vec)))))
        for dim, rows in held.items():
            yield from table(list(block(dim, *rows)))

    def table(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.float64())], names=names)

    return run


def settings(radius: float):
    """The settings that are tried, for each number of functions from the widest cells to the narrowest; widths go
    with the usual distance of a k-th neighbour."""
    for hashes, probes in ((4, 12), (8, 40), (10, 80), (12, 100)):
        yield [{"hashes": hashes, "width": wide * radius, "probes": probes} for wide in (2.0, 1.9, 1.8, 1.7, 1.6, 1.4, 1.2)]


def fitted(rows: np.ndarray, queries: np.ndarray, neighbours: list[np.ndarray], target: float, tables: int, seed: int) -> dict:
    """The setting that finds ``target`` of the queries' true neighbours with the fewest candidates among ``rows``.

    Returns it with the ``recall`` and the ``share`` of candidates measured on the sample.
    """
    unit_q, true = _unit(queries), _unit(np.concatenate(neighbours))
    both = np.concatenate([true, _unit(rows)])
    owner = np.repeat(np.arange(len(queries)), [len(n) for n in neighbours])
    far = [np.linalg.norm(_unit(n) - q, axis=1).max() for n, q in zip(neighbours, unit_q) if len(n)]

    def measured(setting):
        hashed = Tables(queries.shape[1], tables=tables, seed=seed, **setting)
        near = _candidates(hashed, _index(hashed, both), unit_q)
        return {**setting, "recall": float(near[owner, np.arange(len(true))].mean()), "share": float(near[:, len(true):].mean())}

    best = measured(LOOSE)
    for narrowing in settings(max(float(np.median(far)), 1e-3)):
        for setting in narrowing:
            tried = measured(setting)
            if tried["recall"] < target:
                break                                # narrower cells find fewer
            best = min(best, tried, key=lambda s: s["share"])
    return best


def fit(folded: DataFrame, asked: DataFrame, k: int, target: float, tables: int, seed: int) -> dict[int, dict]:
    """The setting for each length of vectors; a length too rare for the samples takes ``LOOSE``."""
    def few(df, n):
        """At most n rows of a length: one hash class, of about 2 n rows whatever the table's size, cut by hash."""
        code = F.xxhash64("vec")
        some = df.filter(F.pmod(code, F.lit(max(1, df.count() // (2 * n)))) == 0)
        return some.withColumn("_n", F.row_number().over(Window.partitionBy(F.size("vec")).orderBy(code))).filter(F.col("_n") <= n)
    sample: dict[int, list] = {}
    for r in few(folded.select("vec"), SAMPLE_ROWS).collect():
        sample.setdefault(len(r["vec"]), []).append(r["vec"])
    vectors, keys = _by_length(few(asked, SAMPLE_QUERIES).collect())
    if not vectors:
        return {}
    found = folded.mapInArrow(_visit(vectors, keys, k + 1, None), "query long, ids array<long>, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).select("query", F.col("ids")[0].alias("id"))
    near: dict[int, list] = {}
    for r in folded.select("vec", F.col("ids")[0].alias("id")).join(F.broadcast(best), "id").select("query", "vec").collect():
        near.setdefault(r["query"], []).append(r["vec"])
    out = {}
    for dim, q in vectors.items():
        others = [np.array([v for v in near.get(key, []) if v != list(own)]).reshape(-1, dim) for key, own in zip(keys[dim], q)]
        options = fitted(np.array(sample[dim]), q, others, target, tables, seed) if any(len(o) for o in others) else dict(LOOSE)
        out[dim] = options
    return out


def _by_length(rows) -> tuple[dict[int, np.ndarray], dict[int, list]]:
    """Query vectors and their keys by the vectors' length."""
    vectors, keys = {}, {}
    for r in rows:
        vectors.setdefault(len(r["vec"]), []).append(r["vec"])
        keys.setdefault(len(r["vec"]), []).append(r["query"])
    return {d: np.array(v) for d, v in vectors.items()}, keys


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 5,
           tables: int = 48, setting: dict | None = None, target: float = 0.95, seed: int = 17, query_block: int = 16384) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows found for every row where ``is_query`` holds.

    ``setting`` (hashes, width, probes) is fitted where it is not given.
    """
    spark = rows.sparkSession
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)).distinct())
    good = written(good, "vectors")
    smallest = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    folded = written(good.withColumn("n", smallest).filter(F.col("n") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "folded")
    asked = written(good.filter("q").select("vec").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec") * F.lit(8)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // query_block), -(-(size["bytes"] or 0) // QUERY_BYTES))
    chosen = {} if setting or not size["n"] else fit(folded, asked, k, target, tables, seed)
    best = None
    for b in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).orderBy("query").collect() if blocks > 1 else asked.orderBy("query").collect()
        vectors, keys = _by_length(some)
        options = {d: {"tables": tables, "seed": seed, **{n: (setting or chosen.get(d, LOOSE))[n] for n in LOOSE}} for d in vectors}
        found = folded.mapInArrow(_visit(vectors, keys, k + 1, options), "query long, ids array<long>, score double")
        found = found.select("query", "score", F.explode("ids").alias("id"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        part = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
        part = written(part, "nearest") if blocks > 1 else part
        best = part if best is None else best.union(part)
    ask = good.filter("q").select(F.col("id").alias("query_id"), "vec").join(asked, "vec").select("query_id", "query")
    pairs = ask.join(best, "query").filter("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return pairs.select("query_id", rank.alias("rank"), "id", "score").filter(F.col("rank") <= k)
