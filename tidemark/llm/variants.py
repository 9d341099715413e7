"""Spelling variants of a corpus' words: pairs one edit apart, the commoner form of each, and the form at the chain's end.

Near words (one inserted, deleted or replaced code point) are found by dynamic programming over the sorted vocabulary.
The list of a group is read as ranges that share a prefix, which adjacent longest common prefixes delimit.  For every
query word a range needs one row of the edit matrix, cut to the band of three cells around the diagonal; the rows of
the next character go on from it, so a prefix that many words share is worked out once.  As soon as all cells of a
row exceed one edit, the query skips the whole range.  All queries of a block go one character deeper together.

The vocabulary is dealt into groups that surely hold both words of a pair.  With m the shorter length, an edit lies
before or after character m / 2: pairs of the second kind share the characters before it, pairs of the first kind those
after.  Each word therefore joins, for m = its length and one less, the group of its beginning and that of its end,
and a pair is found in exactly one group, by the place of its first difference.  A group of more than ``max_group`` words
is dealt anew by halves of the stretch that may hold the edit, until it fits or the stretch is one character, where
the words of the group differ only there; nothing is left out, and no task holds more than a group.

Counts are folded within each batch before they are shuffled; common words are one row a batch.  Chains of forms are
followed by joining the table of forms with itself, doubling the way each time.

Defined cases: a null text has no words; a null id is written as empty text in the deletion rule; repeated rows count
each; among near words with equal counts the smallest in code-point order is the form; an empty table gives an empty
result.  Only the id and text are read.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .byte_words import Words, cut, groups_of, shift
from .common import written

MAX_GROUP = 8192               # words whose rows are worked out together
BLOCK_ROWS = 20_000            # rows of small groups scanned at once
LETTER = np.zeros(256, dtype=bool)
LETTER[0x61:0x7B] = True
LEAD = 0xC3                    # first byte of U+00C0 to U+00FF in UTF-8


def _inside(data: np.ndarray) -> np.ndarray:
    lead = data == LEAD
    inside = LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def words_of(texts: pa.Array) -> Words:
    return cut(texts, _inside)


def _count(drop_every: int | None, min_length: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            prefix = pc.binary_join_element_wise(pc.fill_null(batch.column(0), ""), pa.scalar(""), pa.scalar(":"))
            for a, b in groups_of(texts):
                words = words_of(texts.slice(a, b - a))
                if not len(words.row):
                    continue
                coded = words.strings().dictionary_encode()
                kinds, code = coded.dictionary, coded.indices.to_numpy()
                count = np.bincount(code, minlength=len(kinds))
                lengths = pc.utf8_length(kinds)
                changed = []
                if drop_every:
                    own = _crc_of(kinds)
                    head = np.array([zlib.crc32(p.as_py().encode()) for p in prefix.slice(a, b - a)], dtype=np.uint32)
                    h = shift(head[words.row], words.size) ^ own[code]
                    hit = np.flatnonzero(h % drop_every == 0)
                    count -= np.bincount(code[hit], minlength=len(kinds))
                    for w, x in zip(kinds.take(pa.array(code[hit])).to_pylist(), h[hit].tolist()):
                        at = x % len(w)
                        changed.append(w[:at] + w[at + 1:])
                keep = np.flatnonzero((lengths.to_numpy() >= min_length) & (count > 0))
                yield pa.RecordBatch.from_arrays([kinds.take(pa.array(keep)).cast(pa.string()), pa.array(count[keep])], names=["word", "n"])
                changed = [w for w in changed if len(w) >= min_length]
                yield pa.RecordBatch.from_arrays([pa.array(changed, pa.string()), pa.array([1] * len(changed), pa.int64())], names=["word", "n"])

    return run


def _crc_of(kinds: pa.Array) -> np.ndarray:
    """CRC-32 of whole strings of letters."""
    edges = np.frombuffer(kinds.buffers()[1], dtype=np.int64)[kinds.offset:kinds.offset + len(kinds) + 1]
    data = np.frombuffer(kinds.buffers()[2], dtype=np.uint8)
    return Words(data, edges[:-1], np.diff(edges), np.arange(len(kinds))).crc()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, drop_every: int | None = None,
                min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n): runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z lower-cased, with their occurrences.

    With ``drop_every``, h is the CRC-32 of `<id>:<run>`, and a run whose h it divides loses the code point h % length.
    Words under ``min_length`` code points or ``min_count`` occurrences are left out.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t")).filter("t is not null")
    parts = rows.mapInArrow(_count(drop_every, min_length), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _steps() -> np.ndarray:
    """The next band of cells (each at most 2) from a band and the three comparisons: new state at 8 * state + bits."""
    table = np.zeros(27 * 8, dtype=np.uint8)
    for state in range(27):
        x, y, z = state // 9, state // 3 % 3, state % 3
        for bits in range(8):
            nx = min(x + (not bits & 1), y + 1, 2)
            ny = min(y + (not bits >> 1 & 1), z + 1, nx + 1, 2)
            nz = min(z + (not bits >> 2 & 1), ny + 1, 2)
            table[state * 8 + bits] = nx * 9 + ny * 3 + nz
    return table


STEPS = _steps()
START, OVER = 1 * 9 + 0 * 3 + 1, 26                      # one edit beside the diagonal and none on it; all cells over one edit
CELL = np.array([[s // 9, s // 3 % 3, s % 3] for s in range(27)], dtype=np.uint8)


def scan(codes: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray, lo: int, hi: int, m: int):
    """(query, near): places in the lists of words that are one edit apart.

    ``codes`` holds the words' code points, each word followed by at least two zeros; the words of each group are
    distinct and sorted, have m or m + 1 characters and share their first ``lo``.  Pairs first differ at a character
    from ``lo`` to before ``hi`` and are not both longer than m.
    """
    rows = len(start)
    same = np.zeros(rows, dtype=bool)
    same[1:] = group[1:] == group[:-1]
    lcp = np.where(same, lo, -1)                         # with the word before, in its group
    going = np.flatnonzero(same)
    for d in range(lo, m + 1):
        if not len(going):
            break
        a, b = codes[start[going] + d], codes[start[going - 1] + d]
        going = going[(a == b) & (a != 0)]
        lcp[going] = d + 1
    heads = np.flatnonzero(lcp < 0)
    members = np.diff(np.append(heads, rows))
    query = np.arange(rows)
    node = np.repeat(heads, members)                     # first word of the range
    state = np.full(rows, START, dtype=np.int64)
    begins = heads
    out_q, out_n = [], []
    for d in range(lo, m + 2):
        if not len(query):
            break
        if d == hi:                                      # equal up to here: this pair's difference lies outside
            open_ = CELL[state, 1] > 0
            query, node, state = query[open_], node[open_], state[open_]
        deeper = np.flatnonzero(lcp < d + 1)             # first words of the ranges one character longer
        first = np.searchsorted(deeper, node)
        after = np.append(begins, rows)[np.searchsorted(begins, node) + 1]
        kids = np.searchsorted(deeper, after) - first
        pair = np.repeat(np.arange(len(query)), kids)
        child = deeper[np.repeat(first - np.cumsum(kids) + kids, kids) + np.arange(len(pair))]
        query, state = query[pair], state[pair]
        c = codes[start[child] + d]
        ended = c == 0                                   # a word of d characters; it is the first of its range
        done = np.flatnonzero(ended & (child != query))
        if len(done):
            q, w = query[done], child[done]
            gap = size[q] - d
            near = (np.abs(gap) <= 1) & ~((d > m) & (size[q] > m))
            near[near] = CELL[state[done][near], gap[near] + 1] == 1
            out_q.append(q[near])
            out_n.append(w[near])
        on = np.flatnonzero(~ended)
        query, node, state, c = query[on], child[on], state[on], c[on]
        at = start[query] + np.minimum(d, size[query])   # past a word's end there are zeros only
        bits = (codes[at - 1] == c) * ((d > 0) & (d <= size[query])) + 2 * (codes[at] == c) + 4 * (codes[at + 1] == c)
        state = STEPS[state * 8 + bits].astype(np.int64)
        begins = deeper
        alone = np.append(deeper, rows)[np.searchsorted(deeper, node) + 1] - node == 1
        live = np.flatnonzero((state != OVER) & ~(alone & (node == query)))
        query, node, state = query[live], node[live], state[live]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *out_q]), np.concatenate([none, *out_n])


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, each after one zero and before two, and where they start and how long they are."""
    size = pc.utf8_length(words).to_numpy().astype(np.int64)
    joined = pc.binary_join_element_wise(pa.scalar("\0", words.type), words, pa.scalar("\0\0", words.type), pa.scalar("", words.type))
    codes = np.frombuffer("".join(joined.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    return codes, np.cumsum(size + 3) - size - 2, size


def _scan_groups(batches):
    """Rows (m, lo, hi, key, word, n) sorted by group and word; (word, near, near_n) of all near pairs, either way."""
    held = None

    def found(table: pa.Table):
        for block in _blocks(table):
            m, lo, hi = (block.column(i)[0].as_py() for i in range(3))
            words = block.column("word").combine_chunks()
            codes, start, size = _flat(words)
            group = block.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
            q, w = scan(codes, start, size, group, lo, hi, m)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(q)), words.take(pa.array(w)),
                                              block.column("n").combine_chunks().take(pa.array(w))], names=["word", "near", "near_n"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < BLOCK_ROWS:
            continue
        last = _last_group(held)                         # may go on in the next batch
        if last:
            yield from found(held.slice(0, last))
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield from found(held)


def _starts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row begins a group, and whether it begins a stretch (m, lo, hi)."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    stretch = new.copy()
    for i in range(3):
        v = table.column(i).to_numpy()
        stretch[1:] |= v[1:] != v[:-1]
    key = table.column("key").combine_chunks()
    new[1:] = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
    return new | stretch, stretch


def _last_group(table: pa.Table) -> int:
    return int(np.flatnonzero(_starts(table)[0])[-1])


def _blocks(table: pa.Table):
    """Parts of whole groups of one stretch, of about BLOCK_ROWS rows; words that are alone in their group go."""
    new, stretch = _starts(table)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, table.num_rows))
    kept = table.filter(pa.array(np.repeat(sizes > 1, sizes)))
    number = np.cumsum(stretch)[heads][sizes > 1]
    sizes = sizes[sizes > 1]
    first = at = 0
    for i, n in enumerate(sizes.tolist()):
        if at > first and (number[i] != number[i - 1] or at + n - first > BLOCK_ROWS):
            yield kept.slice(first, at - first)
            first = at
        at += n
    if at > first:
        yield kept.slice(first, at - first)


def _key(m: Column, lo: Column, hi: Column) -> Column:
    """What both words of a pair share whose edit lies from ``lo`` to before ``hi``: all before and all after."""
    return F.concat(F.expr("substring(word, 1, lo)"), F.when(hi < m, F.expr("right(word, m - hi)")).otherwise(F.lit("")))


def _dealt(rows: DataFrame, stretches: Column) -> DataFrame:
    """Each row once for every stretch (m, lo, hi) of the array, with the key of its group."""
    at = rows.select("word", "n", F.explode(stretches).alias("s")).select("word", "n", "s.m", "s.lo", "s.hi")
    return at.select("m", "lo", "hi", _key(F.col("m"), F.col("lo"), F.col("hi")).alias("key"), "word", "n")


def near_pairs(vocabulary: DataFrame, *, max_group: int = MAX_GROUP) -> DataFrame:
    """(word, near, near_n): all pairs of distinct words (``word``, ``n``) one edit apart, either way round."""
    group = ["m", "lo", "hi", "key"]
    stretch = lambda m, lo, hi: F.struct(m.alias("m"), lo.alias("lo"), hi.alias("hi"))
    length, none = F.length("word"), F.lit(0)
    half = lambda m: (m / 2).cast("int")
    halves = [stretch(m, *edges) for m in (length, length - 1) for edges in ((none, half(m)), (half(m), m + 1))]
    rows = _dealt(vocabulary, F.array(*halves))
    ready = None
    while True:
        crowded = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("size")).filter((F.col("size") > max_group) & (F.col("hi") - F.col("lo") > 1))
        crowded = written(crowded.select(*group), "variant-groups")
        if crowded.isEmpty():
            break
        fits = rows.join(crowded, group, "left_anti")
        ready = fits if ready is None else ready.unionByName(fits)
        middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        again = rows.join(crowded, group, "left_semi").withColumn("mid", middle)
        parts = F.array(stretch(F.col("m"), F.col("lo"), F.col("mid")), stretch(F.col("m"), F.col("mid"), F.col("hi")))
        rows = written(_dealt(again, parts), "variant-rows")
    ready = rows if ready is None else ready.unionByName(rows)
    sorted_ = ready.repartition(*group).sortWithinPartitions(*group, "word")
    return sorted_.mapInArrow(_scan_groups, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last; each round doubles the way."""
    at = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = at.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        moved = at.join(onward, at["root"] == onward["via"], "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("via").isNotNull().alias("moved"))
        moved = written(moved, "variant-roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def group(vocabulary: DataFrame, *, ratio: int = 5, max_group: int = MAX_GROUP) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``vocabulary`` (word, n).

    ``form`` is the near word with the largest n (ties: the smallest), if that is at least ``ratio`` times the word's
    own; ``root`` is reached by following forms, which end as n rises each time.
    """
    words = written(vocabulary, "vocabulary")
    near = near_pairs(words, max_group=max_group)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    joined = written(joined, "variant-forms")
    ends = roots(joined.filter("form is not null"))
    return joined.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
