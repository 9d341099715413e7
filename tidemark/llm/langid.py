"""Language identification by compression.

Every language has a zstandard dictionary of raw content: excerpts of its training documents.  A text is compressed
with each dictionary in turn, in pieces, and the language with the fewest bytes wins: a dictionary that knows the
language's letter sequences saves more.  The margin is the runner-up's excess over the winner, as a share of the
runner-up; a margin under ``min_margin`` is rejected.

The dictionaries are fitted on a bounded sample: for each language ``excerpts`` different documents chosen by hash,
one excerpt of at most ``excerpt_chars`` characters of each, taken at a place that its hash sets.  The prediction
reads every whole text; only letters count, in lower case.

A prepared dictionary takes about 2 MB, so each one goes over a group of texts before the next one has its turn and
stays in the processor's cache meanwhile.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ties go to the language whose name
sorts first, with margin 0; with a single learned language its margin is 0; with none everything is ``und``;
repeated rows are predicted each; an empty table gives an empty result.
"""
from __future__ import annotations

import re

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

UNDECIDED = "und"
PIECE = 8192                       # bytes compressed at once
GROUP_BYTES = 1_000_000            # texts of about so many bytes are compressed by one dictionary after the other
LEVEL = 13
LETTERS = re.compile(r"[^\W\d_]+")
LATIN = bytes(b if LETTERS.match(chr(b)) else 0x20 for b in range(256))      # Latin-1 characters that are no letters as spaces


def normal(text: str | None) -> bytes:
    """The letters of a text in lower case, runs of other characters as one space."""
    lower = text.lower() if text else ""
    try:
        found = b" ".join(lower.encode("latin-1").translate(LATIN).split()).decode("latin-1")
    except UnicodeEncodeError:                                                   # characters past Latin-1
        found = " ".join(LETTERS.findall(lower))
    return found.encode("utf-8", "replace") if any(map(str.isalpha, found)) else b""          # numerals alone are no letters


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", *, excerpts: int = 64,
        excerpt_chars: int = 1024) -> dict[str, bytes]:
    """{language: dictionary content} from the rows' texts and non-null languages."""
    docs = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t")).filter("lang is not null and length(t) > 0")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}    # a row for each language
    if not sizes:
        return {}
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, 40 * excerpts / n) * (1 << 30)))])
    h = F.xxhash64("t", F.lit(10))
    start = F.pmod(F.shiftright(h, 8), F.greatest(F.length("t") - excerpt_chars, F.lit(0)) + 1) + 1
    some = (docs.filter(F.pmod(h, F.lit(1 << 30)) < limit[F.col("lang")])
            .select("lang", h.alias("h"), F.substring(F.col("t"), start.cast("int"), F.lit(excerpt_chars)).alias("e"))
            .groupBy("lang", "h").agg(F.min("e").alias("e")))
    first = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= excerpts)
    out: dict[str, list[bytes]] = {}
    for r in first.orderBy("lang", "k").collect():                        # languages x excerpts rows
        out.setdefault(r["lang"], []).append(normal(r["e"]))
    return {lang: b" ".join(parts) for lang, parts in sorted(out.items())}


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compress = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.compress.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def sizes(self, texts):
        """For each text, the bytes of the whole text under each language's dictionary; None without a letter."""
        group, held = [], 0
        for text in texts:
            group.append(normal(text))
            held += len(group[-1])
            if held >= GROUP_BYTES:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)

    def _group(self, texts: list[bytes]):
        cut = [[data[i:i + PIECE] for i in range(0, len(data), PIECE)] for data in texts]
        sizes = np.array([[sum(len(c(p)) for p in pieces) for pieces in cut] for c in self.compress]).reshape(len(self.langs), len(texts)).T
        for data, row in zip(texts, sizes):
            yield row if data and self.langs else None


def predict(dictionaries: dict[str, bytes], spark, text: Column, min_margin: float = 0.005) -> Column:
    """Struct column: best (the language with fewest bytes), lang (``und`` if rejected), margin, score in 0..1, rejected."""
    shared = spark.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("best string, lang string, margin double, score double, rejected boolean")
    def run(batches: pd.Series) -> pd.DataFrame:
        c = _compressors(shared)
        out = []
        for sizes in c.sizes(batches):
            if sizes is None:
                out.append((UNDECIDED, UNDECIDED, 0.0, 0.0, True))
                continue
            order = np.argsort(sizes, kind="stable")
            best = c.langs[order[0]]
            margin = float(1 - sizes[order[0]] / sizes[order[1]]) if len(order) > 1 else 0.0
            rejected = margin < min_margin
            out.append((best, UNDECIDED if rejected else best, margin, float(1 - np.exp(-margin / 0.05)), rejected))
        return pd.DataFrame(out, columns=["best", "lang", "margin", "score", "rejected"])

    return run(text)


_HELD: dict[int, Compressors] = {}


def _compressors(shared) -> Compressors:
    """One set of compressors for a worker process, which serves many batches."""
    key = id(shared.value)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Compressors(shared.value)
    return _HELD[key]
