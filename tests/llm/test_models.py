"""Toxicity, quality and language: held-out accuracy and defined cases."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, quality, toxicity

TOX, FINE = "idiot moron scum".split(), "river stone cloud bread light grass".split()


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    for i in range(n):
        words = list(rng.choice(FINE, 30))
        if i % 3 == 0:
            words[int(rng.integers(30))] = str(rng.choice(TOX)) + ("" if i % 2 else "ic")
        yield i, " ".join(words), int(i % 3 == 0)


EDGE = [(None, None), (1, None), (2, ""), (3, "  \n "), (4, "..!! 12"), (4, "..!! 12"), (5, "wörter " * 30000)]


def test_toxicity_separates_and_shares_rare_words(spark):
    rows = spark.createDataFrame(list(texts(240)), "doc_id long, text string, toxic int")
    model = toxicity.fit(rows.filter("doc_id < 180"), part=F.col("doc_id") % 5 == 1)
    got = rows.filter("doc_id >= 180").select(toxicity.score(model, spark, F.col("text")).alias("s"), "toxic").toPandas()
    assert ((got.s >= 0.5).astype(int) == got.toxic).mean() > 0.95
    assert abs(model.ratios(["qzxv"])[0]) < abs(model.ratios(["idiot"])[0])      # never seen: says little
    assert model.ratios(["moronic"])[0] > 1


def test_gram_counts_and_probabilities(spark):
    rows = spark.createDataFrame([("ab ab", 1), ("ab cd", 0), (None, 1), ("cd", None)], "t string, y int")
    grams = toxicity.gram_counts(rows, "t", "y", order=3)
    got = {r["gram"].replace("\x02", "^").replace("\x03", "$"): (r["c1"], r["c0"]) for r in grams.collect()}
    assert got == {"^^a": (1, 1), "^ab": (1, 1), "ab$": (1, 1), "^^c": (0, 1), "^cd": (0, 1), "cd$": (0, 1)}
    seen, unseen = toxicity.gram_ratios(grams, order=3)
    ratio = {r["gram"].replace("\x02", "^"): r["ratio"] for r in seen.collect()}
    assert ratio["^^a"] > 0 > ratio["^^c"]
    # brute force of one gram: class counts over the pooled continuation model
    p1 = {"a": 1, "b": 1, "c": 1, "d": 1, "\x03": 2}
    low = (p1["a"] + 0.1) / (6 + 0.5)
    p2 = (1 - 0.75 + 0.75 * 2 * low) / 2           # contexts of "^": a and c, one continuation each
    pt = (max(1 - 0.9, 0) + 0.9 * p2) / 1
    po = (max(1 - 0.9, 0) + 1.8 * p2) / 2
    assert ratio["^^a"] == pytest.approx(np.log(pt / po))


@pytest.mark.parametrize("label", [None, 1])
def test_toxicity_without_labels_and_edge_rows(spark, label):
    rows = spark.createDataFrame([(1, "a b", label)], "doc_id long, text string, toxic int")
    model = toxicity.fit(rows)
    edge = spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = edge.select("doc_id", toxicity.score(model, spark, F.col("text")).alias("s")).collect()
    assert len(got) == len(EDGE) and all(0 <= r["s"] <= 1 for r in got)
    assert edge.limit(0).select(toxicity.score(model, spark, F.col("text"))).count() == 0


def test_toxicity_ships_or_joins_with_equal_scores(spark):
    rows = spark.createDataFrame(list(texts(240)), "doc_id long, text string, toxic int")
    part = F.col("doc_id") % 5 == 1
    shipped, joined = toxicity.fit(rows, part=part), toxicity.fit(rows, part=part, max_shipped=5)
    assert isinstance(shipped, toxicity.ToxicityModel) and isinstance(joined, toxicity.JoinedModel)
    edge = spark.createDataFrame(EDGE + [(i, t) for i, t, _ in texts(40, seed=4)], "doc_id long, text string")
    some = edge.withColumn("gram", F.lit("clash")).withColumn("word", F.lit("clash"))
    a, b = (toxicity.with_score(some, m) for m in (shipped, joined))
    assert a.columns == b.columns == [*some.columns, "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    a, b = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert [r[:2] for r in a] == [r[:2] for r in b] and [r["score"] for r in a] == pytest.approx([r["score"] for r in b], abs=1e-9)
    words = spark.createDataFrame([(w,) for w in ("stone", "idiot", "qzxv")], "word string")      # an ordinary word stays ordinary
    got = {r["word"]: r["ratio"] for r in joined.ratios(words).collect()}
    assert got == {w: pytest.approx(shipped.ratios([w])[0]) for w in got} and len(got) == 3
    assert toxicity.with_score(some.limit(0), joined).count() == 0


def test_quality_held_out(spark):
    rows = [(i, (t.upper().replace(" ", "!! ") if i % 4 == 0 else " ".join([t.split()[0]] * 40) if i % 4 == 1 else t), int(i % 4 > 1)) for i, t, _ in texts(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(frame.filter("doc_id < 200"))
    got = frame.filter("doc_id >= 200").select(quality.score(model, spark, F.col("text")).alias("s"), "quality").toPandas()
    assert ((got.s >= 0.7).astype(int) == got.quality).mean() > 0.95
    edge = spark.createDataFrame(EDGE, "doc_id long, text string").select(quality.score(model, spark, F.col("text")).alias("s")).collect()
    assert len(edge) == len(EDGE) and all(0 <= r["s"] <= 1 for r in edge)


def test_quality_score_is_the_softmax_of_the_average():
    rng = np.random.default_rng(0)
    model = quality.QualityModel(rng.standard_normal(quality.BUCKETS), 0.3)
    for text in ("a b a", "x", "one two two three"):
        f = quality._sparse([text]).iloc[0]
        assert model.scores([text])[0] == pytest.approx(1 / (1 + np.exp(-(f["w"] @ model.weight[f["b"]] + 0.3))), rel=1e-5)
    assert quality.train([], np.zeros(0)).scores(["a"])[0] == 0.5


def test_language(spark):
    samples = {"de": "der Hund läuft über die Straße und schläft nicht ", "en": "the dog runs over the street and does not sleep "}
    rows = [(i, (samples[k] * 6)[i % 7:i % 7 + 150 + i], k) for i, k in enumerate(["de", "en"] * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.fit(frame.union(spark.createDataFrame([(99, "x", None), (98, None, "en")], frame.schema)))
    assert sorted(learned) == ["de", "en"]
    got = frame.select("lang", langid.predict(learned, spark, F.col("text")).alias("p")).filter("lang = p.best and not p.rejected").count()
    assert got == len(rows)
    edge = spark.createDataFrame(EDGE, "doc_id long, text string").select("text", langid.predict(learned, spark, F.col("text")).alias("p")).collect()
    assert [r["p"]["best"] for r in edge[:6]] == ["und"] * 6 and edge[6]["p"]["best"] in learned
    none = spark.createDataFrame([(1, "abc")], "doc_id long, text string").select(langid.predict({}, spark, F.col("text")).alias("p")).first()
    assert none["p"]["best"] == "und" and langid.fit(frame.limit(0)) == {}


def test_a_dictionary_serves_a_group_of_texts_at_a_time(monkeypatch):
    c = langid.Compressors({"de": b"der hund und die katze", "en": b"the dog and the cat"})
    texts = ["the dog", None, "12", "die Katze " * 2000, "", "Ärger – mit ½ ² ŒUVRE", "und_der 9 Hund", "²"]
    alone = [next(c.sizes([t])) for t in texts]
    assert [a is None for a in alone] == [False, True, True, False, True, False, False, True]
    assert langid.normal(texts[5]) == "ärger mit ½ ² œuvre".encode() and langid.normal(texts[6]) == b"und der hund"
    real, calls = list(c.compress), []
    c.compress = [lambda p, k=k: calls.append(k) or real[k](p) for k in range(2)]
    for limit, turns in ((1_000_000, 2), (100, 4)):
        monkeypatch.setattr(langid, "GROUP_BYTES", limit)
        calls.clear()
        together = list(c.sizes(texts))
        assert [None if a is None else a.tolist() for a in together] == [None if a is None else a.tolist() for a in alone]
        assert 1 + sum(a != b for a, b in zip(calls, calls[1:])) == turns
    assert list(c.sizes([])) == [] and list(langid.Compressors({}).sizes(["a"])) == [None]


def test_evidence_does_not_depend_on_how_many_words_are_held(monkeypatch):
    import numpy as np
    from tidemark.llm import toxicity
    codes, _, _, _, _ = toxicity._codes(["good", "words", "bad", "ones"], toxicity.ORDER)
    table = np.unique(codes), np.linspace(-2, 2, len(np.unique(codes)))
    model = toxicity.ToxicityModel(toxicity.ORDER, table, (np.zeros(1, dtype=np.uint64), np.zeros(1)))
    texts = ["good words", None, "", "bad ones bad", "good " * 50 + "ones", "words", "...", "bad"]
    whole = model.evidence(texts)
    for held, fresh in ((1, 20_000), (3, 1), (200_000, 1)):
        monkeypatch.setattr(toxicity, "HELD_WORDS", held)
        monkeypatch.setattr(toxicity, "NEW_WORDS", fresh)
        assert np.array_equal(model.evidence(texts), whole)
    assert not whole[1].any() and not whole[2].any() and whole[0].any()
