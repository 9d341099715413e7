"""Property: for random operation logs and random window cuts, syncing window by window equals a plain replay."""
from hypothesis import given, settings, strategies as st

from tidemark.operators import apply as ap
from tidemark.operators.extract import extract_changes, extract_snapshot
from tidemark.operators.versions import feed_from_log
from tidemark.plans.spec import VersionWindow

ops = st.lists(st.tuples(st.integers(1, 6), st.sampled_from("UUD"), st.integers(0, 9)), min_size=1, max_size=40)


def replay(log, upto):
    state = {}
    for rv, (k, op, val) in enumerate(log, start=1):
        if rv > upto:
            break
        if op == "U":
            state[k] = (val, rv)
        else:
            state.pop(k, None)
    return state


@settings(max_examples=6, deadline=None, derandomize=True)
@given(log=ops, cuts=st.lists(st.integers(1, 40), min_size=1, max_size=3, unique=True))
def test_windowed_sync_equals_replay(spark, log, cuts):
    rows = [(k, op, val, rv) for rv, (k, op, val) in enumerate(log, start=1)]
    df = spark.createDataFrame(rows, "k bigint, op string, v bigint, rv bigint")
    ends = sorted({min(c, len(log)) for c in cuts} | {len(log)})
    prev, target = 0, None
    for end in ends:
        src, dels = feed_from_log(df.where(f"rv <= {end}"), ["k"], ["v"], "rv", "op", None, span=3)
        w = VersionWindow(prev, end)
        if w.is_snapshot:
            target = ap.load_full(extract_snapshot(src, w))
        else:
            target = ap.apply_changes(target, extract_changes(src, dels, ["k"], w), ["k"], strategy="shuffle")
        prev = end
    got = {r["k"]: (r["v"], r["sourcerv"]) for r in target.collect()}
    assert got == replay(log, len(log))


side = st.dictionaries(st.integers(1, 12), st.tuples(st.sampled_from([None, "", "a", "b"]),
                                                      st.sampled_from([None, 0.0, 1.5])), max_size=12)


def expected_diff(pub, sub, nulls):
    out = {}
    for k in set(pub) | set(sub):
        if k not in pub:
            out[k] = "Missing in Publisher"
        elif k not in sub:
            out[k] = "Missing in Subscriber"
        else:
            for i, (name, d) in enumerate((("a", ""), ("x", 0.0))):
                p, s = pub[k][i], sub[k][i]
                differs = (p != s) if nulls == "strict" else ((d if p is None else p) != (d if s is None else s))
                if differs:
                    out[k] = f"Column does not match [{name}]"
                    break
    return out


@settings(max_examples=4, deadline=None, derandomize=True)
@given(pub=side, sub=side)
def test_compare_matches_brute_force(spark, pub, sub):
    from tidemark.operators.compare import compare_tables
    p = spark.createDataFrame([(k, a, x, k) for k, (a, x) in pub.items()], "k bigint, a string, x double, rv bigint")
    s = spark.createDataFrame([(k, a, x, k) for k, (a, x) in sub.items()], "k bigint, a string, x double, sourcerv bigint")
    for nulls in ("default", "strict"):
        got = {r["k"]: r["difference"] for r in compare_tables(p, s, ["k"], nulls=nulls).collect()}
        assert got == expected_diff(pub, sub, nulls)


runs_log = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1)), min_size=0, max_size=15)


@settings(max_examples=4, deadline=None, derandomize=True)
@given(log=runs_log)
def test_high_water_mark_matches_brute_force(spark, log):
    from tidemark.operators.runs import high_water_mark
    rows = [(i, sub, (i + 1) * 10, ok) for i, (sub, ok) in enumerate(log, start=1)]
    df = spark.createDataFrame(rows, "import_log_id bigint, subscription_id bigint, rv_to bigint, success int")
    for double in (False, True):
        got = {r[0]: r[1] for r in high_water_mark(df, double_read=double).collect()}
        exp = {}
        for sub in {r[1] for r in rows}:
            ok = [r[2] for r in sorted(rows, key=lambda r: -r[0]) if r[1] == sub and r[3] == 1]
            exp[sub] = 0 if not ok else (ok[min(1, len(ok) - 1)] if double else ok[0])
        assert got == exp
