"""The ledger of issued versions: blocks are never shared, and the bound waits for writers still at work."""
import pytest

from tidemark.operators.versions import current_version
from tidemark.plans.publish import publish_snapshot
from tidemark.session import scratch_path
from tidemark.sources.ledger import VersionLedger


def test_claims_do_not_overlap_and_bound_waits(spark):
    root = scratch_path(spark, "ledger")
    a, b = VersionLedger(spark, root, 10), VersionLedger(spark, root, 10)
    assert (a.safe(), a.issued(), a.issue(0)) == (0, 0, 0)
    first, second = a.issue(25), b.issue(3)
    assert (first, second, a.issued()) == (0, 30, 40)
    b.close(second, 3)
    assert a.safe() == 0                          # the earlier claim is still open
    a.close(first, 25)
    assert b.safe() == 40 == current_version(ledger=b)
    with pytest.raises(ValueError):
        VersionLedger(spark, root, 0)


def test_a_block_lost_in_the_middle(spark, monkeypatch):
    ledger = VersionLedger(spark, scratch_path(spark, "ledger"), 10)
    other = VersionLedger(spark, str(ledger.files.root), 10)
    create, taken = ledger._create, []

    def slow(name):
        if name == "block-000000000001" and not taken:
            taken.append(other._create(name))
        return create(name)
    monkeypatch.setattr(ledger, "_create", slow)
    assert ledger.issue(25) == 20                 # block 1 went to the other writer, block 0 is closed unused
    assert ledger.safe() == 10 and ledger.issued() == 50
    ledger.close(20, 25)
    other.close(10, 10)
    assert ledger.safe() == 50


def test_publish_through_the_ledger(spark):
    ledger = VersionLedger(spark, scratch_path(spark, "ledger"), 5)
    rows = spark.createDataFrame([(i, "a") for i in range(7)], "k bigint, v string")
    one, _, top = publish_snapshot(None, rows, ["k"], ledger=ledger)
    assert top == 7 and ledger.safe() == 10
    two, gone, top = publish_snapshot(one, rows.where("k <> 3").selectExpr("k", "if(k = 1, 'b', v) v"), ["k"], ledger=ledger, at="2024-01-01 00:00:00")
    assert {(r["k"], r["rv"]) for r in two.collect()} == {(0, 1), (1, 11), (2, 3), (4, 5), (5, 6), (6, 7)}
    assert [(r["rv"], r["sourcerv"], r["k"]) for r in gone.collect()] == [(12, 4, 3)] and top == 12
    same, none, _ = publish_snapshot(two, two.drop("rv"), ["k"], ledger=ledger)
    assert none.count() == 0 and ledger.issued() == 15


def test_a_failed_publish_closes_its_block(spark):
    ledger = VersionLedger(spark, scratch_path(spark, "ledger"), 5)
    with pytest.raises(RuntimeError):
        with ledger.versions(3):
            raise RuntimeError("stop")
    assert ledger.safe() == 5
