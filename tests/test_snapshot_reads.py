"""What the snapshot queries read: work that a result doesn't need isn't done."""

from seriesloom.operators import snapshots as S
from seriesloom.plans import load

SF = "/root/testdata/sf0.001"


def test_coverage_counts_no_opportunities(spark, monkeypatch):
    query = load()[0]["snapshot_coverage"]
    history = {}
    for r in load()[0]["snapshot_history"](spark, SF).collect():
        history.setdefault((r.Product, r.Division), []).append(r.snapshot_month)

    def never(*_):
        raise AssertionError("slippage is not part of the coverage")

    monkeypatch.setattr(S, "opportunity_counts", never)
    rows = query(spark, SF).collect()
    assert rows and {(r.Product, r.Division): (r.history_rows, r.n_snapshots) for r in rows if r.history_rows} == {k: (len(v), len(set(v) - {None})) for k, v in history.items()}
