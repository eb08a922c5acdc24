"""Links are dealt into tasks by their number."""

from collections import Counter
from itertools import combinations

from kalendria.operators import events as ev


def test_cooccurrence_deals_links_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(ev, "TASK_LINKS", 20, raising=False)
    rows = [(i % 40, i * 7 % 11) for i in range(300)]
    got = ev.cooccurrence(spark.createDataFrame(rows, "event_id long, supplier long"), "supplier", 100)
    of = {}
    for e, s in rows:
        of.setdefault(e, set()).add(s)
    want = Counter(p for s in of.values() for p in combinations(sorted(s), 2))
    assert {(r["a"], r["b"]): r["n"] for r in got.collect()} == dict(want)
    assert "RepartitionByExpression [event_id" in (plan := got._jdf.queryExecution().optimizedPlan().toString()) and ", 15" in plan
