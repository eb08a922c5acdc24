"""Numbering over ranges and components against plain Python."""

import random

from pyspark.sql import functions as F

from kalendria.plans.components import components
from kalendria.plans.ranking import numbered


def test_numbers_over_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", None, "b"]), r.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = numbered(df, ["g"], [F.desc("v"), F.asc("i")])
    want = {}
    for g in ("a", None, "b"):
        for n, (_, i) in enumerate(sorted((-v, i) for x, v, i in rows if x == g), 1):
            want[i] = n
    assert {x["i"]: x["rank"] for x in got.collect()} == want
    assert numbered(df.limit(0), ["g"], [F.asc("v")]).count() == 0
    assert sorted(x["rank"] for x in numbered(df, [], [F.asc("v"), F.asc("i")]).collect()) == list(range(1, 501))


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = [(r.randint(0, 90), r.randint(0, 90)) for _ in range(50)] + chain
    up = list(range(200))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    ends = {x for e in edges for x in e}
    assert {x["id"]: x["root"] for x in components(spark.createDataFrame(edges, "a int, b int")).collect()} == {i: root(i) for i in ends}
