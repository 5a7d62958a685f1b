"""Connected components: equal to a union-find, and work in proportion to the edges of a group;
no growing estimates of size behind them."""

import random

import pytest
from pyspark.sql import functions as F

from paytrail.llm.common import components, cut

_rng = random.Random(3)
CASES = {
    "chain": [(i, i + 1) for i in range(300)],
    "random": [(_rng.randrange(2000), _rng.randrange(2000)) for _ in range(1500)],
    "groups": [(10 * (i % 9) + _rng.randrange(9), 100 + i) for i in range(300)],
    "loops and repeats": [(1, 1), (2, 3), (3, 2), (2, 3)],
    "none": [],
}


def roots(edges):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(parent)}


@pytest.mark.parametrize("name", CASES)
def test_components_equal_union_find(spark, name):
    got = components(spark.createDataFrame(CASES[name], "a int, b int")).collect()
    assert {r.node: r.root for r in got} == roots(CASES[name]) and len(got) == len({r.node for r in got})


def test_a_group_with_many_edges_is_joined_in_few_rounds(spark, monkeypatch):
    rng = random.Random(7)  # 400 texts, each linked to a head in every one of 24 tries
    edges = sorted({(rng.randrange(60), 60 + i) for i in range(400) for _ in range(24)})
    frame = spark.createDataFrame(edges, "a int, b int")
    join, made = type(frame).join, []

    def counted(self, *args, **kwargs):
        out = join(self, *args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(type(frame), "join", counted)
    got = components(frame)
    assert sum(made) <= 3 * len(edges), (sum(made), len(edges))
    monkeypatch.undo()
    assert {r.node: r.root for r in got.collect()} == roots(edges)


def estimate(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def test_estimates_of_size_do_not_grow_with_the_rounds(spark):
    names = list(range(200))
    random.Random(5).shuffle(names)  # several rounds of several jumps
    edges = list(zip(names, names[1:]))
    got = components(spark.createDataFrame(edges, "a int, b int"))
    assert estimate(got) < 2**63
    assert {r.node: r.root for r in got.collect()} == roots(edges)


def test_cut_tables_joined_again_and_again_stay_the_same(spark):
    first = spark.createDataFrame([(i, None if i % 5 else f"v{i}") for i in range(40)] + [(7, None)], "k int, v string")
    now = cut(first)
    for _ in range(6):
        joined = now.join(now.select("k").distinct(), "k").repartition(4, "k").sortWithinPartitions("k")
        now, plain = cut(joined), joined.checkpoint()
        assert estimate(now) < 2**63
    assert now.schema == plain.schema == first.schema
    assert sorted(now.collect(), key=str) == sorted(first.collect(), key=str)
    plans = [df._jdf.queryExecution().logical() for df in (now, plain)]
    assert len({p.outputPartitioning().toString() for p in plans}) == len({p.outputOrdering().toString() for p in plans}) == 1
    assert now.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect() == [(7, 2)]
