import random

import pytest

from tidewrack.llm.linkage import components, record_groups

EDGES = "src_dataset string, src_cut_id string, dst_dataset string, dst_cut_id string, match_kind string, jaccard float, match_score int, node string, root string"


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("at_once", [20, 200, 100_000])
def test_random_graphs_chains_and_hubs(spark, at_once):
    random.seed(2)
    pairs = [(f"p{i:03}", f"p{i + 1:03}") for i in range(150)]  # a chain
    pairs += [("hub", f"h{i}") for i in range(150)]  # a third of all
    pairs += [(f"r{random.randrange(120)}", f"r{random.randrange(120)}") for _ in range(60)] + [("self", "self")] * 3
    random.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a string, b string").repartition(6)
    got = [tuple(r) for r in components(df, at_once).collect()]
    assert len(got) == len(set(got)) and dict(got) == brute(pairs)


def test_records(spark):
    rows = [("b", "1", "a", "9", "text", 0.9, None), ("a", "9", "b", "1", "audio", None, 7), ("b", "1", "b", "2", None, None, None), ("c", "1", "c", "1", "text", 1.0, None), ("a", None, "d", "5", "text", 1.0, None), (None, "3", None, "4", "text", 1.0, None), ("a", "10", "é", "1", "text", None, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], EDGES)
    got = {(r.dataset, r.cut_id): (r.group_dataset, r.group_cut_id) for r in record_groups(df).collect()}
    assert got == {("a", "9"): ("a", "9"), ("b", "1"): ("a", "9"), ("b", "2"): ("a", "9"), ("c", "1"): ("c", "1"), ("d", "5"): ("d", "5"), ("a", "10"): ("a", "10"), ("é", "1"): ("a", "10")}
    assert record_groups(df.limit(0)).count() == 0
