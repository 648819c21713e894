"""op6: targets, flow and selection."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import pytest

from gavlake.llm import mixing as mx


def test_targets():
    sizes = {"b": 100, "a": 1000, None: 10, "c": 400}
    want = mx.targets(sizes)  # weights a 3, b 1, c 2, null 3; budget 2265
    assert want[None] == 20  # its share is above twice its size
    assert abs(sum(want.values()) - 2265) < 1e-9
    # b's share of the rest is above 200, then c's above 800
    assert want["b"] == 200 and want["c"] <= 800 and want["a"] <= 2000
    assert mx.targets({}) == {} and mx.targets({"a": 0}) == {"a": 0}


def brute_cost(sizes, quotas, members):
    """(words routed, cost) of the best integral flow, by trying all."""
    pairs = [(p, s) for p in sizes for s in members[p]]
    best = (0, 0)
    for flow in itertools.product(*(range(2 * sizes[p] + 1) for p, _ in pairs)):
        out, into = Counter(), Counter()
        for (p, s), n in zip(pairs, flow):
            out[p] += n
            into[s] += n
        if all(out[p] <= 2 * sizes[p] for p in sizes) and all(into[s] <= quotas[s] for s in quotas):
            cost = sum(min(out[p], sizes[p]) + 3 * max(0, out[p] - sizes[p]) for p in sizes)
            best = max(best, (sum(flow), -cost))
    return best


@pytest.mark.parametrize("sizes,quotas,members", [
    ({"x": 3, "y": 2}, {"a": 4, "b": 3}, {"x": ["a"], "y": ["a", "b"]}),
    ({"x": 2, "y": 1, "z": 2}, {"a": 3, "b": 2}, {"x": ["a"], "y": ["b"], "z": ["a", "b"]}),
    ({"x": 1}, {"a": 5}, {"x": ["a"]}),
])
def test_flow_is_maximal_and_cheapest(sizes, quotas, members):
    taken = mx.route(sizes, quotas, members)
    cost = sum(min(taken[p], sizes[p]) + 3 * max(0, taken[p] - sizes[p]) for p in sizes)
    assert (sum(taken.values()), -cost) == brute_cost(sizes, quotas, members)


def check(got, rows):
    size = lambda t: len([w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w])
    assert len(got) == len(rows)
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += size(t)
    wanted = mx.targets(total)
    assert Counter((r.doc_id, r["size"], r.source_size, r.target) for r in got) == Counter(
        (i, size(t), total[s], float(wanted[s])) for i, t, s in rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)


def test_table(small):
    rows = [(r.doc_id, r.text, r.source) for r in small.collect()]
    got = mx.mix_report(small).collect()
    check(got, rows)
    source = {i: s for i, _, s in rows}
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
        target[s] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in mx.mix_report(small).collect()}


def test_mixed_rows_are_the_report(small):
    copies = Counter(r.doc_id for r in mx.mixed(small).collect())
    for r in mx.mix_report(small).collect():
        if r["size"]:
            assert copies[r.doc_id] * r["size"] == r.taken
    assert mx.mixed(small).columns == small.columns


def test_edge_cases(edge_docs, edge_rows, no_docs):
    check(mx.mix_report(edge_docs).collect(), [(r[0], r[1], r[3]) for r in edge_rows])
    assert mx.mix_report(no_docs).collect() == [] and mx.mixed(no_docs).collect() == []
    assert mx.mixed(edge_docs).columns == edge_docs.columns


def test_overlapping_sources(spark):
    """A document of two sources counts for both; the flow shares it out."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(200)],
                               "doc_id long, text string, sources_of array<string>")
    plan, wanted, sizes, _ = mx.plan_mix(df, F.col("sources_of"))
    assert sizes == {"a": 2000, "b": 1000} and len(plan) == 2
    assert abs(float(wanted["a"] + wanted["b"]) - 4500) < 1
