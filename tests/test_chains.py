"""Chains of surveys: near ones are followed inside a batch, the others doubled."""

import random

from fieldseries.operators import survey
from fieldseries.sources import scratch


def _walked(links):
    up, out = {n: (p, v) for n, p, v in links}, {}
    for n in up:
        at, height, hops, seen = n, 0.0, 0, set()
        while at in up and at not in seen:
            seen.add(at)
            height, hops, at = None if height is None or up[at][1] is None else height + up[at][1], hops + 1, up[at][0]
        out[n] = None if at in up else (at, height, hops)
    return out


def _chained(spark, links):
    heights, cyclic = survey.chain_heights(spark.createDataFrame(links, "node long, parent long, value double"))
    return {r.node: (r.root, r.height, r.hops) for r in heights.collect()} | {r.node: None for r in cyclic.collect()}


def test_long_chains_of_neighbours_are_written_twice(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(survey.scratch, "written", lambda d, name, write=scratch.written: tables.append(name) or write(d, name))
    links = [(i, i - 1 if i % 1000 else (i + 999 if i == 2000 else -1 - i), i % 7 * 0.25) for i in range(4000)]
    assert _chained(spark, links) == _walked(links)
    assert len(tables) <= 4  # a table for each doubling made eleven


def test_chains_in_any_order_of_ids(spark):
    """Forests and rings whose ids tell nothing, over many small batches, with links that have no value or no parent."""
    rng, key = random.Random(7), "spark.sql.execution.arrow.maxRecordsPerBatch"
    ids = rng.sample(range(10**6), 600)
    links = [(n, ids[i - rng.randint(1, 3)] if i > 3 else -5 - i, None if i % 97 == 0 else i % 5 * 0.5) for i, n in enumerate(ids[:500])]
    links += [(n, ids[500 + (i + 1) % 60] if i < 60 else ids[500 + rng.randint(0, i - 1)], 1.0) for i, n in enumerate(ids[500:])]
    links += [(2 * 10**6, None, 1.0), (2 * 10**6 + 1, 2 * 10**6, 2.0), (2 * 10**6 + 2, 2 * 10**6 + 2, 1.0)]
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        assert _chained(spark, links) == _walked(links)
    finally:
        spark.conf.set(key, before)
