"""Overlapping spans against brute force; no span is gathered beside another."""

import random

from pyspark.sql import functions as F

from fieldseries.operators import decisions, spans


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_and_moments_against_brute_force(spark):
    rnd = random.Random(5)
    # moments lie over several slices of 30 days; some spans are open, empty or turned round
    rows = [(i, rnd.choice("ab"), a := rnd.randrange(0, 200), rnd.choice([None, a, a - 3, *[a + rnd.randrange(1, 90) for _ in range(17)]]), rnd.randrange(50)) for i in range(300)]
    d = spark.createDataFrame(rows, "id int, k string, a int, b int, p int")
    t = lambda c: F.timestamp_micros(F.col(c) * F.lit(86_400_000_000 // 2))
    cut = spans.pieces(d.select("k", t("a").alias("starts"), t("b").alias("ends"), "p", "id"), ["k"], F.struct("p", "id"))
    moments = spark.createDataFrame([(m, k, m) for k in ("a", "b", "c", None) for m in [*range(-2, 300), None]], "m int, k string, n int").withColumn("at", t("m"))
    got = spans.at_moments(moments, cut, ["k"], "at").collect()
    assert len(got) == 4 * 303
    for r in got:
        want = max(((p, i) for i, k, a, b, p in rows if k == r.k and r.m is not None and a <= r.m and (b is None or r.m < b)), default=None)
        assert (r.best and tuple(r.best)) == want, r


def test_decisions_do_not_meet_each_other(spark):
    d = spark.sql("select id as decision_id, 's' as series, timestamp_seconds(id) as starts, timestamp_seconds(id + 5000) as ends, 'suspect' as flag, null as value, timestamp_seconds(id) as decided_at from range(4000)").withColumn("value", F.col("value").cast("double"))
    cut = decisions.cut_spans(d, ["series"])
    assert "collect_list" not in _plan(cut)
    assert cut.count() == 4000
    e = spark.sql("select 's' as series, timestamp_seconds(id) as datetime, 1.0d as value, 'observed' as flag from range(10000)")
    flags = decisions.apply_flags(e, d, ["series"])
    assert "collect_list" not in _plan(flags)
    assert flags.groupBy("flag").count().orderBy("flag").collect() == [("observed", 1001), ("suspect", 8999)]
