"""What has no station is found with less than it takes to name the station, and the readings' join runs once."""

import random
from collections import Counter
from datetime import datetime, timedelta

from fieldseries import queries
from fieldseries.operators import attribution

START = datetime(2019, 6, 1)


def test_unattributed_readings_are_those_that_attribution_leaves(spark):
    rnd = random.Random(3)
    day = lambda: START + timedelta(days=rnd.randrange(1500))
    some = lambda *of: rnd.choice(of)
    # few moments, ids and numbers, so that many tie; windows without a station, a type or a start
    w = [(f"d{i % 8}", some("a", "b", None), some("weather", "soil", "hydro", None), rnd.randrange(3), some(START, day(), day(), None), some(None, day(), day())) for i in range(60)]
    p = [(f"d{i % 6}", some(1, 2, None), some("weather", "soil", None), some("s", "t"), some(None, 10.0, 20.0), some(START, day(), None), some(None, day()), rnd.randrange(4)) for i in range(50)]
    r = [(f"d{rnd.randrange(9)}", some(1, 2, None), some(day(), day(), day(), START, None), some("v", "w"), some(True, False, None), some(True, False, False, None)) for _ in range(900)]
    w = spark.createDataFrame(w, "device_serial string, station_id string, station_type string, unique_id long, starts timestamp, ends timestamp")
    fields = "device_serial string, port int, type string, sensor string, depth_cm double, starts timestamp, ends timestamp"
    unnumbered = spark.createDataFrame([x[:-1] for x in {(x[0], x[1], x[3], x[5]): x for x in p}.values()], fields)
    p = spark.createDataFrame(p, fields + ", win_seq int")
    r = spark.createDataFrame(r, "device_serial string, port int, datetime timestamp, variable string, depth boolean, device_level boolean")
    wide = spark.createDataFrame([(START - timedelta(days=900),), (START + timedelta(days=3000),)], "datetime timestamp")
    for ports in (p, unnumbered, p.limit(0)):
        known, lost = attribution.attribute_readings(r, w, ports)
        wanted = Counter(tuple(x) for x in lost.select(r.columns).collect())
        assert wanted and known.count()
        for moments in (None, wide):
            assert Counter(tuple(x) for x in attribution.unattributed_readings(r, w, ports, moments).collect()) == wanted


def test_the_readings_join_runs_once(spark):
    for name in ("summarize_unattributed", "attribute_readings", "interval_join_device", "deployment_join", "interval_join_prioritised", "interval_join_port"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner, (l_orderkey") == 1, name
