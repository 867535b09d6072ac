"""Runs of missed landings against a walk over the schedule."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from tierline.operators.landing import landing_gap_spans

FIRST = datetime(2021, 1, 1)


def walked(regions, landed, first, last, every):
    """Slot by slot, the runs that nothing landed in."""
    out, step = [], timedelta(hours=every)
    for region in sorted({r.strip().lower() for r in regions}):
        times = [t for r, t in landed if r is not None and t is not None and r.strip().lower() == region]
        slot, run = first, []
        while slot <= last:
            if any(slot <= t < slot + step for t in times):
                out += [(region, run[0], run[-1], len(run), False)] if run else []
                run = []
            else:
                run.append(slot)
            slot += step
        out += [(region, run[0], run[-1], len(run), True)] if run else []
    return sorted(out)


@pytest.mark.parametrize("every, days", [(1, 6), (6, 30), (24, 40)])
def test_runs_equal_a_walk(spark, every, days):
    rng = random.Random(every)
    last = FIRST + timedelta(days=days)
    landed = [(rng.choice(["us", " US", "gb", None, "else"]), FIRST + timedelta(minutes=rng.randint(-3000, days * 1440 + 3000))) for _ in range(4 * days)]
    landed += [("hot", FIRST + timedelta(hours=7, seconds=s)) for s in range(500)] + [("us", None)]
    table = spark.createDataFrame(landed, "region string, landed timestamp").repartition(5)
    regions = ["US", "gb", "hot", "never"]
    got = sorted(map(tuple, landing_gap_spans(regions, table, FIRST, last, every).collect()))
    want = walked(regions, landed, FIRST, last, every)
    assert got == want and any(r[0] == "never" and r[4] for r in got)


def test_edges(spark):
    none = spark.createDataFrame([], "region string, landed timestamp")
    (one,) = landing_gap_spans(["us"], none, FIRST, FIRST, 1).collect()
    assert tuple(one) == ("us", FIRST, FIRST, 1, True)
    for every, last in ((0, FIRST), (1, FIRST - timedelta(hours=1))):
        with pytest.raises(ValueError):
            landing_gap_spans(["us"], none, FIRST, last, every)
