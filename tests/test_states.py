import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridloom.core.ordered import series
from gridloom.core.session import cut_lineage
from gridloom.operators.states import LINE, STEP, cell_states, merge_rows, summarize_states
from gridloom.operators.summaries import interval_summary
from tests.helpers import rows, ts

KEYS, ORDER = ["site"], ["ts", "event_id"]
BASIS = {STEP: "time_weighted_discrete", LINE: "time_weighted_continuous"}


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(3)
    t0 = ts("2024-01-30T22:00:00")
    data = []
    for k in range(600):
        s = rng.choice([rng.random() * 3e5, rng.randint(0, 300) * 900, 1e5])
        data.append((rng.choice("ab"), k, t0 + dt.timedelta(seconds=s), None if rng.random() < 0.1 else rng.uniform(-5, 50)))
    data += [("c", 900, t0, 1.0), ("d", 901, t0, 2.0), ("d", 902, t0 + dt.timedelta(days=40), 4.0)]
    df = spark.createDataFrame(data, "site string, event_id int, ts timestamp_ntz, value double")
    return cut_lineage(df)


def close(a, b):
    return len(a) == len(b) and all(x == pytest.approx(y, abs=1e-6) if isinstance(x, float) else x == y for p, q in zip(a, b, strict=True) for x, y in zip(p, q, strict=True))


def by_bucket(df):
    names = ["site", "bucket", "total", "average", "minimum", "maximum", "range", "count", "percent_good"]
    return rows(df, *names, order=lambda r: r[:2])


@pytest.mark.parametrize("kind", [STEP, LINE])
@pytest.mark.parametrize("bucket", [3600, 86400])
def test_states_equal_one_pass(readings, kind, bucket):
    want = interval_summary(readings, series(KEYS, ORDER), bucket, BASIS[kind]).filter("percent_good > 0 or count > 0")
    got = summarize_states(cell_states(readings, KEYS, ORDER), KEYS, bucket, kind).filter("percent_good > 0 or count > 0")
    assert close(by_bucket(got), by_bucket(want)) and got.count() > 10


def test_new_days_and_late_rows(readings):
    day = F.to_date("ts")
    first = readings.filter((day < "2024-02-01") & (F.col("event_id") % 40 != 7))
    new, late = readings.filter(day >= "2024-02-01"), readings.filter((day < "2024-02-01") & (F.col("event_id") % 40 == 7))
    states = cut_lineage(cell_states(first, KEYS, ORDER))
    states = cut_lineage(merge_rows(states, new, first, KEYS, ORDER))
    known = cut_lineage(states)
    states = merge_rows(states, late, first.unionByName(new), KEYS, ORDER)
    every = cell_states(readings, KEYS, ORDER)
    for kind in (STEP, LINE):
        assert close(by_bucket(summarize_states(states, KEYS, 86400, kind)), by_bucket(summarize_states(every, KEYS, 86400, kind)))
    # cells without a late row keep their stored state
    kept = states.join(known, [*KEYS, "cell", "count"], "left_semi").count()
    assert kept > states.count() / 2


def test_states_of_nothing(spark, readings):
    states = cell_states(readings.limit(0), KEYS, ORDER)
    assert summarize_states(states, KEYS, 3600).collect() == []
    lone = cell_states(readings.filter("site = 'c'"), KEYS, ORDER)
    assert summarize_states(lone, KEYS, 3600).collect() == []
