import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.plans import combiner as cb
from gridloom.plans import compliance as cp
from gridloom.plans import curtailment as ct
from gridloom.plans import dayahead as da
from gridloom.plans import insurance as ins
from gridloom.plans import kpi as kp
from gridloom.plans import modelinputs as mi
from gridloom.plans import report as rp
from gridloom.plans.status import pipeline_status
from tests.helpers import rows, ts

H = [ts(f"2024-06-01T{h:02d}:00:00") for h in range(24)]


# --- report ------------------------------------------------------------------------


def report(spark):
    """Two inverters, four hours: plain, curtailed, one down, all down with meter."""
    site = [
        # poa, module temp, offline, soiling, meter, set-point
        (H[10], 500.0, 30.0, 0.1, 0.02, 0.40, 2.0),
        (H[11], 600.0, 35.0, 0.0, -0.10, 0.30, 0.5),
        (H[12], 400.0, 30.0, 0.0, 0.0, 0.10, 2.0),
        (H[13], 300.0, 25.0, 0.0, 0.0, 0.20, 2.0),
    ]
    inv = {
        "A": [(200.0, 300.0, 60), (150.0, 400.0, 60), (100.0, 200.0, 60), (0.0, 150.0, 0)],
        "B": [(200.0, 300.0, 60), (150.0, 400.0, 60), (0.0, 200.0, 30), (0.0, 150.0, 0)],
    }
    sh = spark.createDataFrame(
        [("s", *r) for r in site],
        "site string, ts timestamp_ntz, poa double, module_temp double, mods_offline_pct double, soiling_pct double, meter_mwh double, setpoint_mw double",
    )
    ih = spark.createDataFrame(
        [("s", n, H[10 + i], *v) for n, vs in inv.items() for i, v in enumerate(vs)],
        "site string, inv string, ts timestamp_ntz, kw double, model_kw double, avail_min int",
    )
    meta = spark.createDataFrame([("s", 0.7, 1.0, 0.004)], "site string, mwac double, mwdc double, tcoeff double")
    return rp.monthly_report(sh, ih, meta)


def test_report_rows(spark):
    got = {r.ts.hour: r for r in report(spark)["rows"].collect()}
    assert got[10].actual == pytest.approx(0.4) and got[10].possible == pytest.approx(0.6)
    assert got[11].possible == pytest.approx(0.7) and got[11].adj_factor == pytest.approx(0.875)
    assert got[11].curt_loss == pytest.approx(0.4) and got[10].curt_loss == 0
    assert (got[10].flag, got[12].flag, got[13].flag) == (1, 1, 0)
    assert got[12].calc_kw == pytest.approx((0.1 * 1.02 - 0.1) * 1000) and got[10].calc_kw == 0
    assert got[13].calc_kw == pytest.approx(0.2 * 1.02 * 1000 / 2)
    assert got[10].module_loss == pytest.approx(0.06) and got[11].soiling_loss == 0
    cells = {h: (r.poa, r.module_temp + 3 * r.poa / 1000) for h, r in got.items()}
    avg = sum(p * t for p, t in cells.values()) / sum(p for p, _ in cells.values())
    assert got[10].endci == pytest.approx(0.5 * (1 - 0.004 * (avg - cells[10][1])))
    assert got[10].perf_ratio == pytest.approx(0.4 / got[10].endci)


def test_inverter_and_site_totals(spark):
    out = report(spark)
    inv = {r.inv: r for r in out["inverters"].collect()}
    a, b = inv["A"], inv["B"]
    assert a.ratio_raw == pytest.approx(300 / 900) and b.ratio_raw == pytest.approx(200 / 500)
    # B at 12h: 30 minutes available, flag 1, not curtailed
    assert b.downtime == pytest.approx(0.4 * 400 / 1000) and a.downtime == 0
    assert a.actual == pytest.approx((450 + 200 / 0.98 / 2) / 1000)
    assert a.curtailment == pytest.approx((400 * 0.875 - 150) / 1000)
    assert a.possible == pytest.approx((300 + 350 + 200 + 150) / 1000)
    assert a.dc_health == pytest.approx(a.possible - a.actual - a.curtailment - a.downtime)
    assert a.availability == 1.0
    site = out["sites"].first()
    assert site.actual == pytest.approx(a.actual + b.actual) and site.meter == pytest.approx(1.0)
    assert site.insolation == pytest.approx(1.8)
    hours = cp.unit_hours(out["rows"], out["inverter_hours"], out["sites"]).first()
    # one curtailed hour with the meter below 1 counts for both inverters
    assert (hours.sihd, hours.rsih, hours.ruihn, hours.calendar_hours) == (6, 2, 0, 8)
    assert hours.foihd == 0 and hours.asih == 8


def test_ratio_falls_back_to_the_mean_of_positive_ratios(spark):
    data = [("s", "A", 100.0, 60), ("s", "B", 0.0, 60), ("s", "C", 50.0, 20)]
    df = spark.createDataFrame(data, "site string, inv string, kw double, avail_min int").select(
        "*", F.lit(H[0]).cast("timestamp_ntz").alias("month"), F.lit(500.0).alias("poa"), F.lit(0.0).alias("curt_loss")
    )
    got = rows(rp.production_ratios(df), "inv", "ratio_raw", "ratio")
    assert got == [("A", 0.2, 0.2), ("B", 0.0, 0.0), ("C", None, 0.2)]


def test_overrides_replace_site_figures(spark):
    out = report(spark)
    month = ts("2024-06-01T00:00:00")
    over = spark.createDataFrame([("s", month, 9.0, 5.0)], "site string, month timestamp_ntz, curtailment_override double, meter_override double")
    got = rp.site_totals(out["rows"], out["inverters"], over).first()
    assert (got.curtailment, got.meter) == (9.0, 5.0)


# --- curtailment -------------------------------------------------------------------


def test_setpoint_at_capacity_is_not_curtailed(spark):
    data = [("s", H[0], 100.0, 120.0, 80.0), ("s", H[1], 130.0, 60.0, 80.0), ("s", H[2], 50.0, 60.0, 40.0), ("s", H[3], 100.0, 60.0, 110.0)]
    df = spark.createDataFrame(data, "site string, ts timestamp_ntz, possible_mw double, setpoint_mw double, meter_mw double")
    got = ct.setpoint_intervals(df, F.lit(120.0)).orderBy("ts").collect()
    assert [r.curtailed_kwh for r in got] == [0.0, pytest.approx(40e3 / 60), 0.0, 0.0]
    total = ct.daily_summary(ct.setpoint_intervals(df, F.lit(120.0)), ["site"]).filter("day is null").first()
    assert total.curtailed_hours == pytest.approx(1 / 60) and total.lost_revenue == pytest.approx(40e3 / 60 * 0.0625)


def test_market_rows(spark):
    data = [("s", H[0], 10.0, None), ("s", H[1], 10.0, -5.0), ("s", H[2], 10.0, 0.0)]
    df = spark.createDataFrame(data, "site string, ts timestamp_ntz, dot double, supp double").select(
        "*", F.lit(40.0).alias("possible_mw"), F.lit(16.0).alias("meter_mw"), F.lit(0.05).alias("rate_per_kwh")
    )
    got = ct.market_intervals(df, F.lit(30.0)).orderBy("ts").collect()
    assert [r.setpoint_mw for r in got] == [30.0, 10.0, 30.0]
    assert [r.lost_mwh for r in got] == [0.0, pytest.approx(14 / 12), 0.0]
    assert got[1].lost_revenue == pytest.approx(14 / 12 * 50)


def test_scada_range_is_shifted_and_inclusive(spark):
    stamps = ["2024-01-01T05:59:00", "2024-01-01T06:00:00", "2024-01-02T06:00:00", "2024-01-02T06:01:00"]
    df = spark.createDataFrame([(ts(t), 100.0, 50.0, 60.0, 120.0) for t in stamps], "ts_utc timestamp_ntz, expected_kw double, meter_kw double, limit_kw double, capacity_kw double")
    got = rows(ct.scada_rows(df, "2024-01-01", "2024-01-02"), "ts", "curtailed_kw")
    assert got == [(ts("2024-01-01T00:00:00"), 50.0), (ts("2024-01-02T00:00:00"), 50.0)]


# --- combiners ---------------------------------------------------------------------


def combiner_day(spark, amps, i_mp=100.0, kw=None, curtailed=0.0, possible=100.0):
    """One combiner day; ``amps`` maps hours to current."""
    data = [("s", "I", "C", H[h], float(a), float(i_mp), float((kw or {}).get(h, 50.0)), possible, curtailed, 50.0) for h, a in amps.items()]
    df = spark.createDataFrame(
        data, "site string, inv string, cmb string, ts timestamp_ntz, amps double, i_mp double, kw double, possible_kw double, curtailed double, cmb_possible_kw double"
    )
    got = cb.daily_flags(df).collect()
    return (got[0].flag, round(got[0].loss_mwh, 6)) if got else None


DAY = range(8, 17)


@pytest.mark.parametrize(
    "amps,kwargs,want",
    [
        ({h: 60 + h for h in DAY}, {"curtailed": 0.63}, ("curtailment", round(0.45 * 0.37, 6))),
        ({h: 60 + h for h in DAY}, {"curtailed": 0.625}, ("underperform", None)),
        ({h: 0.5 for h in DAY}, {}, ("offline", 0.45)),
        ({h: 0.6 for h in DAY}, {}, ("comms", 0.0)),
        ({h: 5 / 9 for h in DAY}, {}, "boundary"),
        ({1: 20.1, **{h: h for h in DAY}}, {"kw": {1: 0.0}}, ("calibration", 0.0)),
        ({1: 20.0, **{h: h for h in DAY}}, {"kw": {1: 0.0}}, ("underperform", None)),
        ({h: 75 + (h == 9) for h in DAY}, {}, None),
        ({h: 10 + (h - 8) * 13 for h in DAY}, {}, ("tracker_west", None)),
        ({h: 114 - (h - 8) * 13 for h in DAY}, {}, ("tracker_east", None)),
        ({h: 90 if h == 12 else 20 + h for h in DAY}, {}, ("tracker_center", None)),
        ({h: h for h in (8, 9, 11, 13)}, {}, ("underperform", None)),
        ({h: h for h in DAY}, {"kw": {h: 0.0 for h in DAY}}, None),
        ({h: h for h in DAY}, {"kw": {h: 96.0 for h in DAY}}, None),
    ],
)
def test_combiner_flags(spark, amps, kwargs, want):
    got = combiner_day(spark, amps, **kwargs)
    if want is None:
        assert got is None
    elif want == "boundary":
        assert got[0] == "offline"  # a sum of exactly 5 A is not above the limit
    else:
        assert got[0] == want[0]
        if want[1] is not None:
            assert got[1] == pytest.approx(want[1])


def test_weights_and_matrix(spark):
    design = spark.createDataFrame([("s", "I", "C1", 10.0), ("s", "I", "C2", 30.0), ("s", "J", "C1", 5.0)], "site string, inv string, cmb string, kwdc double")
    assert rows(cb.dc_weights(design), "inv", "cmb", "dc_weight", "dc_weight_adj") == [
        ("I", "C1", 0.5, 0.25), ("I", "C2", 1.5, 0.75), ("J", "C1", 1.0, 1.0)
    ]
    losses = spark.createDataFrame([("s", "I", "C2", "tracker_east", 1, 0.12345)], "site string, inv string, cmb string, flag string, n_days int, loss_mwh double")
    shown = rows(cb.loss_matrix(losses, design))
    assert shown == [("s", "I", "", "0.1235"), ("s", "J", "", "-/-")]
    shown = rows(cb.loss_matrix(losses, design, show="category"))
    assert shown == [("s", "I", "", "TRK"), ("s", "J", "", "-/-")]


# --- KPIs --------------------------------------------------------------------------


def kpi_row(spark, **over):
    base = dict(possible=100.0, inverter=82.0, meter=80.0, soiling=2.0, snow_derate=0.0, dc_health=5.0, ac_module=1.0, downtime=6.0, curtailment=4.0, ac_line_losses=2.0, insurance_bi=0.0)
    base |= over
    return spark.createDataFrame([("s", 1, *base.values())], "site string, month int, " + ", ".join(f"{k} double" for k in base))


@pytest.mark.parametrize(
    "over,want",
    [
        ({}, {}),
        ({"dc_health": 8.0}, {"dc_health": 5.0}),
        ({"dc_health": 1.0, "downtime": 12.0}, {"dc_health": 0.0, "downtime": 11.0}),
        ({"insurance_bi": 5.0}, {"downtime": 1.0}),
        ({"insurance_bi": 9.0}, {"downtime": 0.0, "dc_health": 2.0}),
        ({"dc_health": -3.0, "downtime": 20.0}, {"downtime": 14.0, "dc_health": -3.0}),
        ({"meter": 99.0}, {"dc_health": 0.0, "downtime": 0.0, "soiling": 0.0, "ac_module": 0.0, "curtailment": 0.0}),
    ],
)
def test_reconcile(spark, over, want):
    before = kp.validate(kpi_row(spark, **over)).first()
    after = kp.reconcile(kpi_row(spark, **over)).first()
    for k, v in want.items():
        assert after[k] == pytest.approx(v), k
    if before.delta >= 0:
        assert after.delta == before.delta
    cuttable = ["dc_health", "downtime", "soiling", "snow_derate", "ac_module", "curtailment"]
    if before.delta < 0 and sum(max(before[c], 0) for c in cuttable) >= -before.delta:
        assert after.delta >= -1e-9


def test_kpi_rules(spark):
    cols = dict(inverter_generation=10.0, meter_generation=12.0, dc_health_loss=-1.0, downtime_loss=-2.0, curtailment_compensable=None,
                curtailment_non_compensable=3.0, inverter_availability=1.2, insurance_bi_adjustment=0.0, snow_derate_loss=None)
    df = spark.createDataFrame([("s", 1, *cols.values())], "site string, month int, " + ", ".join(f"{k} double" for k in cols))
    got = kp.apply_rules(df, F.col("site") == "s").first()
    assert (got.inverter_generation, got.dc_health_loss, got.downtime_loss, got.inverter_availability) == (12.0, 0.0, 0.0, 1.0)
    assert (got.curtailment_compensable, got.curtailment_non_compensable, got.curtailment_total) == (3.0, None, 3.0)
    assert (got.insurance_bi_adjustment, got.snow_derate_loss) == (None, 0.0)
    assert kp.apply_rules(df, gross_below_net="missing").first().inverter_generation is None


def test_waterfall_sums_to_the_balance(spark):
    got = kp.waterfall(kpi_row(spark)).orderBy("position").collect()
    assert [r.step for r in got][:3] == ["possible", "snow_derate_loss", "soiling_loss"]
    steps = {r.step: r.value for r in got}
    drawn = sum(v for k, v in steps.items() if k not in ("inverter", "meter"))
    assert drawn == pytest.approx(steps["meter"])


def test_performance_availability(spark):
    df = spark.createDataFrame([(90.0, None, None, 5.0, 2.0, 110.0, 100.0, 100.0), (90.0, 0.0, 0.0, 5.0, 2.0, 1.0, 100.0, None)],
        "meter_generation double, snow_derate_loss double, insurance_bi_adjustment double, curtailment_total double, budget_curtailment double, poa_insolation double, budget_poa double, budget_production double")
    assert [r[0] for r in df.select(kp.performance_availability()).collect()] == [pytest.approx(0.83), None]


def test_outage_log_dates(spark):
    log = spark.createDataFrame([("01/31/2024", "02/01/24"), ("03/05/24", None), ("soon", None)], "a string, b string")
    single = spark.createDataFrame([("1/5/2024",), ("01/05/2024 00:00",), ("1/5/24 6:30",), ("2024-01-05",)], "a string")
    assert rows(ins.parse_outage_dates(single, ["a"])) == [(ts("2024-01-05T00:00:00"),)] * 4
    assert rows(ins.parse_outage_dates(log, ["a", "b"])) == [
        (ts("2024-01-31T00:00:00"), ts("2024-02-01T00:00:00")), (ts("2024-03-05T00:00:00"), None)
    ]
    bad = spark.createDataFrame([("x",), ("y",), ("z",), ("01/01/24",)], "a string")
    with pytest.raises(Exception, match="unreadable dates"):
        ins.parse_outage_dates(bad, ["a"]).collect()


def test_pipeline_status(spark):
    data = [("a", "met", "raw", None), ("b", "met", "cleaned", None), ("c", "met", "processed", None), ("c", "met", "cleaned", None),
            ("d", "x", "model", None), ("d", "inverters", "cleaned", None), ("e", "x", "report", True), ("f", "x", "report", False)]
    df = spark.createDataFrame(data, "site string, group string, version string, draft boolean").withColumn("month", F.lit(1))
    assert rows(pipeline_status(df), "site", "next_step", "model_next") == [
        ("a", "manual qc", "auto_qc"), ("b", "backfill", "backfill"), ("c", "model", "model"), ("d", "report", None),
        ("e", "await utility meter", "query"), ("f", "nothing", "query"),
    ]


def test_capacity_limit_years(spark):
    sites = spark.createDataFrame([("p", "solar", 50.0), ("q", "wind", 75.0)], "site string, fleet string, capacity double")
    years = spark.createDataFrame([(y, f) for y in (2020, 2024, 2025, 2030) for f in ("solar", "wind")], "year int, fleet string")
    got = cp.eligible_sites(sites, years, cp.capacity_limits(spark))
    assert rows(got, "site", "year") == [("p", 2025), ("p", 2030), ("q", 2025), ("q", 2030)]


# --- model inputs and day ahead ------------------------------------------------------


def test_combiner_modules(spark):
    data = [("s", "i", "one", 320.0, 10, 18, 325, None, None, None), ("s", "i", "mix", 320.0, 10, 18, 325, 4, 21, 350)]
    df = spark.createDataFrame(data, "site string, inv string, cmb string, stc double, string_count_1 int, string_length_1 int, mod_wattage_1 int, string_count_2 int, string_length_2 int, mod_wattage_2 int")
    watts = 180 * 325 + 84 * 350
    assert rows(mi.combiner_modules(df), "cmb", "n_modules", "wattage", "string_length", "string_count") == [
        ("mix", 264.0, float(watts), 19, int(watts / (320 * 19))), ("one", 180.0, 58500.0, 18, 10)
    ]


def test_daily_peak_takes_the_first_maximum(spark):
    df = spark.createDataFrame([("p", H[5], 70.0, 50.0), ("p", H[3], 70.0, 40.0), ("p", H[8], 60.0, 50.0)], "site string, ts timestamp_ntz, temp_f double, humidity double")
    peak = da.daily_peaks(df, ["site"]).first()
    assert (peak.ts, peak.humidity) == (H[3], 40.0)


def test_unmatched_pairs_and_combiner_currents(spark):
    pairs = spark.createDataFrame([("a", "matched"), ("b", "ambiguous")], "cmb string, status string")
    assert [r.cmb for r in cb.unmatched(pairs, True).collect()] == ["b"] and cb.unmatched(pairs, False).count() == 0
    currents = spark.createDataFrame([("s", "i", "c", -2.0, 4.0), ("s", "i", "d", 6.0, -1.0)], "site string, inv string, cmb string, amps double, i_mp double")
    weights = spark.createDataFrame([("s", "i", "c", 2.0), ("s", "i", "d", 0.5)], "site string, inv string, cmb string, dc_weight double")
    got = cb.actual_and_possible(currents, weights)
    assert rows(got, "cmb", "amps", "i_mp", "adjusted_amps") == [("c", 0.0, 4.0, 0.0), ("d", 6.0, 0.0, 12.0)]
