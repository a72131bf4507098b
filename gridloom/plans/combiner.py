"""Combiner health: design reconciliation, daily flags and loss matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.core.ordered import Series, ordinal
from gridloom.core.session import sized
from gridloom.functions.scalars import clip
from gridloom.functions.text import containing
from gridloom.operators.summaries import with_group

# Thresholds (amps, shares) and probe hours of the daily checks.
THRESHOLDS = {
    "offline_range": 1.0,
    "underperform": 0.75,
    "comms": 5.0,
    "calibration": 20.0,
    "tracker": 50.0,
    "curtailed": 0.625,
    "near_model": 0.95,
}
CALIBRATION_HOUR = 1
TRACKER_HOURS = (10, 12, 14)
# Symbol of each flag in the category matrix.
SYMBOLS = {
    "offline": "OFF",
    "underperform": "UND",
    "comms": "COMMS",
    "calibration": "CAL",
    "curtailment": "CURT",
    "tracker_east": "TRK",
    "tracker_west": "TRK",
    "tracker_center": "TRK",
}


def dc_weights(design: DataFrame, keys: Sequence[str] = ("site", "inv")) -> DataFrame:
    """Combiner size relative to its inverter's mean, and that divided by the count."""
    group = (F.avg("kwdc").alias("_mean"), F.count("*").alias("_n"))
    return (
        with_group(design, keys, *group)
        .withColumn("dc_weight", F.try_divide(F.col("kwdc"), F.col("_mean")))
        .withColumn("dc_weight_adj", F.col("dc_weight") / F.col("_n"))
        .drop("_mean", "_n")
    )


def reconcile_design(
    design: DataFrame, attributes: DataFrame, by_design: Series, by_attribute: Series, by_id: bool
) -> DataFrame:
    """Pair design combiners with attributes; ``status`` is matched or tells what is left.

    With ``by_id`` an attribute belongs to the combiner whose ``cmb_pi`` its name contains.
    Otherwise both sides are paired in order and the longer one loses its tail.
    """
    keys = list(by_design.keys)
    if by_id:
        ids = design.select("cmb_pi").distinct()
        named = containing(attributes.select("attribute").distinct(), "attribute", ids, "cmb_pi")
        named = attributes.select(*keys, "attribute").distinct().join(named, "attribute")
        hits = design.join(named, [*keys, "cmb_pi"], "left")
        counted = hits.groupBy(*keys, "cmb").agg(
            F.count("attribute").alias("_n"), F.min("attribute").alias("attribute")
        )
        status = (
            F.when(F.col("_n") == 1, "matched").when(F.col("_n") == 0, "no attribute").otherwise("ambiguous")
        )
        return counted.withColumn("status", status).drop("_n")
    left = ordinal(design, by_design, "position").select(*keys, "position", "cmb")
    right = ordinal(attributes, by_attribute, "position").select(*keys, "position", "attribute")
    status = (
        F.when(F.col("cmb").isNull(), "extra attribute")
        .when(F.col("attribute").isNull(), "extra design row")
        .otherwise("matched")
    )
    return left.join(right, [*keys, "position"], "full").withColumn("status", status)


def unmatched(pairs: DataFrame, by_id: bool) -> DataFrame:
    """Rows that must stop an analysis: with ids every pair has to match."""
    return pairs.filter("status != 'matched'") if by_id else pairs.filter("false")


def combiner_rows(
    combiners: DataFrame, inverters: DataFrame, weights: DataFrame, curtailment: DataFrame | None
) -> DataFrame:
    """Hourly combiner rows with possible power and inverter state.

    ``combiners``: site, inv, cmb, ts, amps, i_mp.  ``inverters``: site, inv, ts, kw,
    possible_kw.  ``weights`` comes from :func:`dc_weights`.
    """
    rows = combiners.withColumn("amps", clip("amps", 0.0)).join(
        sized(weights.select("site", "inv", "cmb", "dc_weight_adj")), ["site", "inv", "cmb"]
    )
    rows = rows.join(inverters, ["site", "inv", "ts"])
    if curtailment is None:
        rows = rows.withColumn("curtailed", F.lit(0.0))
    else:
        rows = rows.join(curtailment.select("site", "ts", "curtailed"), ["site", "ts"], "left")
    return rows.withColumn("cmb_possible_kw", F.col("possible_kw") * F.col("dc_weight_adj"))


def daily_flags(
    rows: DataFrame, keys: Sequence[str] = ("site", "inv", "cmb"), thresholds: dict = THRESHOLDS
) -> DataFrame:
    """First finding of each combiner and day with its loss in MWh.

    A day is skipped when the inverter never ran or produced close to the model.  All
    tests are conditional aggregates of one grouping.
    """
    t = thresholds
    online = F.col("kw") > 0
    hour = F.hour("ts")

    def when_online(c: str) -> Column:
        return F.when(online, F.col(c))

    first, noon, last = TRACKER_HOURS
    probes = []
    for at in TRACKER_HOURS:
        hit = online & (hour == at)
        probes += [
            F.count_if(hit).alias(f"_n{at}"),
            F.max(F.when(hit, F.col("amps"))).alias(f"_a{at}"),
            F.max(F.when(hit, F.col("i_mp"))).alias(f"_p{at}"),
        ]
    day = (
        rows.groupBy(*keys, F.to_date("ts").alias("date"))
        .agg(
            F.count_if(online).alias("_online"),
            F.sum(when_online("kw")).alias("_kwh"),
            F.sum(when_online("possible_kw")).alias("_possible_kwh"),
            F.coalesce(F.avg(F.when(F.col("possible_kw") > 0, F.col("curtailed"))), F.lit(0.0)).alias("_cf"),
            (F.coalesce(F.sum(when_online("cmb_possible_kw")), F.lit(0.0)) / 1e3).alias("_full"),
            (F.max(when_online("amps")) - F.min(when_online("amps"))).alias("_range"),
            F.coalesce(F.sum(when_online("amps")), F.lit(0.0)).alias("_amps"),
            F.coalesce(F.sum(when_online("i_mp")), F.lit(0.0)).alias("_imp"),
            F.count_if(hour == CALIBRATION_HOUR).alias("_n_cal"),
            F.max(F.when(hour == CALIBRATION_HOUR, F.col("amps"))).alias("_cal"),
            *probes,
        )
        .filter(F.col("_online") > 0)
        .filter(~F.coalesce(F.col("_kwh") > F.col("_possible_kwh") * t["near_model"], F.lit(False)))
        .withColumn("_poss", F.col("_full") * (1 - F.col("_cf")))
        .withColumn("_ratio", F.try_divide(F.col("_amps"), F.col("_imp")))
    )
    c = F.col
    flat = c("_range") < t["offline_range"]
    low = c("_ratio") < t["underperform"]
    probed = (c(f"_n{first}") > 0) & (c(f"_n{noon}") > 0) & (c(f"_n{last}") > 0)
    single = (c(f"_n{first}") == 1) & (c(f"_n{noon}") == 1) & (c(f"_n{last}") == 1)
    known = single & c(f"_a{first}").isNotNull() & c(f"_a{noon}").isNotNull() & c(f"_a{last}").isNotNull()
    modelled = c(f"_p{first}").isNotNull() & c(f"_p{noon}").isNotNull() & c(f"_p{last}").isNotNull()
    drift = c(f"_a{last}") - c(f"_a{first}")
    limit = t["tracker"]
    centred = (
        (c(f"_p{first}") - c(f"_a{first}") > limit)
        & (c(f"_p{last}") - c(f"_a{last}") > limit)
        & (c(f"_p{noon}") - c(f"_a{noon}") < limit)
    )
    none = F.lit(None).cast("string")
    flag = (
        F.when(c("_cf") > t["curtailed"], "curtailment")
        .when(flat & (c("_amps") > t["comms"]), "comms")
        .when(flat, "offline")
        .when((c("_n_cal") == 1) & (c("_cal") > t["calibration"]), "calibration")
        .when(~F.coalesce(low, F.lit(False)), none)
        .when(probed & ~known, none)
        .when(probed & (drift > limit), "tracker_west")
        .when(probed & (drift < -limit), "tracker_east")
        .when(probed & ~modelled, none)
        .when(probed & centred, "tracker_center")
        .otherwise("underperform")
    )
    loss = (
        F.when(c("flag").isin("comms", "calibration"), 0.0)
        .when(c("flag").isin("curtailment", "offline"), c("_poss"))
        .otherwise(c("_poss") * (1 - c("_ratio")))
    )
    return (
        day.withColumn("flag", flag)
        .filter(c("flag").isNotNull())
        .withColumn("loss_mwh", loss)
        .select(*keys, "date", "flag", "loss_mwh")
    )


def loss_by_flag(flags: DataFrame, keys: Sequence[str] = ("site", "inv", "cmb")) -> DataFrame:
    """Days and loss of every combiner and flag over the whole range."""
    return flags.groupBy(*keys, "flag").agg(
        F.count("*").alias("n_days"), F.sum("loss_mwh").alias("loss_mwh")
    )


def loss_matrix(
    losses: DataFrame, hierarchy: DataFrame, keys: Sequence[str] = ("site", "inv"), show: str = "loss"
) -> DataFrame:
    """Inverter rows by combiner columns, the cells holding the ``loss`` (MWh) or the ``category``.

    ``hierarchy`` lists the existing combiners, each with a column; one that an inverter does
    not have shows ``-/-``, a combiner without finding is empty.  Of several flags of one combiner the
    last in flag order shows.
    """
    symbols = F.create_map(*[F.lit(x) for kv in SYMBOLS.items() for x in kv])
    order = F.array_position(F.array(*[F.lit(k) for k in SYMBOLS]), F.col("flag"))
    cell = losses.groupBy(*keys, "cmb").agg(
        F.max_by(F.struct("flag", "loss_mwh"), order).alias("_f")
    )
    filled = hierarchy.select(*keys, "cmb").distinct().join(cell, [*keys, "cmb"], "left")
    if show == "category":
        shown = symbols[F.col("_f.flag")]
    else:
        shown = F.format_string("%.4f", F.col("_f.loss_mwh"))
    text = F.when(F.col("_f").isNotNull(), shown).otherwise("")
    wide = (
        filled.withColumn("_text", text)
        .groupBy(*keys)
        .pivot("cmb")
        .agg(F.first("_text"))
    )
    return wide.fillna("-/-", subset=[c for c in wide.columns if c not in keys])


def actual_and_possible(
    combiners: DataFrame, weights: DataFrame, keys: Sequence[str] = ("site", "inv", "cmb")
) -> DataFrame:
    """Combiner currents floored at zero beside the model, and divided by their weight."""
    rows = combiners.join(weights.select(*keys, "dc_weight"), list(keys))
    floored = rows.withColumns({c: clip(c, 0.0) for c in ("amps", "i_mp")})
    return floored.withColumn("adjusted_amps", F.try_divide(F.col("amps"), F.col("dc_weight")))
