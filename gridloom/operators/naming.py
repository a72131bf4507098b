"""Sensor types, attribute paths and asset hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name fragments per sensor type, tested in this order.
MET_FRAGMENTS = {
    "amb_temp": ["amb", "air_temp", "temp_air", "temp_c_skid"],
    "mod_temp": ["mod", "mdl", "mts", "mst", "pnltemp", "pnltmp", "bom"],
    "wind": ["wind", "wnd", "speed", "ws_ms"],
    "ghi": ["ghi", "global", "hor"],
    "poa": ["poa", "plane", "irr"],
}
# The coarser classes of automatic quality control.
QC_FRAGMENTS = {
    "GHI": ["ghi", "hor"],
    "POA": ["poa", "plane", "irr"],
    "TEMP": ["temp", "tmp", "bom", "mts", "mst", "mdl", "mod"],
    "WIND": ["wind", "wnd", "speed", "ws_ms"],
}
# Case-sensitive fragments of power attributes.
POWER_FRAGMENTS = {"INV": "ActivePower", "METER": "MeterMW"}


def has_any(name: Column, fragments: list[str]) -> Column:
    lowered = F.lower(name)
    out = F.lit(False)
    for fragment in fragments:
        out = out | lowered.contains(fragment)
    return out


def met_type(name: Column) -> Column:
    """First matching weather sensor type of an attribute name, else null."""
    out = F.lit(None).cast("string")
    for kind, fragments in reversed(MET_FRAGMENTS.items()):
        out = F.when(has_any(name, fragments), kind).otherwise(out)
    return out


def with_met_groups(df: DataFrame, attribute: str = "attribute") -> DataFrame:
    """Flags of the weather sensor groups; an attribute may belong to several.

    Each group is tested by itself with the fragments of :data:`MET_FRAGMENTS`; only plane of
    array excludes names of horizontal sensors.
    """
    name = F.col(attribute)
    ghi = has_any(name, MET_FRAGMENTS["ghi"])
    flags = {
        "in_poa": has_any(name, MET_FRAGMENTS["poa"]) & ~ghi,
        "in_ghi": ghi,
        "in_ambtemp": has_any(name, MET_FRAGMENTS["amb_temp"]),
        "in_modtemp": has_any(name, MET_FRAGMENTS["mod_temp"]),
        "in_wind": has_any(name, MET_FRAGMENTS["wind"]),
    }
    return df.withColumns(flags)


def with_qc_type(df: DataFrame, attribute: str = "attribute", inverter: str = POWER_FRAGMENTS["INV"]) -> DataFrame:
    """Class flags of automatic quality control; an attribute may belong to several.

    ``inverter`` is the fragment that marks inverter power.  Where only attributes of one name
    space are inverters, give it with its prefix.
    """
    name = F.col(attribute)
    ghi = has_any(name, QC_FRAGMENTS["GHI"])
    flags = {
        "is_ghi": ghi,
        "is_poa": has_any(name, QC_FRAGMENTS["POA"]) & ~ghi,
        "is_temp": has_any(name, QC_FRAGMENTS["TEMP"]),
        "is_wind": has_any(name, QC_FRAGMENTS["WIND"]),
        "is_inv": F.contains(name, F.lit(inverter)),
        "is_meter": name.contains(POWER_FRAGMENTS["METER"]),
    }
    df = df.withColumns(flags)
    return df.withColumn(
        "needs_sun", F.col("is_ghi") | F.col("is_poa") | F.col("is_inv") | F.col("is_meter")
    )


def parse_path(df: DataFrame, path: str = "path", fixed_depth: int = 3) -> DataFrame:
    r"""Split ``\\server\db\fleet\site\group\asset\...|attribute`` paths.

    ``fixed_depth`` is the number of parts before the site.
    """
    halves = F.split(F.col(path), r"\|")
    parts = F.filter(F.split(halves[0], r"\\"), lambda p: p != "")
    df = df.withColumn("_parts", parts)
    depth = F.size("_parts")
    site = F.get("_parts", F.lit(fixed_depth))
    below = F.when(
        depth > fixed_depth + 2, F.slice("_parts", fixed_depth + 3, F.greatest(depth - fixed_depth - 2, F.lit(0)))
    ).otherwise(F.array().cast("array<string>"))
    return (
        df.withColumn("site", site)
        .withColumn("asset_group", F.get("_parts", F.lit(fixed_depth + 1)))
        .withColumn("elements", below)
        .withColumn("attribute", F.get(halves, F.lit(1)))
        .withColumn("level", depth - fixed_depth)
        .drop("_parts")
    )


def column_names(paths: DataFrame) -> DataFrame:
    """Wide-frame column name of parsed paths.

    Attribute, then the elements from the innermost outwards, joined by underscores; the
    group is left out where the site has a single one.
    """
    groups = paths.groupBy("site").agg(F.count_distinct("asset_group").alias("_groups"))
    inner = F.reverse("elements")
    with_group = F.when(
        (F.col("_groups") > 1) & F.col("asset_group").isNotNull(),
        F.concat(inner, F.array("asset_group")),
    ).otherwise(inner)
    named = F.array_join(F.concat(F.array("attribute"), with_group), "_")
    return paths.join(groups, "site").withColumn("column_name", named).drop("_groups")


def wanted_attributes(
    assets: DataFrame, wanted: DataFrame, existing: DataFrame, group="asset_group"
) -> DataFrame:
    """Attributes to read: per asset the ones wanted for its group, ``valid`` if they exist."""
    pairs = assets.join(wanted, group)
    have = existing.select("site", "asset", "attribute").distinct().withColumn("valid", F.lit(True))
    return pairs.join(have, ["site", "asset", "attribute"], "left").withColumn(
        "valid", F.coalesce("valid", F.lit(False))
    )


def flatten_hierarchy(nested: DataFrame, groups: str = "groups") -> DataFrame:
    """``site, map<group, array<asset>>`` rows to one row per asset."""
    by_group = nested.select("site", F.explode(groups).alias("asset_group", "_assets"))
    return by_group.select("site", "asset_group", F.explode("_assets").alias("asset"))


def wide(df: DataFrame, ids: list[str], names: list[str] | None = None, attribute="attribute", value="value"):
    """Long rows to one column per attribute, ordered from the innermost id, then time.

    The columns are the attributes that occur.  With ``names`` they are these; an attribute
    that is not among them is an error, so no value disappears.
    """
    if names is not None:
        known = F.col(attribute).isin(names)
        wrong = F.raise_error(F.concat(F.lit("attribute without a column: "), F.coalesce(attribute, F.lit("null"))))
        df = df.withColumn(attribute, F.when(known, F.col(attribute)).otherwise(wrong.cast("string")))
    flat = df.groupBy(*ids).pivot(attribute, names).agg(F.first(value, ignorenulls=True))
    return flat.orderBy(*reversed(ids))
