"""v2 warehouse pipeline (D4 v2 form, D11-D14, D24).

Stream-depletion split of rates and volumes between surface water and
groundwater, then zone sums. Rules are in SURVEY §2.8; every masked
assignment is one ``when`` chain (last write wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config as C
from ..functions.measures import months_span, volume_to_rate
from ..functions.text import strip_ws, title_words
from ..operators.aggregate import exact_mean
from ..operators.clean import recode
from ..operators.dedup import first_by
from ..operators.hierarchy import fill_from_relatives
from ..operators.reshape import month_bounds, month_count, month_ffill, to_long
from ..session import materialize
from .common import clean_permits, known_rows, take_rows


def filled_rows(wap_allo: DataFrame, permits: DataFrame, sites: DataFrame, edges: DataFrame,
                fill_sites: bool = True) -> DataFrame:
    """Clean take rows, missing sites filled from relatives (H1), null sites dropped.

    The rows are not written: the walk writes their (permit, site) pairs, and whoever reads the rows has only the
    columns that it needs dealt by permit, which also serves all groupings and joins whose keys hold the permit."""
    if fill_sites:
        wa = fill_from_relatives(known_rows(wap_allo, sites), edges, "RecordNumber", "WAP", nodes=permits)
    else:
        wa = take_rows(wap_allo, permits, sites).repartition("RecordNumber")
    return wa.filter(F.col("WAP").isNotNull())


def season_means(wa: DataFrame, wrap: str = "reference") -> DataFrame:
    """D4 aggregation: per (permit, take type, block, site): month-weighted mean
    rates and volumes (half-even to 2 digits), month range and include flag.

    The month explode of the reference is replaced by its closed form (weight =
    number of months in the season), so no row is multiplied by up to 12.
    """
    lo, hi = month_bounds("FromMonth", "ToMonth", wrap)
    wa = wa.withColumns({"_w": month_count("FromMonth", "ToMonth", wrap), "_lo": lo, "_hi": hi})
    keys = ["RecordNumber", "take_type", "AllocationBlock", "WAP"]
    means = ["WapRate", "AllocatedRate", "VolumeDaily", "VolumeWeekly", "Volume30Day", "Volume150Day", "SD1", "SD2"]
    # flag of the earliest season (ties: False first), packed into one integer
    # so the choice is a plain min in the hash aggregate
    wa = wa.withColumn("_flag_key", F.col("FromMonth") * 1000 + F.col("ToMonth") * 10
                       + F.col("IncludeInSwAllocation").cast("int"))
    aggs = [exact_mean(c, "_w", 2).alias(c) for c in means]
    aggs += [F.min("_lo").alias("FromMonth"), F.max("_hi").alias("ToMonth"),
             (F.min("_flag_key") % 10 == 1).alias("IncludeInSwAllocation")]
    return wa.groupBy(*keys).agg(*aggs)


def seasonal_rates(wap_allo: DataFrame, permits: DataFrame, sites: DataFrame, edges: DataFrame,
                   wrap: str = "reference", fill_sites: bool = True) -> DataFrame:
    """Cleaned, site-filled take rows reduced to seasonal means."""
    return season_means(filled_rows(wap_allo, permits, sites, edges, fill_sites), wrap)


def waps_table(sites: DataFrame) -> DataFrame:
    """The Waps dimension of v2 from the site register (D22 computes the full one)."""
    return sites.select(
        F.col("ExtSiteID").alias("Wap"),
        F.coalesce("SD1_7Day", F.lit(0)).alias("SD1_7Day"),
        F.coalesce("SD1_150Day", F.lit(0)).alias("SD1_150Day"),
        F.coalesce("Storativity", F.lit(False)).alias("Storativity"),
        "GwSpatialUnitId", "SwSpatialUnitId",
        F.coalesce("Combined", F.lit(False)).alias("Combined"))


def clean_consented_flags(consented: DataFrame) -> DataFrame:
    """(RecordNumber, TakeType, LowflowCondition) with the takes vocabulary."""
    from ..operators.clean import to_bool
    return consented.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        title_words(strip_ws("take_type")).alias("TakeType"),
        to_bool("LowflowCondition", "takes").alias("LowflowCondition"))


def sd_category(rate150: Column, sd150: Column, sd7: Column, take_type: Column) -> Column:
    """D11 category, later rules overwrite earlier ones."""
    return (F.when(take_type == C.TAKE_SW, F.lit("direct"))
             .when(sd7 >= 90, F.lit("direct"))
             .when(sd150 >= 60, F.lit("high"))
             .when(((rate150 * (sd150 * 0.01)) > 5) | (sd150 >= 40), F.lit("moderate"))
             .otherwise(F.lit("low")))


def sd_volume_ratio(cat: Column) -> Column:
    r = C.SD_VOLUME_RATIO
    return (F.when(cat == "low", F.lit(r["low"])).when(cat == "moderate", F.lit(r["moderate"]))
             .when(cat == "high", F.lit(r["high"])).otherwise(F.lit(r["direct"])))


def sd_rate_inputs(seasons: DataFrame, waps: DataFrame, lowflow: DataFrame) -> DataFrame:
    """Seasonal rows with site depletion and low-flow flag, one row per
    (permit, block, site): the groundwater take type wins (reference keeps the
    first row in key order)."""
    s = seasons.select("RecordNumber", F.col("take_type").alias("TakeType"), "AllocationBlock", F.col("WAP").alias("Wap"), "AllocatedRate",
                       "VolumeDaily", "Volume150Day", "FromMonth", "ToMonth", "IncludeInSwAllocation")
    # seasons lie dealt by permit: what needs no more than that comes before they are dealt by site
    s = first_by(s, ["RecordNumber", "AllocationBlock", "Wap"], [("TakeType", "asc")])
    flags = lowflow.filter(F.col("RecordNumber").isNotNull() & F.col("TakeType").isNotNull()).repartition("RecordNumber").groupBy("RecordNumber", "TakeType").agg(
        F.min(F.coalesce("LowflowCondition", F.lit(False))).alias("f"))
    flags = flags.groupBy("RecordNumber").agg(F.map_from_entries(F.collect_list(F.struct("TakeType", "f"))).alias("_flags"))  # an entry a take type
    s = s.join(flags, "RecordNumber", "left")
    s = s.withColumn("LowflowCondition", F.coalesce(F.try_element_at("_flags", "TakeType"), F.lit(False))).drop("_flags")
    s = s.join(first_by(waps, ["Wap"], []), "Wap", "inner")
    s = s.withColumns({
        "RateDaily": volume_to_rate(F.col("VolumeDaily"), days=1),
        "Rate150Day": (F.col("Volume150Day") / 150 / 24 / 60 / 60) * 1000,
    })
    cat = sd_category(F.col("Rate150Day"), F.col("SD1_150Day"), F.col("SD1_7Day"), F.col("TakeType"))
    return s.withColumn("sd_cat", cat).withColumn("sw_vol_ratio", sd_volume_ratio(F.col("sd_cat")))


def sd_rates(inputs: DataFrame, alt: bool = False) -> DataFrame:
    """D11 rates: (RecordNumber, AllocationBlock, Wap, HydroGroup, AllocatedRate).

    ``alt`` switches to the variant rule set (D24)."""
    out = inputs.select("RecordNumber", "AllocationBlock", "Wap", *sd_rate_columns(alt))
    return to_long(out, ["RecordNumber", "AllocationBlock", "Wap"], [C.HG_GW, C.HG_SW],
                   "HydroGroup", "AllocatedRate")


def sd_rate_columns(alt: bool = False) -> list[Column]:
    """The rates of ``sd_rates`` as a column for each hydro group."""
    gw = F.col("TakeType") == C.TAKE_GW
    sw = F.col("TakeType") == C.TAKE_SW
    cat = F.col("sd_cat")
    mod, high, direct = cat == "moderate", cat == "high", cat == "direct"
    r150 = F.col("Rate150Day")
    if alt:
        alt_bool = (mod & F.col("Storativity")) | high | (mod & F.col("Combined"))
    else:
        alt_bool = ((F.col("Storativity") | F.col("LowflowCondition")) & (mod | high)) | F.col("Combined")
    sw_rate = (F.when(sw, F.col("AllocatedRate"))
                .when(direct & gw, F.col("RateDaily"))
                .when(mod | high, r150 * (F.col("SD1_150Day") * 0.01))
                .otherwise(F.lit(0.0)))
    sw_pre = F.when(mod | high, r150 * (F.col("SD1_150Day") * 0.01)).otherwise(F.lit(0.0))
    gw_rate = (F.when(alt_bool, r150 - sw_pre).when(gw, r150).otherwise(F.lit(0.0)))
    return [gw_rate.cast("double").alias(C.HG_GW), sw_rate.cast("double").alias(C.HG_SW)]


def clean_allocated_volume(av: DataFrame) -> DataFrame:
    """Annual volumes per (permit, take type, block), cleaned; when the block
    recode makes two rows collide the exact label wins."""
    v = av.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        title_words(strip_ws("take_type")).alias("TakeType"),
        strip_ws("allo_block").alias("_raw_block"),
        F.col("FullAnnualVolume").try_cast("double").cast("bigint").alias("FullAnnualVolume"),
        F.coalesce(title_words(strip_ws("IncludeInGwAllocation")) != F.lit("No"), F.lit(True)).alias("IncludeInGwAllocation"),
    ).withColumn("AllocationBlock", recode(F.col("_raw_block"), C.BLOCK_RECODES)).repartition("RecordNumber")  # as take rows lie
    v = first_by(v, ["RecordNumber", "TakeType", "AllocationBlock"], [("_raw_block", "asc")])
    return v.drop("_raw_block")


def group_total(col: str, keys: list[str]) -> Column:
    """A5 over rows that lie dealt and sorted by (some of) the keys already: the sum streams over them, and the rows are not
    made a second time to be summed."""
    return F.coalesce(F.sum(col).over(Window.partitionBy(*keys)), F.lit(0))


def permit_volumes(volumes: DataFrame) -> DataFrame:
    """(RecordNumber, _volumes): a permit's annual volumes as a list, an entry a take type and block."""
    entry = F.struct("TakeType", "AllocationBlock", "FullAnnualVolume", "IncludeInGwAllocation")
    return volumes.groupBy("RecordNumber").agg(F.collect_list(entry).alias("_volumes"))


def with_own_volume(seasons: DataFrame, volumes: DataFrame) -> DataFrame:
    """Seasonal rows with the volumes of their (permit, take type, block), met by permit as the rows lie dealt by it."""
    rows = seasons.join(permit_volumes(volumes), "RecordNumber")
    own = F.filter("_volumes", lambda v: (v["TakeType"] == F.col("TakeType")) & (v["AllocationBlock"] == F.col("AllocationBlock")))
    rows = rows.withColumn("_own", F.explode(own))
    return rows.withColumns({c: F.col("_own")[c] for c in ("FullAnnualVolume", "IncludeInGwAllocation")}).drop("_volumes", "_own")


def sd_volumes(rows: DataFrame, alt: bool = False) -> DataFrame:
    """D12 volumes by Rate150Day share with the discount rule.

    ``rows``: one a (permit, take type, site) with its Rate150Day, ``_total`` of the permit's take type, ``_f`` (depletion
    of its first block) and the permit's ``_volumes``. Adds ``_v``, the list of the take type's volumes here: the
    block and for each hydro group, under its name, a struct (TakeType, inc, vol), null where there is none."""
    own = F.filter("_volumes", lambda v: v["TakeType"] == F.col("TakeType"))
    rows = rows.withColumn("_own", own)
    # each of the take type's volumes counts the sites' rates
    ratio = F.coalesce(F.try_divide(F.col("Rate150Day"), F.coalesce(F.col("_total") * F.size("_own"), F.lit(0.0))), F.lit(0.0))
    rows = rows.withColumn("_ratio", ratio)
    f = F.col("_f")
    cat = f["sd_cat"]
    if alt:
        discount = ((cat == "moderate") & f["Storativity"]) | ((cat == "moderate") & f["Combined"]) \
            | (cat == "high") | (cat == "direct")
    else:
        discount = ((f["Storativity"] | f["LowflowCondition"]) & cat.isin("moderate", "high", "direct")) \
            | f["Combined"]
    rows = rows.withColumns({"_discount": discount, "_sw_ratio": f["sw_vol_ratio"]})

    def split(v: Column) -> Column:
        full = F.bround(v["FullAnnualVolume"] * F.col("_ratio"))
        sw = (full * F.col("_sw_ratio")).cast("double")
        gw = (F.when(F.col("_discount"), full - full * F.col("_sw_ratio"))
               .when(F.col("TakeType") == C.TAKE_SW, F.lit(0.0))
               .otherwise(full)).cast("double")
        of = lambda vol: F.when(vol.isNotNull(), F.struct(F.col("TakeType"), v["IncludeInGwAllocation"].alias("inc"), vol.alias("vol")))
        return F.struct(v["AllocationBlock"].alias("b"), of(gw).alias(C.HG_GW), of(sw).alias(C.HG_SW))
    return rows.withColumn("_v", F.transform("_own", split)).drop("_own", "_ratio", "_discount", "_sw_ratio")


def consented_allocation(seasons: DataFrame, waps: DataFrame, lowflow: DataFrame,
                         volumes: DataFrame, permits: DataFrame, alt: bool = False,
                         inputs: DataFrame | None = None, parity: bool = False) -> DataFrame:
    """Per (permit, hydro group, block, site): allocated rate and annual
    volume with permit and zone columns (the ConsentedAllocation table).
    ``inputs`` (the depletion inputs) are built here when not given. They are dealt by permit once: a row for each
    (permit, site) lists its blocks' rates and volumes, of both hydro groups, which become rows of their own last."""
    if inputs is None:
        inputs = sd_rate_inputs(seasons, waps, lowflow)
    groups = (C.HG_GW, C.HG_SW)
    block = F.col("AllocationBlock").alias("b")
    rates = F.struct(block, *[r.alias(f"_rate {g}") for g, r in zip(groups, sd_rate_columns(alt))], "FromMonth", "ToMonth",
                     F.col("IncludeInSwAllocation").alias("_inc"), F.when(F.col("AllocationBlock").isNotNull(), F.col("IncludeInSwAllocation")).alias("_sw_inc"))
    rows = inputs.select("RecordNumber", "Wap", "TakeType", "AllocationBlock", "Rate150Day", rates.alias("_r"), F.struct(
        "Storativity", "Combined", "sd_cat", "sw_vol_ratio", "LowflowCondition").alias("_f"), F.struct("GwSpatialUnitId", "SwSpatialUnitId", "Combined").alias("_z"))
    # nothing of what follows is dealt again: a row a permit, take type and site, then a row a permit and site
    rows = rows.repartition("RecordNumber").groupBy("RecordNumber", "TakeType", "Wap").agg(
        F.sum("Rate150Day").alias("Rate150Day"), F.min_by("_f", "AllocationBlock").alias("_f"), F.collect_list("_r").alias("_r"), F.max("_z").alias("_z"))
    rows = rows.withColumn("_total", F.sum("Rate150Day").over(Window.partitionBy("RecordNumber", "TakeType")))
    rows = sd_volumes(rows.join(permit_volumes(volumes), "RecordNumber"), alt)
    site = rows.groupBy("RecordNumber", "Wap").agg(F.flatten(F.collect_list("_r")).alias("_r"), F.flatten(F.collect_list("_v")).alias("_v"), F.max("_z").alias("_z"))
    site = site.filter(F.size("_v") > 0)  # a permit's site without a volume row of its take types takes no part
    site = site.join(permits.select("RecordNumber", "ConsentStatus", F.col("FromDate").alias("PermitFromDate"), F.col("ToDate").alias("PermitToDate")), "RecordNumber")
    site = site.withColumns({"FromMonth": F.array_min(F.col("_r.FromMonth")), "ToMonth": F.array_max(F.col("_r.ToMonth"))}).select("*", "_z.*").drop("_z")
    # the blocks of either list, each with the volumes of its first take type; a null block meets no rates
    def volume(same) -> Column:
        of = F.filter("_v", same)
        return F.struct(*[F.array_min(F.transform(of, (lambda g: lambda v: v[g])(g))).alias(g) for g in groups])
    met = F.transform("_r", lambda r: F.struct(r["b"].alias("b"), r.alias("r"), volume(lambda v: v["b"] == r["b"]).alias("v")))
    alone = F.filter(F.array_distinct(F.transform("_v", lambda v: v["b"])), lambda b: ~F.coalesce(F.exists("_r", lambda r: r["b"] == b), F.lit(False)))
    lone = F.transform(alone, lambda b: F.struct(b.alias("b"), F.get("_r", F.lit(-1)).alias("r"), volume(lambda v: v["b"].eqNullSafe(b)).alias("v")))
    # nearly all sites have one rate and one volume: these need no search through lists, which costs most of the step's time
    r0, v0, no_r = F.get("_r", F.lit(0)), F.get("_v", F.lit(0)), F.get("_r", F.lit(-1))
    own, no_v = (F.struct(*[v[g].alias(g) for g in groups]).alias("v") for v in (v0, F.get("_v", F.lit(-1))))
    plain = F.when(F.coalesce(v0["b"] == r0["b"], F.lit(False)), F.array(F.struct(r0["b"].alias("b"), r0.alias("r"), own))).otherwise(
        F.array(F.struct(r0["b"].alias("b"), r0.alias("r"), no_v), F.struct(v0["b"].alias("b"), no_r.alias("r"), own)))
    rv = site.withColumn("_b", F.explode(F.when((F.size("_r") == 1) & (F.size("_v") == 1), plain).otherwise(F.concat(met, lone))))
    if parity:
        # DF6 parity: months and SW flag joined on (permit, site) only, fanning
        # out over the permit's blocks at that site as the reference does
        rv = rv.withColumn("_s", F.explode("_r")).withColumns({"FromMonth": F.col("_s.FromMonth"), "ToMonth": F.col("_s.ToMonth"), "_sw_inc": F.col("_s._inc")}).drop("_s")
    else:
        rv = rv.withColumn("_sw_inc", F.col("_b.r._sw_inc"))
    either = F.array(*[F.struct(F.lit(g).alias("HydroGroup"), F.col(f"_b.r.`_rate {g}`").alias("AllocatedRate"), F.col(f"_b.v.`{g}`.vol").alias("AllocatedAnnualVolume"),
                                F.col(f"_b.v.`{g}`.inc").alias("_gw_inc")) for g in groups])
    rv = rv.drop("_r", "_v").withColumn("AllocationBlock", F.col("_b.b"))
    rv = rv.withColumn("_g", F.explode(either)).filter("_g.AllocatedRate IS NOT NULL OR _g.AllocatedAnnualVolume IS NOT NULL").select("*", "_g.*")
    is_sw = F.col("HydroGroup") == C.HG_SW
    rv = rv.filter(is_sw | F.coalesce(F.col("_gw_inc"), F.lit(True)))
    rv = rv.filter(~is_sw | F.coalesce(F.col("_sw_inc"), F.lit(True)))
    span = months_span("FromMonth", "ToMonth")
    vol = F.coalesce(F.col("AllocatedAnnualVolume"),
                     F.bround(F.col("AllocatedRate") * 0.001 * 60 * 60 * 24 * C.DAYS_PER_MONTH * span))
    rate = F.coalesce(F.col("AllocatedRate"),
                      F.floor(F.col("AllocatedAnnualVolume") / 60 / 60 / 24 / C.DAYS_PER_MONTH / span * 1000).cast("double"))
    rv = rv.withColumns({"AllocatedAnnualVolume": vol, "AllocatedRate": rate})
    rv = rv.filter((F.col("AllocatedAnnualVolume") > 0) | (F.col("AllocatedRate") > 0))
    rv = rv.withColumns({
        "AllocatedAnnualVolume": F.bround(F.coalesce("AllocatedAnnualVolume", F.lit(0.0))).cast("bigint"),
        "AllocatedRate": F.bround(F.coalesce("AllocatedRate", F.lit(0.0))).cast("bigint"),
    })
    gw_zone = (F.col("HydroGroup") == C.HG_GW) | F.col("Combined")
    rv = rv.withColumn("SpatialUnitId", F.when(gw_zone, F.col("GwSpatialUnitId")).otherwise(F.col("SwSpatialUnitId")))
    return rv.select("RecordNumber", "HydroGroup", "AllocationBlock", "Wap", "GwSpatialUnitId", "SwSpatialUnitId",
                     "SpatialUnitId", "Combined", "ConsentStatus",
                     F.col("PermitFromDate").alias("FromDate"), F.col("PermitToDate").alias("ToDate"),
                     F.col("FromMonth").cast("int").alias("FromMonth"), F.col("ToMonth").cast("int").alias("ToMonth"),
                     "AllocatedRate", "AllocatedAnnualVolume")


def variant_inputs(seasons: DataFrame, volumes: DataFrame) -> DataFrame:
    """Seasonal rows with the volume of their own take type and block, shared by WapRate (undefined share: 1); one
    row per (permit, block, site), the groundwater take first. All of it is made where a permit's rows lie."""
    s = seasons.withColumnsRenamed({"take_type": "TakeType", "WAP": "Wap"})
    j = with_own_volume(s, volumes).withColumn("_wr", F.col("WapRate").cast("decimal(18,2)"))  # two decimals: summed exactly
    j = j.withColumn("_agg", group_total("_wr", ["RecordNumber", "TakeType", "AllocationBlock"]))
    share = F.coalesce(F.try_divide(F.col("WapRate"), F.col("_agg").cast("double")), F.lit(1.0))
    # only what the variant reads: a first row is taken whole
    j = j.select("RecordNumber", "TakeType", "AllocationBlock", "Wap", "AllocatedRate", "VolumeDaily", "Volume150Day", "FromMonth", "ToMonth",
                 "IncludeInSwAllocation", "IncludeInGwAllocation", F.bround(F.col("FullAnnualVolume") * share).alias("FullAnnualVolume"))
    return first_by(j, ["RecordNumber", "AllocationBlock", "Wap"], [("TakeType", "asc")])


def variant_allocation(inputs: DataFrame, permits: DataFrame, waps: DataFrame) -> DataFrame:
    """Per (permit, hydro group, block, site): rate and annual volume under the variant's rules, from rows of
    ``variant_inputs``. Here zero means missing: a zero volume is estimated from the rate, a zero rate (floored) from the volume.

    A row holds both hydro groups' rates and volumes, so it meets its permit where it lies, is dealt by site once, and
    becomes a row for each hydro group last. Of a site's rows in ``waps`` the first gives its depletion, each gives its zone."""
    depletion = [c for c in waps.columns if c != "Wap"]
    site = waps.groupBy("Wap").agg(F.min(F.struct(*depletion)).alias("_site"), F.collect_list(F.struct(F.col("GwSpatialUnitId").alias("zone"), "Combined")).alias("_zones"))
    j = inputs.join(permits.select("RecordNumber", "ConsentStatus", F.col("FromDate"), F.col("ToDate")), "RecordNumber").join(site, "Wap").select("*", "_site.*").drop("_site")
    j = j.withColumns({"RateDaily": volume_to_rate(F.col("VolumeDaily"), days=1), "Rate150Day": (F.col("Volume150Day") / 150 / 24 / 60 / 60) * 1000})
    j = j.withColumn("sd_cat", sd_category(F.col("Rate150Day"), F.col("SD1_150Day"), F.col("SD1_7Day"), F.col("TakeType")))
    cat, full = F.col("sd_cat"), F.col("FullAnnualVolume")
    discount = ((cat == "moderate") & (F.col("Storativity") | F.col("Combined"))) | cat.isin("high", "direct")
    sw = full * sd_volume_ratio(cat)
    gw = F.when(discount, full - sw).when(F.col("TakeType") == C.TAKE_SW, F.lit(0.0)).otherwise(full)
    j = j.select("*", *sd_rate_columns(alt=True))
    either = F.array(*[F.struct(F.lit(g).alias("HydroGroup"), F.col(f"`{g}`").alias("AllocatedRate"), v.cast("double").alias("AllocatedAnnualVolume"), F.col(inc).alias("_inc"))
                       for g, v, inc in ((C.HG_GW, gw, "IncludeInGwAllocation"), (C.HG_SW, sw, "IncludeInSwAllocation"))])
    rv = j.select("RecordNumber", "AllocationBlock", "Wap", "ConsentStatus", "FromDate", "ToDate", "FromMonth", "ToMonth", "_zones", F.explode(
        F.filter(either, lambda g: g["_inc"] & (g["AllocatedRate"].isNotNull() | g["AllocatedAnnualVolume"].isNotNull()))).alias("_g")).select("*", "_g.*").drop("_g")
    span, rate, volume = months_span("FromMonth", "ToMonth"), F.col("AllocatedRate"), F.col("AllocatedAnnualVolume")
    rv = rv.withColumn("AllocatedAnnualVolume", F.when(volume == 0, F.bround(rate * 0.001 * 60 * 60 * 24 * C.DAYS_PER_MONTH * span)).otherwise(volume))
    rv = rv.withColumn("AllocatedRate", F.when(rate == 0, F.floor(volume / 60 / 60 / 24 / C.DAYS_PER_MONTH / span * 1000).cast("double")).otherwise(rate))
    rv = rv.filter((volume > 0) | (rate > 0)).withColumn("_z", F.explode("_zones"))
    whole = lambda c: F.bround(F.coalesce(c, F.lit(0.0))).cast("bigint").alias(c)
    return rv.select("RecordNumber", "HydroGroup", "AllocationBlock", "Wap", F.col("_z.zone").alias("SpatialUnitId"), F.col("_z.Combined").alias("Combined"), "ConsentStatus", "FromDate", "ToDate",
                     F.col("FromMonth").cast("int").alias("FromMonth"), F.col("ToMonth").cast("int").alias("ToMonth"), whole("AllocatedRate"), whole("AllocatedAnnualVolume"))


def _gw_rows(alloc: DataFrame) -> Column:
    return (F.col("HydroGroup") == C.HG_GW) | F.col("Combined")


def gw_zone_allocation(alloc: DataFrame, in_process_is_active: bool = False) -> DataFrame:
    """Active and in-process annual volume per (zone, block).

    One pass: both sums are conditional aggregates of the same grouping, so a
    single partial aggregate replaces the two group-bys and the outer join."""
    active = F.col("ConsentStatus").isin(*C.ACTIVE_STATUSES)
    inproc = F.col("ConsentStatus").isin(*C.IN_PROCESS_STATUSES)
    if in_process_is_active:
        active = active | inproc
    g = alloc.filter(_gw_rows(alloc) & (active | inproc) & F.col("SpatialUnitId").isNotNull())
    return g.groupBy("SpatialUnitId", "AllocationBlock").agg(
        F.sum(F.when(active, F.col("AllocatedAnnualVolume"))).alias("AllocatedVolume"),
        F.sum(F.when(inproc, F.col("AllocatedAnnualVolume"))).alias("NewAllocationInProgress"))


def sw_zone_allocation(alloc: DataFrame, active_months: bool = False) -> DataFrame:
    """Monthly active and in-process rate per (zone, block), forward filled
    over months (W5); in-process joined left onto active.

    The allocation is read once: what both are filled from are its sums by zone, block and month, which are written."""
    swr = (F.col("HydroGroup") == C.HG_SW) & ~F.col("Combined")
    status = (F.when(F.col("ConsentStatus").isin(*C.ACTIVE_STATUSES), F.lit("active"))
               .when(F.col("ConsentStatus").isin(*C.IN_PROCESS_STATUSES), F.lit("in process")))
    to = "ToMonth" if active_months else None
    keys = ["SpatialUnitId", "AllocationBlock", "FromMonth", *([to] if to else [])]
    sums = alloc.filter(swr).withColumn("_status", status).filter(F.col("_status").isNotNull())
    sums = materialize(sums.groupBy(*keys, "_status").agg(F.sum("AllocatedRate").alias("AllocatedRate")), "sw-zone-sums")
    a, p = sums.filter("_status = 'active'"), sums.filter("_status = 'in process'")
    a2 = month_ffill(a, ["SpatialUnitId", "AllocationBlock"], "FromMonth", "AllocatedRate", active_to=to)
    p2 = month_ffill(p, ["SpatialUnitId", "AllocationBlock"], "FromMonth", "AllocatedRate", active_to=to)
    p2 = p2.withColumnRenamed("AllocatedRate", "NewAllocationInProgress")
    return a2.join(p2, ["SpatialUnitId", "AllocationBlock", "Month"], "left")


def run_v2(t, as_of: str | None = None, alt: bool = False, wrap: str = "reference"):
    """v2 stages over a ``Tables`` catalog (built lazily, see ``Stages``).

    Permits, which several stages read, are written once when first needed, as the reference writes them."""
    from ..operators.hierarchy import clean_edges
    from .common import Stages, clean_sites
    return Stages({
        "permits": lambda s: materialize(clean_permits(t["b_permit"], form="v2"), "permits"),
        "sites": lambda s: clean_sites(t["b_site"]),
        "edges": lambda s: clean_edges(t["b_parent_child"], s["permits"]),
        "seasons": lambda s: seasonal_rates(t["b_wap_allo"], s["permits"], s["sites"], s["edges"], wrap=wrap),
        "waps": lambda s: waps_table(s["sites"]),
        "lowflow": lambda s: clean_consented_flags(t["b_consented"]),
        "volumes": lambda s: clean_allocated_volume(t["b_allocated_volume"]),
        "inputs": lambda s: sd_rate_inputs(s["seasons"], s["waps"], s["lowflow"]),
        "allocation": lambda s: consented_allocation(s["seasons"], s["waps"], s["lowflow"], s["volumes"], s["permits"], alt=alt, inputs=s["inputs"]),
        "gw_zone": lambda s: gw_zone_allocation(s["allocation"], in_process_is_active=alt),
        "sw_zone": lambda s: sw_zone_allocation(s["allocation"]),
    })
