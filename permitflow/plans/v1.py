"""v1 relational pipeline.

Rates and volumes per permit x allocation block x site, consented conditions
per permit x activity x site, water-use classes, linked permits and low-flow
conditions. Identifiers are natural keys; surrogate ids come from K8 when a
table needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import config as C
from ..functions.measures import months_span
from ..functions.text import fix_spacing, replace_word, strip_ws, title_words
from ..operators.clean import (
    drop_all_null, keep_any_positive, nullify_nonpositive, recode, rollup_codes, to_bool, validate_code,
)
from ..operators.dedup import first_by, first_by_priority
from ..operators.kept import keep_dimension
from ..operators.joins import cross_dims, expand_pairs, keep_existing, missing_from
from ..operators.reshape import split_by_flags, to_long, union_values
from ..operators.sync import assign_ids, assign_ids_once
from ..session import materialize
from .common import clean_permits, clean_sites
from .v2 import clean_allocated_volume, filled_rows, group_total, season_means, with_own_volume


def allo_blocks(wap_allo: DataFrame, allocated_volume: DataFrame, hydro_groups=None) -> DataFrame:
    """AlloBlock dimension: every block seen in rates or volumes x every
    configured hydro group, with surrogate ids (K8)."""
    a = wap_allo.select(recode(strip_ws("sw_allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    b = allocated_volume.select(recode(strip_ws("allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    blocks = cross_dims(union_values(a, b), "HydroGroup", hydro_groups or C.HYDRO_GROUPS)
    return assign_ids(blocks, ["AllocationBlock", "HydroGroup"], id_col="AlloBlockID")


def base_dimensions(spark, path: str, blocks: DataFrame, hydro_groups=None, activities=None, attributes=None) -> dict[str, DataFrame]:
    """The four base dimensions as tables kept under ``path``, to which each run adds only what is missing (K8 ids stay).

    ``blocks``: (AllocationBlock) as ``seen_blocks`` gives it; the other lists come from configuration.
    """
    def listed(values, name: str) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))

    groups, _ = keep_dimension(spark, f"{path}/HydroGroup", listed(hydro_groups or C.HYDRO_GROUPS, "HydroGroup"), "HydroGroup", "HydroGroupID")
    # the products with the groups are generators over the configured list of groups
    ids = groups.select(F.collect_list("HydroGroupID")).first()[0]
    activity = cross_dims(listed(activities or C.ACTIVITY_TYPES, "ActivityType"), "HydroGroupID", sorted(ids))
    activity, _ = keep_dimension(spark, f"{path}/Activity", activity, ["ActivityType", "HydroGroupID"], "ActivityID")
    block, _ = keep_dimension(spark, f"{path}/AlloBlock", cross_dims(blocks, "HydroGroupID", sorted(ids)), ["AllocationBlock", "HydroGroupID"], "AlloBlockID")
    attribute, _ = keep_dimension(spark, f"{path}/Attributes", listed(attributes or C.ATTRIBUTES, "Attribute"), "Attribute", "AttributeID")
    return {"HydroGroup": groups, "Activity": activity, "AlloBlock": block, "Attributes": attribute}


def seen_blocks(wap_allo: DataFrame, allocated_volume: DataFrame) -> DataFrame:
    """(AllocationBlock): every block of rates or volumes."""
    return union_values(wap_allo.select(recode(strip_ws("sw_allo_block"), C.BLOCK_RECODES).alias("AllocationBlock")),
                        allocated_volume.select(recode(strip_ws("allo_block"), C.BLOCK_RECODES).alias("AllocationBlock")))


def used_sites(wap_allo: DataFrame, divert: DataFrame) -> DataFrame:
    """(WAP): valid site codes of takes or diverts."""
    return (wap_allo.select(validate_code(F.upper(strip_ws("WAP"))).alias("WAP"))
            .unionByName(clean_divert_sites(divert)).filter(F.col("WAP").isNotNull()).distinct())


def keep_sites(spark, path: str, wap_allo: DataFrame, divert: DataFrame, register: DataFrame) -> DataFrame:
    """The kept table of used sites that the register has, with ids that stay over runs, and their depletion."""
    used = used_sites(wap_allo, divert).join(register, F.col("WAP") == F.col("ExtSiteID"), "left_semi")
    ids, _ = keep_dimension(spark, path, used.withColumnRenamed("WAP", "ExtSiteID"), "ExtSiteID", "SiteID")
    return ids.join(register, "ExtSiteID").select("SiteID", "ExtSiteID", F.col("NZTMX").cast("int").alias("NZTMX"), F.col("NZTMY").cast("int").alias("NZTMY"),
                                                  "SD1_7Day", "SD1_150Day")


def clean_divert_sites(divert: DataFrame) -> DataFrame:
    return divert.select(validate_code(F.upper(strip_ws("WAP"))).alias("WAP"))


def missing_sites(wap_allo: DataFrame, divert: DataFrame, sites: DataFrame) -> DataFrame:
    """Valid site codes used by takes or diverts that the register lacks."""
    return missing_from(used_sites(wap_allo, divert), sites, "WAP", ref_on="ExtSiteID")


def site_months(rows: DataFrame) -> DataFrame:
    """(permit, take type, site) with season bounds and the number of sites of
    the permit and take type (``wap_count``)."""
    m = rows.filter(F.col("WAP").isNotNull()).groupBy("RecordNumber", "take_type", "WAP").agg(
        F.min("FromMonth").alias("FromMonth"), F.max("ToMonth").alias("ToMonth"))
    # the rows lie dealt by permit: counted where they are; as with a join, a null key has no count
    count = F.count("WAP").over(Window.partitionBy("RecordNumber", "take_type"))
    return m.withColumn("wap_count", F.when(F.col("RecordNumber").isNotNull() & F.col("take_type").isNotNull(), count))


def allocated_rate_volume(seasons: DataFrame, volumes: DataFrame) -> DataFrame:
    """D5 (v1): volumes split over sites by WapRate share (undefined share -> 1),
    then between SW and GW: a GW take gives SD1 to surface water and the rest
    to groundwater, volumes in the same proportion; SW takes are all SW. Rows
    are kept per include flag; zero means missing and is estimated from the
    other quantity; results are half-even integers."""
    s = seasons.withColumnRenamed("take_type", "TakeType")
    j = with_own_volume(s, volumes)
    # WapRate has 2 decimals: summed exactly so every engine gets the same share
    j = j.withColumn("_wr", F.col("WapRate").cast("decimal(18,2)"))
    j = j.withColumn("_agg", group_total("_wr", ["RecordNumber", "TakeType", "AllocationBlock"])).drop("_wr")
    ratio = F.coalesce(F.try_divide(F.col("WapRate"), F.col("_agg").cast("double")), F.lit(1.0))
    j = j.withColumn("FullAnnualVolume", F.bround(F.col("FullAnnualVolume") * ratio)).filter(F.col("FullAnnualVolume") >= 0)
    gw, sw = F.col("TakeType") == C.TAKE_GW, F.col("TakeType") == C.TAKE_SW
    rate, sd, full = F.col("AllocatedRate"), F.col("SD1"), F.col("FullAnnualVolume")
    j = j.withColumns({
        "sw_rate": F.when(gw, sd).when(sw, rate).otherwise(F.lit(0.0)),
        "gw_rate": F.when(gw, rate - sd).otherwise(F.lit(0.0)),
        "sw_vol": F.when(gw, F.try_divide(sd, rate) * full).when(sw, full.cast("double")).otherwise(F.lit(0.0)),
        "gw_vol": F.when(gw, F.try_divide(rate - sd, rate) * full).otherwise(F.lit(0.0)),
    })
    keep = ["RecordNumber", "AllocationBlock", "WAP", "FromMonth", "ToMonth"]
    rows = split_by_flags(j, keep, [
        (F.col("IncludeInSwAllocation"), C.HG_SW, {"AllocatedRate": F.col("sw_rate"), "AllocatedAnnualVolume": F.col("sw_vol")}),
        (F.col("IncludeInGwAllocation"), C.HG_GW, {"AllocatedRate": F.col("gw_rate"), "AllocatedAnnualVolume": F.col("gw_vol")}),
    ], "HydroGroup")
    fin = lambda c: F.coalesce(F.when(~F.isnan(F.col(c)), F.col(c)), F.lit(0.0))  # noqa: E731  null/NaN -> 0
    rows = rows.withColumns({"AllocatedRate": fin("AllocatedRate"), "AllocatedAnnualVolume": fin("AllocatedAnnualVolume")})
    rows = keep_any_positive(rows, ["AllocatedAnnualVolume", "AllocatedRate"])
    span = months_span("FromMonth", "ToMonth")
    vol = F.when(F.col("AllocatedAnnualVolume") == 0,
                 F.col("AllocatedRate") * 0.001 * 60 * 60 * 24 * C.DAYS_PER_MONTH * span).otherwise(F.col("AllocatedAnnualVolume"))
    rows = rows.withColumn("AllocatedAnnualVolume", vol)
    rt = F.when(F.col("AllocatedRate") == 0,
                F.col("AllocatedAnnualVolume") / 60 / 60 / 24 / C.DAYS_PER_MONTH / span * 1000).otherwise(F.col("AllocatedRate"))
    rows = rows.withColumn("AllocatedRate", rt)
    return rows.select("RecordNumber", "AllocationBlock", "HydroGroup", "WAP", "FromMonth", "ToMonth",
                       F.bround("AllocatedRate").cast("bigint").alias("AllocatedRate"),
                       F.bround("AllocatedAnnualVolume").cast("bigint").alias("AllocatedAnnualVolume"))


def clean_consented(consented: DataFrame) -> DataFrame:
    """Consented take conditions: rounding, <= 0 -> null, flag vocabulary."""
    c = consented.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        title_words(strip_ws("take_type")).alias("take_type"),
        to_bool("LowflowCondition", "takes").alias("LowflowCondition"),
        F.bround(F.col("ConsentedAnnualVolume").try_cast("double")).alias("ConsentedAnnualVolume"),
        F.bround(F.col("ConsentedMultiDayVolume").try_cast("double")).alias("ConsentedMultiDayVolume"),
        F.bround(F.col("ConsentedMultiDayPeriod").try_cast("double")).alias("ConsentedMultiDayPeriod"),
        F.col("ConsentedRate").try_cast("double").alias("ConsentedRate"))
    return nullify_nonpositive(c, ["ConsentedMultiDayVolume", "ConsentedMultiDayPeriod", "ConsentedRate", "ConsentedAnnualVolume"])


def consented_rate_volume(consented: DataFrame, months: DataFrame, permits: DataFrame) -> DataFrame:
    """Consented rate and volumes divided by the permit's number of sites
    for that take type (volumes half-even to int, rate to 2 digits)."""
    c = clean_consented(consented).filter(F.col("ConsentedRate").isNotNull())
    c = keep_existing(c, permits, "RecordNumber")
    # a permit's conditions, few as its take types, come as a list: months meet them by permit and stay dealt by it
    values = ["ConsentedRate", "ConsentedMultiDayVolume", "ConsentedMultiDayPeriod", "ConsentedAnnualVolume"]
    listed = c.groupBy("RecordNumber").agg(F.collect_list(F.struct("take_type", *values)).alias("_conditions"))
    own = F.filter("_conditions", lambda v: v["take_type"] == F.col("take_type"))
    j = months.join(listed, "RecordNumber").withColumn("_own", F.explode(own)).select(*months.columns, *[F.col("_own")[v].alias(v) for v in values])
    n = F.col("wap_count")
    return j.select("RecordNumber", "take_type", "WAP",
                    F.bround(F.col("ConsentedRate") / n, 2).alias("ConsentedRate"),
                    F.bround(F.col("ConsentedMultiDayVolume") / n).alias("ConsentedMultiDayVolume"),
                    "ConsentedMultiDayPeriod",
                    F.bround(F.col("ConsentedAnnualVolume") / n).alias("ConsentedAnnualVolume"),
                    "FromMonth", "ToMonth")


def diverts(divert: DataFrame, permits: DataFrame, sites: DataFrame) -> DataFrame:
    """Per-site diverts, months 1-12, dropped when neither rate nor
    multi-day volume is given; one row per (permit, site), first by divert type."""
    d = divert.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        title_words(strip_ws("DivertType")).alias("DivertType"),
        to_bool("LowflowCondition", "diverts").alias("LowflowCondition"),
        F.bround(F.col("ConsentedMultiDayVolume").try_cast("double")).alias("ConsentedMultiDayVolume"),
        F.bround(F.col("ConsentedMultiDayPeriod").try_cast("double")).alias("ConsentedMultiDayPeriod"),
        F.bround(F.col("ConsentedRate").try_cast("double"), 2).alias("ConsentedRate"),
        validate_code(F.upper(strip_ws("WAP"))).alias("WAP"))
    d = nullify_nonpositive(d, ["ConsentedMultiDayVolume", "ConsentedMultiDayPeriod", "ConsentedRate"])
    d = d.filter(F.col("WAP").isNotNull())
    d = keep_existing(d, permits, "RecordNumber")
    d = first_by(d, ["RecordNumber", "WAP"], [("DivertType", "asc")])
    d = keep_existing(d, sites, "WAP", ref_on="ExtSiteID")
    d = drop_all_null(d, ["ConsentedRate", "ConsentedMultiDayVolume"])
    return d.drop("LowflowCondition").withColumns({"FromMonth": F.lit(1), "ToMonth": F.lit(12)})


def water_use(use: DataFrame, months: DataFrame, permits: DataFrame, sites: DataFrame,
              code_map: dict, priorities: list) -> DataFrame:
    """Use rows mapped to their take type, split over the take's sites,
    codes rolled up to classes (unknown code fails), one use per (permit, use
    type, site) by class priority."""
    u = use.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        fix_spacing(title_words(strip_ws("UseType")), 3).alias("UseType"),
        "WaterUse", "IrrigationArea",
        F.bround(F.col("ConsentedRate").try_cast("double"), 2).alias("ConsentedRate"))
    u = nullify_nonpositive(u, ["ConsentedRate"])
    u = keep_existing(u, permits, "RecordNumber")
    u = u.withColumn("take_type", replace_word("UseType", "Use", "Take"))
    # the sites are held against the register before each meets its permit's uses: their codes on their own, as for take rows
    known = months.select("RecordNumber", "take_type", "WAP", "wap_count").filter(F.col("WAP").isNotNull())
    unknown = materialize(missing_from(known.select("WAP").distinct(), sites, "WAP", ref_on="ExtSiteID"), "unknown-sites")
    known = missing_from(known, unknown, "WAP")
    # a permit's sites come as a list: uses and sites meet by permit, and the pairs, far more than either, are never dealt
    listed = known.repartition("RecordNumber").groupBy("RecordNumber").agg(F.collect_list(F.struct("take_type", "WAP", "wap_count")).alias("_sites"))
    own = F.filter("_sites", lambda s: s["take_type"] == F.col("take_type"))
    u = u.join(listed, "RecordNumber").withColumn("_site", F.explode(own))
    u = u.select("RecordNumber", "UseType", "WaterUse", "IrrigationArea", F.bround(F.col("ConsentedRate") / F.col("_site.wap_count"), 2).alias("ConsentedRate"), F.col("_site.WAP").alias("WAP"))
    u = rollup_codes(u, "WaterUse", code_map, strict=True)
    return first_by_priority(u, ["RecordNumber", "UseType", "WAP"], "WaterUse", priorities, tie=[("IrrigationArea", "asc")])


def consented_attributes(uses: DataFrame, attributes=("WaterUse", "IrrigationArea")) -> DataFrame:
    """Attribute columns of the use rows as EAV rows (nulls dropped)."""
    cols = [c for c in attributes if c in uses.columns]
    u = uses.select("RecordNumber", "UseType", "WAP", *[F.col(c).cast("string").alias(c) for c in cols])
    return to_long(u, ["RecordNumber", "UseType", "WAP"], cols, "Attribute", "Value")


def linked_permits(links: DataFrame, months: DataFrame, permits: DataFrame) -> DataFrame:
    """Linked pairs expanded to sites on both sides; the combined volume
    is divided by the site count of the first permit over all its take types.
    Output size is the table's definition: for each pair |sites A| x |sites B|."""
    l = links.select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                     F.upper(strip_ws("OtherRecordNumber")).alias("OtherRecordNumber"),
                     strip_ws("Relationship").alias("Relationship"),
                     F.bround(F.col("CombinedAnnualVolume").try_cast("double")).alias("CombinedAnnualVolume"))
    l = keep_existing(l, permits, "RecordNumber")
    l = keep_existing(l, permits.select(F.col("RecordNumber").alias("OtherRecordNumber")), "OtherRecordNumber")
    l = first_by(l, ["RecordNumber", "OtherRecordNumber"], [("Relationship", "asc")])
    l = l.filter(F.col("Relationship").isNotNull())
    bridge = months.select("RecordNumber", "take_type", "WAP")
    bridge = bridge.withColumn("wap_count", F.when(F.col("RecordNumber").isNotNull(), F.count("WAP").over(Window.partitionBy("RecordNumber"))))
    pairs = expand_pairs(l, bridge.select("RecordNumber", "take_type", "WAP", "wap_count"),
                         "RecordNumber", "OtherRecordNumber", "RecordNumber", ["take_type", "WAP", "wap_count"])
    return pairs.select("RecordNumber", "take_type", "WAP", "OtherRecordNumber", F.col("Othertake_type").alias("OtherTakeType"),
                        F.col("OtherWAP"), "Relationship",
                        (F.col("CombinedAnnualVolume") / F.col("wap_count")).alias("CombinedAnnualVolume"))


def lowflow_conditions(triggers: DataFrame, allocations: DataFrame, default_block: str = str(C.DEFAULT_LOWFLOW_BLOCK_ID)) -> DataFrame:
    """Best trigger band per (permit, site) (active first, then lowest
    minimum allocation, then band), joined to the permit's SW blocks; permits
    with allocations but no SW block get ``default_block``."""
    # a permit's bands and its blocks (a row a permit, with the list of its blocks) are dealt by permit
    trig = first_by(triggers.repartition("RecordNumber"), ["RecordNumber", "ExtSiteID"],
                    [("IsActive", "desc"), ("MinAllocation", "asc"), ("BandNumber", "asc")]).drop("IsActive")
    blocks = sw_blocks(allocations).select("RecordNumber", F.explode(
        F.when(F.size("_sw") > 0, F.col("_sw")).otherwise(F.array(F.lit(default_block)))).alias("AllocationBlock"))
    return blocks.join(trig, "RecordNumber").select("RecordNumber", "AllocationBlock", "ExtSiteID", "BandNumber",
                                                    "MinAllocation", "MaxAllocation")


def sw_blocks(allocations: DataFrame) -> DataFrame:
    """(RecordNumber, _sw): each permit with allocations, and the distinct blocks of its SW ones (null and 'In Waitaki' left out)."""
    sw = F.when((F.col("HydroGroup") == C.HG_SW) & (F.col("AllocationBlock") != "In Waitaki"), F.col("AllocationBlock"))
    return allocations.select("RecordNumber", sw.alias("_b")).groupBy("RecordNumber").agg(F.collect_set("_b").alias("_sw"))


def lowflow_register_rows(triggers: DataFrame, allocations: DataFrame, blocks: DataFrame, sites: DataFrame,
                          default_block_id: int = C.DEFAULT_LOWFLOW_BLOCK_ID, existing: DataFrame | None = None) -> DataFrame:
    """What ``lowflow_by_register`` makes its tables of, written once: (RecordNumber, AlloBlockID, SiteID, ExtSiteID, _rows,
    CrcAlloSiteID), a row for each allocation site with the list of its conditions (several only where the register has a site twice)."""
    trig = first_by(triggers.repartition("RecordNumber"), ["RecordNumber", "ExtSiteID"], [("IsActive", "desc"), ("MinAllocation", "asc"), ("BandNumber", "asc")]).drop("IsActive")
    trig = trig.join(sites.select("ExtSiteID", "SiteID", "SiteType"), "ExtSiteID")
    ids = blocks.filter(F.col("HydroGroup") == C.HG_SW).select("AllocationBlock", F.col("AlloBlockID").cast("bigint").alias("AlloBlockID"))
    on = sw_blocks(allocations).select("RecordNumber", F.explode_outer("_sw").alias("AllocationBlock")).join(ids, "AllocationBlock", "left")
    on = on.groupBy("RecordNumber").agg(F.collect_set("AlloBlockID").alias("_ids"))
    default = F.array(F.lit(default_block_id).cast("bigint"))
    on = on.select("RecordNumber", F.explode(F.when(F.size("_ids") > 0, F.col("_ids")).otherwise(default)).alias("AlloBlockID"))
    key = ["RecordNumber", "AlloBlockID", "SiteID"]
    rows = on.join(trig, "RecordNumber").groupBy(*key).agg(
        F.max("ExtSiteID").alias("ExtSiteID"), F.collect_list(F.struct("SiteType", "BandNumber", "MinAllocation", "MaxAllocation")).alias("_rows"))
    return assign_ids_once(materialize(rows, "lowflow-rows"), key, existing, id_col="CrcAlloSiteID")


_BAND = ("BandNumber", "MinAllocation", "MaxAllocation")


def lowflow_by_register(triggers: DataFrame, allocations: DataFrame, blocks: DataFrame, sites: DataFrame,
                        default_block_id: int = C.DEFAULT_LOWFLOW_BLOCK_ID, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """D19 by ids: (allocation sites, conditions).

    Allocation sites (CrcAlloSiteID, RecordNumber, AlloBlockID, SiteID, SiteType, SiteAllo): the best trigger band per
    (permit, site) whose site the register ``sites`` (SiteID, ExtSiteID, SiteType) has, on the permit's SW blocks of
    ``blocks`` (AlloBlockID, AllocationBlock, HydroGroup); permits with allocations but none of these get
    ``default_block_id``. Ids of ``existing`` stay. Conditions: (CrcAlloSiteID, BandNumber, MinAllocation, MaxAllocation).
    """
    rows = lowflow_register_rows(triggers, allocations, blocks, sites, default_block_id, existing)
    both = lowflow_with_sites(rows)
    conditions = rows.select("CrcAlloSiteID", F.explode(_of_each("_rows")).alias("_c")).select("CrcAlloSiteID", *[f"_c.{c}" for c in _BAND])
    return rows.select(*both.columns[1:4], F.explode("_rows.SiteType").alias("SiteType"), F.lit(False).alias("SiteAllo"), "CrcAlloSiteID"), conditions


def _of_each(rows: str):
    """A list's rows, once for each of them: as rows of one id meet its allocation sites."""
    return F.when(F.size(rows) == 1, F.col(rows)).otherwise(F.flatten(F.array_repeat(F.col(rows), F.size(rows))))


def lowflow_with_sites(rows: DataFrame) -> DataFrame:
    """The allocation sites of ``lowflow_register_rows`` joined to their conditions by id, and each site's code: both lie in its rows."""
    site = ["CrcAlloSiteID", "RecordNumber", "AlloBlockID", "SiteID"]
    out = rows.select(*site, F.explode("_rows.SiteType").alias("SiteType"), F.lit(False).alias("SiteAllo"), "ExtSiteID", _of_each("_rows").alias("_rows"))
    return out.withColumn("_c", F.explode("_rows")).select(*site, "SiteType", "SiteAllo", *[f"_c.{c}" for c in _BAND], "ExtSiteID")


def run_v1(t):
    """v1 stages over a ``Tables`` catalog (built lazily, see ``Stages``);
    stages read by several consumers are written once when first needed."""
    from ..operators.hierarchy import clean_edges
    from ..session import materialize
    from .common import Stages
    key = ("v1",)
    if key not in t._cache:
        t._cache[key] = Stages({
            "permits": lambda s: materialize(clean_permits(t["b_permit"]), "permits"),
            "sites": lambda s: clean_sites(t["b_site"]),
            "edges": lambda s: clean_edges(t["b_parent_child"], s["permits"]),
            "filled": lambda s: filled_rows(t["b_wap_allo"], s["permits"], s["sites"], s["edges"]),
            "seasons": lambda s: season_means(s["filled"]),
            "months": lambda s: materialize(site_months(s["filled"]), "site-months"),
            "volumes": lambda s: clean_allocated_volume(t["b_allocated_volume"]),
            "arv": lambda s: materialize(allocated_rate_volume(s["seasons"], s["volumes"]), "allocated-rate-volume"),
        })
    return t._cache[key]
