"""Join, aggregation, window, set and reshape queries (J*, A*, W*, U*, R*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from . import register
from . import sqlparts as S
from .q_core import USE_CODES, USE_PRIORITIES, _use_case_sql
from .. import config as C
from ..functions.text import strip_ws, title_words
from ..operators import aggregate as A
from ..operators import dedup as W
from ..operators import joins as J
from ..operators import reshape as R
from ..operators.clean import recode, rollup_codes
from ..plans import limits as L
from ..plans.common import clean_permits, clean_wap_allo
from ..plans.v2 import clean_allocated_volume, clean_consented_flags

WA_ONLY = "wa_clean AS (" + S.WAP_CLEAN.split("wa_clean AS (", 1)[1].split("take_rows AS (")[0].rstrip().rstrip(",")
LOWFLOW = S.V2_INPUTS.split("lowflow AS (", 1)[1].split("inp0 AS (")[0].rstrip().rstrip(",")
LOWFLOW = "lowflow AS (" + LOWFLOW
VOLS = S.v2_volumes().split("av0 AS (", 1)[1].split("ar AS (")[0].rstrip().rstrip(",")
VOLS = "av0 AS (" + VOLS


def _wa(t):
    return clean_wap_allo(t["b_wap_allo"])


# ---------------------------------------------------------------- joins

@register("join_inner", uses=("b_wap_allo", "b_site"), sql=WA_ONLY + """
--
SELECT w.RecordNumber, w.WAP, s.GwSpatialUnitId, s.SD1_150Day FROM wa_clean w JOIN b_site s ON s.ExtSiteID = w.WAP""")
def join_inner(t):
    """Take rows joined to the site register (differently named keys)."""
    j = J.lookup(_wa(t).select("RecordNumber", "WAP"), t["b_site"].select("ExtSiteID", "GwSpatialUnitId", "SD1_150Day"),
                 left_on="WAP", right_on="ExtSiteID")
    return j.select("RecordNumber", "WAP", "GwSpatialUnitId", "SD1_150Day")


@register("join_composite", uses=("b_wap_allo", "b_consented"), sql=WA_ONLY + "," + LOWFLOW + """
--
SELECT w.RecordNumber, w.take_type, w.WAP, l.LowflowCondition FROM wa_clean w
JOIN lowflow l ON l.RecordNumber = w.RecordNumber AND l.TakeType = w.take_type""")
def join_composite(t):
    """Composite-key join (permit, take type)."""
    lf = clean_consented_flags(t["b_consented"]).withColumnRenamed("TakeType", "take_type")
    return J.lookup(_wa(t).select("RecordNumber", "take_type", "WAP"), lf, ["RecordNumber", "take_type"])


@register("join_left_fill", uses=("b_wap_allo", "b_site"), sql=WA_ONLY + """
--
SELECT w.WAP, coalesce(s.SD1_7Day, 0) AS SD1_7Day, coalesce(s.Storativity, false) AS Storativity
FROM (SELECT DISTINCT WAP FROM wa_clean WHERE WAP IS NOT NULL) w LEFT JOIN b_site s ON s.ExtSiteID = w.WAP""")
def join_left_fill(t):
    """Left join with defaults for unmatched sites."""
    waps = _wa(t).filter(F.col("WAP").isNotNull()).select("WAP").distinct()
    sites = t["b_site"].select(F.col("ExtSiteID").alias("WAP"), "SD1_7Day", "Storativity")
    return J.lookup_fill(waps, sites, "WAP", {"SD1_7Day": 0, "Storativity": False})


FULL_SQL = WA_ONLY + "," + VOLS + """,
rsum AS (SELECT RecordNumber, take_type AS TakeType, count(*) AS n_rates, CAST(sum(CAST(AllocatedRate AS DECIMAL(18, 2))) AS DOUBLE) AS rate_sum
  FROM wa_clean GROUP BY RecordNumber, take_type),
vsum AS (SELECT RecordNumber, TakeType, sum(FullAnnualVolume) AS FullAnnualVolume FROM volumes GROUP BY RecordNumber, TakeType)"""


def _rsum_vsum(t):
    r = _wa(t).groupBy("RecordNumber", F.col("take_type").alias("TakeType")).agg(
        F.count("*").alias("n_rates"), F.sum(F.col("AllocatedRate").cast(DecimalType(18, 2))).cast("double").alias("rate_sum"))
    v = clean_allocated_volume(t["b_allocated_volume"]).groupBy("RecordNumber", "TakeType").agg(
        F.sum("FullAnnualVolume").alias("FullAnnualVolume"))
    return r, v


@register("join_full", uses=("b_wap_allo", "b_allocated_volume"), sql=FULL_SQL + """
--
SELECT coalesce(r.RecordNumber, v.RecordNumber) AS RecordNumber, coalesce(r.TakeType, v.TakeType) AS TakeType, r.n_rates, r.rate_sum, v.FullAnnualVolume
FROM rsum r FULL JOIN vsum v ON v.RecordNumber = r.RecordNumber AND v.TakeType = r.TakeType""")
def join_full(t):
    """Full outer alignment of rates and volumes."""
    r, v = _rsum_vsum(t)
    return J.align_full(r, v, ["RecordNumber", "TakeType"])


@register("join_indicator", uses=("b_wap_allo", "b_allocated_volume"), sql=FULL_SQL + """
--
SELECT coalesce(r.RecordNumber, v.RecordNumber) AS RecordNumber, coalesce(r.TakeType, v.TakeType) AS TakeType, r.n_rates, v.FullAnnualVolume,
  CASE WHEN r.RecordNumber IS NOT NULL AND v.RecordNumber IS NOT NULL THEN 'both' WHEN r.RecordNumber IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM rsum r FULL JOIN vsum v ON v.RecordNumber = r.RecordNumber AND v.TakeType = r.TakeType""")
def join_indicator(t):
    """Full outer join with a match indicator."""
    r, v = _rsum_vsum(t)
    return J.join_with_indicator(r.drop("rate_sum"), v, ["RecordNumber", "TakeType"])


BLOCKS_SQL = f"""
blocks AS (SELECT CASE {S.strip('sw_allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('sw_allo_block')} END AS AllocationBlock FROM b_wap_allo
  UNION SELECT CASE {S.strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('allo_block')} END FROM b_allocated_volume)"""


def _blocks(t):
    a = t["b_wap_allo"].select(recode(strip_ws("sw_allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    b = t["b_allocated_volume"].select(recode(strip_ws("allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    return R.union_values(a, b)


@register("union_distinct", uses=("b_wap_allo", "b_allocated_volume"), sql=BLOCKS_SQL + """
--
SELECT AllocationBlock FROM blocks""")
def union_distinct(t):
    """Union of the block value sets."""
    return _blocks(t)


@register("cross_dimensions", uses=("b_wap_allo", "b_allocated_volume"), sql=BLOCKS_SQL + """
--
SELECT AllocationBlock, HydroGroup FROM blocks, (VALUES ('Surface Water'), ('Groundwater')) h(HydroGroup)""")
def cross_dimensions(t):
    """Every block with every configured hydro group (explode of a config list)."""
    return J.cross_dims(_blocks(t), "HydroGroup", C.HYDRO_GROUPS)


@register("join_semi", uses=("b_permit", "b_wap_allo"), sql=S.PERMITS + "," + WA_ONLY + """
--
SELECT RecordNumber, WAP FROM wa_clean WHERE RecordNumber IN (SELECT RecordNumber FROM permits)""")
def join_semi(t):
    """FK check as a semi join."""
    return J.keep_existing(_wa(t).select("RecordNumber", "WAP"), clean_permits(t["b_permit"]), "RecordNumber")


@register("join_anti", uses=("b_wap_allo", "b_register"), sql=WA_ONLY + """
--
SELECT DISTINCT WAP FROM wa_clean WHERE WAP IS NOT NULL AND WAP NOT IN (SELECT ExtSiteID FROM b_register)""")
def join_anti(t):
    """Site codes missing from the register."""
    waps = _wa(t).filter(F.col("WAP").isNotNull()).select("WAP").distinct()
    return J.missing_from(waps, t["b_register"], "WAP", ref_on="ExtSiteID")


@register("set_difference", uses=("b_wap_allo", "b_consented"), sql=WA_ONLY + "," + LOWFLOW + """
--
SELECT DISTINCT RecordNumber, take_type FROM wa_clean w
WHERE NOT EXISTS (SELECT 1 FROM lowflow l WHERE l.RecordNumber = w.RecordNumber AND l.TakeType = w.take_type AND l.LowflowCondition)""")
def set_difference(t):
    """(permit, take type) pairs without a low-flow condition."""
    a = _wa(t).select("RecordNumber", "take_type").distinct()
    b = clean_consented_flags(t["b_consented"]).filter("LowflowCondition").select(
        "RecordNumber", F.col("TakeType").alias("take_type"))
    return R.difference(a, b, ["RecordNumber", "take_type"])


@register("union_by_name", uses=("b_wap_allo", "b_consented", "b_allocated_volume"), sql=VOLS + f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('take_type')} AS TakeType, CAST(ConsentedRate AS DOUBLE) AS ConsentedRate, CAST(NULL AS BIGINT) AS FullAnnualVolume FROM b_consented
UNION ALL SELECT RecordNumber, TakeType, NULL, FullAnnualVolume FROM volumes""")
def union_by_name(t):
    """Row concatenation with differing columns."""
    a = t["b_consented"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                                title_words(strip_ws("take_type")).alias("TakeType"),
                                F.col("ConsentedRate").cast("double").alias("ConsentedRate"))
    b = clean_allocated_volume(t["b_allocated_volume"]).select("RecordNumber", "TakeType", "FullAnnualVolume")
    return R.union_all([a, b])


@register("star_join", uses=("b_permit", "b_wap_allo", "b_site", "b_consented"), sql=S.PERMITS + "," + WA_ONLY + "," + LOWFLOW + """
--
SELECT w.RecordNumber, w.take_type, w.AllocationBlock, w.WAP, p.ConsentStatus, s.GwSpatialUnitId, l.LowflowCondition
FROM (SELECT DISTINCT RecordNumber, take_type, AllocationBlock, WAP FROM wa_clean) w
JOIN permits p ON p.RecordNumber = w.RecordNumber
JOIN b_site s ON s.ExtSiteID = w.WAP
JOIN lowflow l ON l.RecordNumber = w.RecordNumber AND l.TakeType = w.take_type""")
def star_join(t):
    """Chain of dimension lookups."""
    fact = _wa(t).select("RecordNumber", "take_type", "AllocationBlock", "WAP").distinct()
    permits = clean_permits(t["b_permit"]).select("RecordNumber", "ConsentStatus")
    sites = t["b_site"].select(F.col("ExtSiteID").alias("WAP"), "GwSpatialUnitId")
    lf = clean_consented_flags(t["b_consented"]).withColumnRenamed("TakeType", "take_type")
    return J.star_lookup(fact, [(permits, "RecordNumber", None), (sites, "WAP", None),
                                (lf, ["RecordNumber", "take_type"], None)])


# ---------------------------------------------------------------- aggregation

@register("group_multi_agg", uses=("b_wap_allo",), sql=WA_ONLY + f"""
--
SELECT RecordNumber, take_type, {S.mean2('AllocatedRate')} AS AllocatedRate, {S.mean2('SD1')} AS SD1,
  min(FromMonth) AS FromMonth, max(ToMonth) AS ToMonth FROM wa_clean GROUP BY RecordNumber, take_type""")
def group_multi_agg(t):
    """A1: rounded means with month range in one aggregate."""
    return A.season_stats(_wa(t), ["RecordNumber", "take_type"], ["AllocatedRate", "SD1"], month=("FromMonth", "ToMonth"))


@register("group_first_non_null", uses=("b_wap_allo",), sql=WA_ONLY + f"""
--
SELECT RecordNumber, {S.mean2('AllocatedRate')} AS AllocatedRate, min(FromMonth) AS FromMonth, max(ToMonth) AS ToMonth,
  (array_agg(WAP ORDER BY FromMonth, ToMonth, SD1, WAP) FILTER (WHERE WAP IS NOT NULL))[1] AS WAP FROM wa_clean GROUP BY RecordNumber""")
def group_first_non_null(t):
    """A1: the first site that is not null, in a stated order, beside means and month range."""
    wa = _wa(t).withColumn("_at", F.struct("FromMonth", "ToMonth", "SD1", "WAP"))
    return A.season_stats(wa, "RecordNumber", ["AllocatedRate"], month=("FromMonth", "ToMonth"), firsts=["WAP"], ordinal="_at")


@register("group_sum", uses=("b_allocated_volume",), sql=VOLS + """
--
SELECT TakeType, AllocationBlock, coalesce(sum(FullAnnualVolume), 0) AS FullAnnualVolume FROM volumes
WHERE TakeType IS NOT NULL AND AllocationBlock IS NOT NULL GROUP BY TakeType, AllocationBlock""")
def group_sum(t):
    """A2: group sum (all-null -> 0)."""
    return A.group_sum(clean_allocated_volume(t["b_allocated_volume"]), ["TakeType", "AllocationBlock"], "FullAnnualVolume")


@register("group_min", uses=("b_site_log",), sql="""
--
SELECT ExtSiteID, RestrDate, min(Allocation) AS Allocation, min(Measurement) AS Measurement FROM b_site_log
WHERE ExtSiteID IS NOT NULL AND RestrDate IS NOT NULL GROUP BY ExtSiteID, RestrDate""")
def group_min(t):
    """A3: group min of the remaining columns."""
    return A.group_min(t["b_site_log"].select("ExtSiteID", "RestrDate", "Allocation", "Measurement"), ["ExtSiteID", "RestrDate"])


@register("window_count", uses=("b_wap_allo",), sql=WA_ONLY + """,
d AS (SELECT DISTINCT RecordNumber, take_type, WAP FROM wa_clean WHERE WAP IS NOT NULL)
--
SELECT RecordNumber, take_type, WAP, count(WAP) OVER (PARTITION BY RecordNumber, take_type) AS wap_count FROM d""")
def window_count(t):
    """A4: count per group attached to every row."""
    d = _wa(t).filter(F.col("WAP").isNotNull()).select("RecordNumber", "take_type", "WAP").distinct()
    return A.with_group_count(d, ["RecordNumber", "take_type"], "WAP", "wap_count")


@register("window_sum_share", uses=("b_allocated_volume",), sql=VOLS + """
--
SELECT RecordNumber, TakeType, AllocationBlock, FullAnnualVolume,
  sum(FullAnnualVolume) OVER (PARTITION BY RecordNumber) AS total,
  coalesce(FullAnnualVolume / nullif(sum(FullAnnualVolume) OVER (PARTITION BY RecordNumber), 0), 1.0) AS share FROM volumes""")
def window_sum_share(t):
    """A5 + X9: group total attached to rows and the share of each row."""
    v = clean_allocated_volume(t["b_allocated_volume"]).select("RecordNumber", "TakeType", "AllocationBlock", "FullAnnualVolume")
    v = A.with_group_sum(v, "RecordNumber", "FullAnnualVolume", "total")
    from ..functions.measures import share
    return v.withColumn("share", share(F.col("FullAnnualVolume").cast("double"), F.col("total").cast("double"), 1.0))


@register("string_agg", uses=("b_site",), sql="""
--
SELECT GwSpatialUnitId, count(*) AS unit_count, CASE WHEN count(*) > 1 THEN string_agg(SwSpatialUnitId, ', ' ORDER BY SwSpatialUnitId) ELSE '' END AS joint
FROM (SELECT DISTINCT GwSpatialUnitId, SwSpatialUnitId FROM b_site) GROUP BY GwSpatialUnitId""")
def string_agg(t):
    """Sorted member list per group when it has more than one member."""
    return A.joint_label(t["b_site"], "GwSpatialUnitId", "SwSpatialUnitId", ", ", out="joint")


@register("exists_flag", uses=("b_trigger", "b_site_log"), sql="""
--
SELECT s.ExtSiteID, coalesce(m.has, false) AS HasMeasurement FROM (SELECT DISTINCT ExtSiteID FROM b_trigger) s
LEFT JOIN (SELECT ExtSiteID, true AS has FROM b_site_log WHERE Measurement IS NOT NULL GROUP BY ExtSiteID) m ON m.ExtSiteID = s.ExtSiteID""")
def exists_flag(t):
    """Mean of measurements per site -> existence flag."""
    sites = t["b_trigger"].select("ExtSiteID").distinct()
    return A.with_exists(sites, t["b_site_log"], "ExtSiteID", "Measurement", "HasMeasurement")


@register("distinct_values", uses=("b_wap_allo",), sql=WA_ONLY + """
--
SELECT DISTINCT WAP FROM wa_clean WHERE WAP IS NOT NULL""")
def distinct_values(t):
    """Distinct non-null site codes."""
    return A.distinct_values(_wa(t), "WAP")


# ---------------------------------------------------------------- dedup

@register("dedup_ordered", uses=("b_trigger",), sql="""
--
SELECT RecordNumber, ExtSiteID, BandNumber, MinAllocation, MaxAllocation, IsActive FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber, ExtSiteID ORDER BY IsActive DESC NULLS LAST, MinAllocation NULLS LAST,
    BandNumber NULLS LAST, MaxAllocation NULLS FIRST) AS rn FROM b_trigger) WHERE rn = 1""")
def dedup_ordered(t):
    """First per key under a mixed ASC/DESC order."""
    return W.first_by(t["b_trigger"], ["RecordNumber", "ExtSiteID"],
                      [("IsActive", "desc"), ("MinAllocation", "asc"), ("BandNumber", "asc")])


@register("dedup_priority", uses=("b_water_use",), sql=f"""
u AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('UseType')} AS UseType, {_use_case_sql('WaterUse')} AS WaterUse,
  IrrigationArea, ConsentedRate FROM b_water_use),
p AS (SELECT *, coalesce(list_position({USE_PRIORITIES!r}, WaterUse), {len(USE_PRIORITIES) + 1}) AS prio FROM u)
--
SELECT RecordNumber, UseType, WaterUse, IrrigationArea, ConsentedRate FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber, UseType ORDER BY prio, IrrigationArea NULLS LAST,
    WaterUse NULLS FIRST, IrrigationArea NULLS FIRST, ConsentedRate NULLS FIRST) AS rn FROM p) WHERE rn = 1""")
def dedup_priority(t):
    """One use per permit by class priority."""
    u = t["b_water_use"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                                title_words(strip_ws("UseType")).alias("UseType"), "WaterUse", "IrrigationArea", "ConsentedRate")
    u = rollup_codes(u, "WaterUse", USE_CODES)
    return W.first_by_priority(u, ["RecordNumber", "UseType"], "WaterUse", USE_PRIORITIES, tie=[("IrrigationArea", "asc")])


@register("dedup_first", uses=("b_allocated_volume",), sql=VOLS + """
--
SELECT * FROM volumes""")
def dedup_first(t):
    """One row per key under an explicit total order."""
    return clean_allocated_volume(t["b_allocated_volume"])


@register("dedup_full", uses=("b_parent_child",), sql=f"""
--
SELECT DISTINCT {S.key('ParentRecordNumber')} AS ParentRecordNumber, {S.key('ChildRecordNumber')} AS ChildRecordNumber FROM b_parent_child""")
def dedup_full(t):
    """Whole-row dedup."""
    from ..operators.clean import norm_key
    return W.dedup_full(norm_key(t["b_parent_child"], ["ParentRecordNumber", "ChildRecordNumber"]))


@register("month_ffill", uses=("b_limit",), sql="""
sw AS (SELECT * FROM b_limit WHERE HydroGroup = 'Surface Water'),""" + S.ffill("sw", "id, AllocationBlock, units", "fromMonth", "AllocationLimit", "ff") + """
--
SELECT * FROM ff WHERE AllocationLimit IS NOT NULL""")
def month_ffill(t):
    """Sum per month, densify 1..12, forward fill, leading gaps dropped."""
    sw = t["b_limit"].filter(F.col("HydroGroup") == C.HG_SW)
    return R.month_ffill(sw, ["id", "AllocationBlock", "units"], "fromMonth", "AllocationLimit")


# ---------------------------------------------------------------- reshape

@register("unpivot_stack", uses=("b_water_use",), sql=f"""
u AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {_use_case_sql('WaterUse')} AS WaterUse, IrrigationArea FROM b_water_use)
--
SELECT RecordNumber, 'WaterUse' AS Attribute, WaterUse AS Value FROM u WHERE WaterUse IS NOT NULL
UNION ALL SELECT RecordNumber, 'IrrigationArea', IrrigationArea FROM u WHERE IrrigationArea IS NOT NULL""")
def unpivot_stack(t):
    """Attribute columns -> (Attribute, Value) rows, nulls dropped."""
    u = t["b_water_use"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"), "WaterUse", "IrrigationArea")
    u = rollup_codes(u, "WaterUse", USE_CODES)
    return R.to_long(u, ["RecordNumber"], ["WaterUse", "IrrigationArea"], "Attribute", "Value")


@register("pivot_attributes", uses=("b_attribute",), sql="""
--
SELECT CrcActSiteID, min(CASE WHEN Attribute = 'WaterUse' THEN Value END) AS WaterUse,
  min(CASE WHEN Attribute = 'IrrigationArea' THEN Value END) AS IrrigationArea FROM b_attribute GROUP BY CrcActSiteID""")
def pivot_attributes(t):
    """R2: long -> wide for a fixed attribute list."""
    return R.to_wide(t["b_attribute"], "CrcActSiteID", "Attribute", "Value", ["WaterUse", "IrrigationArea"])


@register("flag_split", uses=("b_wap_allo",), sql=WA_ONLY + """
--
SELECT RecordNumber, WAP, 'Surface Water' AS HydroGroup, CASE WHEN take_type = 'Take Groundwater' THEN SD1 ELSE AllocatedRate END AS AllocatedRate
FROM wa_clean WHERE IncludeInSwAllocation
UNION ALL
SELECT RecordNumber, WAP, 'Groundwater', AllocatedRate - SD1 FROM wa_clean WHERE take_type = 'Take Groundwater'""")
def flag_split(t):
    """One row -> 0, 1 or 2 rows by flags."""
    wa = _wa(t)
    gw = F.col("take_type") == C.TAKE_GW
    return R.split_by_flags(wa, ["RecordNumber", "WAP"], [
        (F.col("IncludeInSwAllocation"), C.HG_SW, {"AllocatedRate": F.when(gw, F.col("SD1")).otherwise(F.col("AllocatedRate"))}),
        (gw, C.HG_GW, {"AllocatedRate": F.col("AllocatedRate") - F.col("SD1")}),
    ], "HydroGroup")


@register("explode_nested", uses=("b_limit",), sql="""
--
SELECT DISTINCT id, AllocationBlock, units, AllocationLimit, CAST(fromMonth AS INTEGER) AS fromMonth, 12 AS toMonth FROM b_limit""")
def explode_nested(t):
    """Management units x limits flattened (two explodes)."""
    docs = L.normalise_spatial(L.docs_from_flat(t["b_limit"]))
    return L.flatten_limits(docs).withColumnRenamed("limit", "AllocationLimit")


@register("month_explode", uses=("b_wap_allo",), sql=WA_ONLY + """
--
SELECT RecordNumber, WAP, unnest(CASE WHEN FromMonth > ToMonth THEN range(1, ToMonth + 1) ELSE range(FromMonth, ToMonth + 1) END) AS Month FROM wa_clean""")
def month_explode(t):
    """One row per month of the season (reference wrap rule)."""
    wa = _wa(t).select("RecordNumber", "WAP", "FromMonth", "ToMonth")
    return R.explode_months(wa, "FromMonth", "ToMonth").select("RecordNumber", "WAP", F.col("Month").cast("bigint").alias("Month"))
