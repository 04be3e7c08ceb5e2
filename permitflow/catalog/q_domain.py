"""Domain pipeline queries (D*, H*, T*, G*, Q*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from . import register
from .. import config as C
from ..functions.text import strip_ws, title_words
from ..operators.clean import recode
from . import sqlparts as S
from ..operators import quality as Q
from ..operators.joins import cross_dims
from ..operators.kept import keep_in_step, read_kept
from ..operators.hierarchy import clean_edges, nearest_relative_value
from ..operators.spatial import nearest_vertex as nearest_vertex_op, points_in_zones
from ..operators.sync import assign_ids
from ..plans import limits as L
from ..plans import reporting as RP
from ..plans import timeseries as TS
from ..plans import v1 as V1
from ..plans import v2
from ..plans.common import clean_permits, clean_sites, take_rows
from ..plans.legacy import clean_legacy_volumes, legacy_split, legacy_volumes
from ..session import materialize, scratch_path
from .q_core import USE_CODES, USE_PRIORITIES, _use_case_sql
from .q_relational import VOLS

AS_OF = "2020-07-01"

V2_USES = ("b_permit", "b_site", "b_parent_child", "b_wap_allo", "b_consented", "b_allocated_volume")
V2_CHAIN = ",".join([S.PERMITS_V2, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL, S.SEASONS, S.V2_INPUTS])


def _v2(t, alt=False):
    key = ("v2", alt)
    if key not in t._cache:
        t._cache[key] = v2.run_v2(t, alt=alt)
    return t._cache[key]


def limit_files(t) -> str:
    """The folder of limit documents (JSON lines), written once."""
    key = ("limit_files",)
    if key not in t._cache:
        path = scratch_path(t.spark, f"permitflow/limit-json-{uuid.uuid4().hex}")
        L.docs_to_json(L.documents(t["b_limit"], t["b_limit_head"])).write.text(path)
        t._cache[key] = path
    return t._cache[key]


def _limit_docs(t):
    """Filtered limit documents, written once: notes, flattened limits and names all read them."""
    key = ("limit_docs",)
    if key not in t._cache:
        t._cache[key] = materialize(L.filter_limits(L.read_limits(t.spark, limit_files(t)), AS_OF), "limit-docs")
    return t._cache[key]


def _gw_limits(t):
    docs = _limit_docs(t)
    return L.gw_limits(L.flatten_limits(docs), L.joint_notes(L.group_units(docs)), docs, AS_OF)


def _sw_limits(t):
    docs = _limit_docs(t)
    return L.sw_limits(L.flatten_limits(docs), L.joint_notes(L.group_units(docs)), docs, AS_OF)


@register("view_gw_summary", uses=V2_USES + ("b_limit", "b_limit_head"), recursive=True, sql=V2_CHAIN + "," + S.v2_rates()
          + "," + S.v2_volumes() + "," + S.ALLOC + "," + S.gw_zone() + "," + S.LIMITS_FLAT + """
--
SELECT l.SpatialUnitId, l.AllocationBlock, z.AllocatedVolume, z.NewAllocationInProgress, l.AllocationLimit,
  CASE WHEN l.AllocationLimit = 0 THEN 0 ELSE l.AllocationLimit - z.AllocatedVolume END AS AllocationAvailable,
  CAST(CASE WHEN l.AllocationLimit = 0 THEN 0 ELSE round(CAST(z.AllocatedVolume AS DOUBLE) / l.AllocationLimit * 100) END AS INTEGER) AS AllocatedPercentage,
  l.Units AS units, l.Notes AS notes
FROM gw_limits l JOIN gw_zone z ON z.SpatialUnitId = l.SpatialUnitId AND z.AllocationBlock = l.AllocationBlock""")
def view_gw_summary(t):
    """D15 flagship: how full is each zone's groundwater block."""
    return L.gw_allocation_summary(_gw_limits(t), _v2(t)["gw_zone"])


@register("gw_zone_allocation", uses=V2_USES, recursive=True, sql=V2_CHAIN + "," + S.v2_rates() + ","
          + S.v2_volumes() + "," + S.ALLOC + "," + S.gw_zone() + """
--
SELECT * FROM gw_zone""")
def gw_zone_allocation(t):
    """Active and in-process GW volume per zone x block."""
    return _v2(t)["gw_zone"]


@register("consented_allocation", uses=V2_USES, recursive=True, sql=V2_CHAIN + "," + S.v2_rates() + ","
          + S.v2_volumes() + "," + S.ALLOC + """
--
SELECT * FROM allocation""")
def consented_allocation(t):
    """The ConsentedAllocation table."""
    return _v2(t)["allocation"]


@register("sd_rates", uses=V2_USES, recursive=True, sql=V2_CHAIN + "," + S.v2_rates() + """
--
SELECT RecordNumber, AllocationBlock, Wap, HydroGroup, AllocatedRate FROM rates""")
def sd_rates(t):
    """D11 rates split into SW and GW per permit x block x site."""
    return v2.sd_rates(_v2(t)["inputs"])


@register("sd_category", uses=V2_USES, recursive=True, sql=V2_CHAIN + """
--
SELECT RecordNumber, AllocationBlock, Wap, TakeType, sd_cat, sw_vol_ratio, Rate150Day FROM inputs""")
def sd_category(t):
    """D11 stream-depletion category and SW volume ratio."""
    inputs = _v2(t)["inputs"]
    return inputs.select("RecordNumber", "AllocationBlock", "Wap", "TakeType", "sd_cat", "sw_vol_ratio",
                         "Rate150Day")


@register("seasonal_rates", uses=V2_USES[:4], recursive=True,
          sql=",".join([S.PERMITS, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL, S.SEASONS]) + """
--
SELECT * FROM seasons""")
def seasonal_rates(t):
    """Month-weighted seasonal means per permit x take type x block x site."""
    from ..session import materialize
    permits = materialize(clean_permits(t["b_permit"]))
    sites = clean_sites(t["b_site"])
    return v2.seasonal_rates(t["b_wap_allo"], permits, sites, clean_edges(t["b_parent_child"], permits))


@register("permits_clean", uses=("b_permit",), sql=S.PERMITS + """
--
SELECT * FROM permits""")
def permits_clean(t):
    """D3: cleaned permits."""
    return clean_permits(t["b_permit"])


@register("hierarchy_fill", uses=V2_USES[:4], recursive=True,
          sql=",".join([S.PERMITS, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL]) + """
--
SELECT seed AS RecordNumber, val AS WAP FROM h_fill""")
def hierarchy_fill(t):
    """H1: nearest-relative site for permits with a missing site."""
    permits = clean_permits(t["b_permit"])
    sites = clean_sites(t["b_site"])
    edges = clean_edges(t["b_parent_child"], permits)
    rows = take_rows(t["b_wap_allo"], permits, sites)
    return nearest_relative_value(rows, edges, "RecordNumber", "WAP")


# ======================================================================== v1


V1_USES = V2_USES
V1_CHAIN = ",".join([S.PERMITS, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL, S.SEASONS, S.MONTHS_SQL])
ARV_CHAIN = V1_CHAIN + "," + VOLS + "," + S.ARV_SQL
USES_CHAIN = V1_CHAIN + "," + S.uses_sql(_use_case_sql("WaterUse"), USE_PRIORITIES)
RUN_DATE, WINDOW_START = "2024-01-24", "2024-01-08"


def _uses(t):
    r = V1.run_v1(t)
    return V1.water_use(t["b_water_use"], r["months"], r["permits"], r["sites"], USE_CODES, USE_PRIORITIES)


def _crv(t):
    r = V1.run_v1(t)
    return V1.consented_rate_volume(t["b_consented"], r["months"], r["permits"])


def _lowflow(t):
    return V1.lowflow_conditions(t["b_trigger"], V1.run_v1(t)["arv"])


def _allocations(t):
    """What T2 takes of the site log, whose least allocation of a day stays: each of a site's allocations of a day once."""
    return t["b_site_log"].select("ExtSiteID", "RestrDate", "Allocation").distinct()


def _restr(t):
    r = V1.run_v1(t)
    cond = materialize(_lowflow(t), "lowflow-conditions")
    feed = TS.restriction_feed(_allocations(t), cond, r["permits"], RUN_DATE, WINDOW_START, listed=True)
    return TS.restriction_ts(feed, r["permits"], cond, RUN_DATE, WINDOW_START)


@register("dim_allo_block", uses=("b_wap_allo", "b_allocated_volume"), sql=f"""
blocks AS (SELECT CASE {S.strip('sw_allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('sw_allo_block')} END AS AllocationBlock FROM b_wap_allo
  UNION SELECT CASE {S.strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('allo_block')} END FROM b_allocated_volume)
--
SELECT AllocationBlock, HydroGroup, row_number() OVER (ORDER BY AllocationBlock, HydroGroup) AS AlloBlockID
FROM blocks, (VALUES ('Surface Water'), ('Groundwater')) h(HydroGroup)""")
def dim_allo_block(t):
    """AlloBlock dimension (blocks x hydro groups) with surrogate ids."""
    return V1.allo_blocks(t["b_wap_allo"], t["b_allocated_volume"])


@register("sites_missing", uses=("b_wap_allo", "b_divert", "b_register"), sql=f"""
used AS (SELECT CASE WHEN regexp_matches({S.key('WAP')}, {S.SITE_RE}) THEN {S.key('WAP')} END AS WAP FROM b_wap_allo
  UNION SELECT CASE WHEN regexp_matches({S.key('WAP')}, {S.SITE_RE}) THEN {S.key('WAP')} END FROM b_divert)
--
SELECT WAP FROM used WHERE WAP IS NOT NULL AND WAP NOT IN (SELECT ExtSiteID FROM b_register)""")
def sites_missing(t):
    """Site codes used by takes or diverts but missing from the register."""
    return V1.missing_sites(t["b_wap_allo"], t["b_divert"], t["b_register"])


@register("base_dimensions", uses=("b_wap_allo", "b_allocated_volume"), sql=f"""
bd_b AS (SELECT DISTINCT CASE b WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE b END AS b FROM (
  SELECT {S.strip('sw_allo_block')} AS b FROM b_wap_allo UNION ALL SELECT {S.strip('allo_block')} FROM b_allocated_volume)),
bd_h AS (SELECT h, row_number() OVER (ORDER BY h) AS id FROM (VALUES ('Surface Water'), ('Groundwater')) x(h)),
bd_1 AS (SELECT b.b, h.id AS h, row_number() OVER (ORDER BY b.b, h.id) AS id FROM bd_b b JOIN bd_h h ON b.b = 'B'),
bd_2 AS (SELECT b.b, h.id AS h, (SELECT count(*) FROM bd_1) + row_number() OVER (ORDER BY b.b, h.id) AS id FROM bd_b b JOIN bd_h h ON b.b <> 'B')
--
SELECT 'HydroGroup' AS dimension, h AS name, CAST(NULL AS BIGINT) AS HydroGroupID, id FROM bd_h
UNION ALL SELECT 'Activity', a, h.id, row_number() OVER (ORDER BY a, h.id) FROM (VALUES ('Take'), ('Divert'), ('Use')) x(a) JOIN bd_h h ON true
UNION ALL SELECT 'AlloBlock', b, h, id FROM bd_1 UNION ALL SELECT 'AlloBlock', b, h, id FROM bd_2
UNION ALL SELECT 'Attributes', a, NULL, row_number() OVER (ORDER BY a) FROM (VALUES ('WaterUse'), ('IrrigationArea')) x(a)""")
def base_dimensions(t):
    """The four base dimensions, kept over a first run that has seen block B only and a second that adds the others."""
    path = scratch_path(t.spark, f"kept/dimensions-{uuid.uuid4().hex}")
    blocks = V1.seen_blocks(t["b_wap_allo"], t["b_allocated_volume"])
    for seen in (blocks.filter("AllocationBlock = 'B'"), blocks):
        tables = V1.base_dimensions(t.spark, path, seen)
    none = F.lit(None).cast("bigint").alias("HydroGroupID")
    names = {"HydroGroup": ("HydroGroup", none), "Activity": ("ActivityType", "HydroGroupID"), "AlloBlock": ("AllocationBlock", "HydroGroupID"), "Attributes": ("Attribute", none)}
    parts = [tables[d].select(F.lit(d).alias("dimension"), F.col(n).alias("name"), h, F.col(tables[d].columns[-1]).alias("id")) for d, (n, h) in names.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("sites", uses=("b_wap_allo", "b_divert", "b_site"), sql=f"""
ks_t AS (SELECT DISTINCT {S.key('WAP')} AS w FROM b_wap_allo WHERE regexp_matches({S.key('WAP')}, {S.SITE_RE})),
ks_d AS (SELECT DISTINCT {S.key('WAP')} AS w FROM b_divert WHERE regexp_matches({S.key('WAP')}, {S.SITE_RE})),
ks_1 AS (SELECT s.ExtSiteID AS w, row_number() OVER (ORDER BY s.ExtSiteID) AS id FROM b_site s WHERE s.ExtSiteID IN (SELECT w FROM ks_t) AND s.SD1_7Day > 50),
ks_2 AS (SELECT s.ExtSiteID AS w, (SELECT count(*) FROM ks_1) + row_number() OVER (ORDER BY s.ExtSiteID) AS id
  FROM b_site s WHERE s.ExtSiteID IN (SELECT w FROM ks_t UNION SELECT w FROM ks_d) AND s.ExtSiteID NOT IN (SELECT w FROM ks_1))
--
SELECT k.id AS SiteID, s.ExtSiteID, s.NZTMX, s.NZTMY, s.SD1_7Day, s.SD1_150Day FROM (SELECT * FROM ks_1 UNION ALL SELECT * FROM ks_2) k JOIN b_site s ON s.ExtSiteID = k.w""")
def sites_q(t):
    """The kept sites table: a first run with a smaller register and without diverts, a second that adds what it lacks."""
    path = scratch_path(t.spark, f"kept/sites-{uuid.uuid4().hex}")
    register_ = clean_sites(t["b_site"])
    V1.keep_sites(t.spark, path, t["b_wap_allo"], t["b_divert"].limit(0), register_.filter("SD1_7Day > 50"))
    return V1.keep_sites(t.spark, path, t["b_wap_allo"], t["b_divert"], register_)


@register("clean_edges", uses=("b_permit", "b_parent_child"), sql=S.PERMITS + "," + S.EDGES + """
--
SELECT p AS ParentRecordNumber, c AS ChildRecordNumber FROM edges""")
def clean_edges_q(t):
    """H2: normalised, deduplicated edges whose both ends exist."""
    return clean_edges(t["b_parent_child"], clean_permits(t["b_permit"]))


@register("allocated_rate_volume", uses=V1_USES, recursive=True, sql=ARV_CHAIN + """
--
SELECT * FROM arv""")
def allocated_rate_volume(t):
    """v1 allocated rate and volume per permit x block x hydro group x site."""
    return V1.run_v1(t)["arv"]


@register("consented_rate_volume", uses=V1_USES, recursive=True, sql=V1_CHAIN + "," + S.CRV_SQL + """
--
SELECT * FROM crv""")
def consented_rate_volume(t):
    """Consented rate / volumes split over the permit's sites."""
    return _crv(t)


@register("diverts", uses=V1_USES + ("b_divert",), sql=S.PERMITS + "," + S.SITES + f""",
dv0 AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('DivertType')} AS DivertType,
    CASE WHEN coalesce(upper({S.strip('LowflowCondition')}), 'NO') IN ('NO', 'YES') THEN coalesce(upper({S.strip('LowflowCondition')}), 'NO') = 'YES' ELSE true END AS LowflowCondition,
    {S.bround('CAST(ConsentedMultiDayVolume AS DOUBLE)')} AS v, {S.bround('CAST(ConsentedMultiDayPeriod AS DOUBLE)')} AS p,
    {S.bround('CAST(ConsentedRate AS DOUBLE)', 2)} AS r,
    CASE WHEN regexp_matches({S.key('WAP')}, {S.SITE_RE}) THEN {S.key('WAP')} END AS WAP FROM b_divert),
dv1 AS (SELECT RecordNumber, DivertType, LowflowCondition, CASE WHEN v > 0 THEN v END AS ConsentedMultiDayVolume,
    CASE WHEN p > 0 THEN p END AS ConsentedMultiDayPeriod, CASE WHEN r > 0 THEN r END AS ConsentedRate, WAP FROM dv0
  WHERE WAP IS NOT NULL AND RecordNumber IN (SELECT RecordNumber FROM permits)),
dv2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, WAP ORDER BY DivertType NULLS LAST, DivertType NULLS FIRST,
    LowflowCondition NULLS FIRST, ConsentedMultiDayVolume NULLS FIRST, ConsentedMultiDayPeriod NULLS FIRST, ConsentedRate NULLS FIRST) AS rn FROM dv1) WHERE rn = 1)
--
SELECT RecordNumber, DivertType, ConsentedMultiDayVolume, ConsentedMultiDayPeriod, ConsentedRate, WAP, 1 AS FromMonth, 12 AS ToMonth FROM dv2
WHERE WAP IN (SELECT ExtSiteID FROM sites) AND (ConsentedRate IS NOT NULL OR ConsentedMultiDayVolume IS NOT NULL)""")
def diverts(t):
    """Per-site diverts."""
    return V1.diverts(t["b_divert"], clean_permits(t["b_permit"]), clean_sites(t["b_site"]))


@register("water_use_priority", uses=V1_USES + ("b_water_use",), recursive=True, sql=USES_CHAIN + """
--
SELECT * FROM uses""")
def water_use_priority(t):
    """One use class per permit x use type x site by priority."""
    return _uses(t)


@register("attributes_eav", uses=V1_USES + ("b_water_use",), recursive=True, sql=USES_CHAIN + """
--
SELECT RecordNumber, UseType, WAP, 'WaterUse' AS Attribute, WaterUse AS Value FROM uses WHERE WaterUse IS NOT NULL
UNION ALL SELECT RecordNumber, UseType, WAP, 'IrrigationArea', IrrigationArea FROM uses WHERE IrrigationArea IS NOT NULL""")
def attributes_eav(t):
    """Use attributes as EAV rows."""
    return V1.consented_attributes(_uses(t))


@register("linked_pairs", uses=V1_USES + ("b_linked",), recursive=True, sql=V1_CHAIN + f""",
lk0 AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.key('OtherRecordNumber')} AS OtherRecordNumber, {S.strip('Relationship')} AS Relationship,
    {S.bround('CAST(CombinedAnnualVolume AS DOUBLE)')} AS CombinedAnnualVolume FROM b_linked),
lk1 AS (SELECT * FROM lk0 WHERE RecordNumber IN (SELECT RecordNumber FROM permits) AND OtherRecordNumber IN (SELECT RecordNumber FROM permits)),
lk2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, OtherRecordNumber ORDER BY Relationship NULLS LAST,
    Relationship NULLS FIRST, CombinedAnnualVolume NULLS FIRST) AS rn FROM lk1) WHERE rn = 1 AND Relationship IS NOT NULL),
br AS (SELECT RecordNumber, take_type, WAP, count(*) OVER (PARTITION BY RecordNumber) AS wap_count FROM months)
--
SELECT l.RecordNumber, a.take_type, a.WAP, l.OtherRecordNumber, b.take_type AS OtherTakeType, b.WAP AS OtherWAP, l.Relationship,
  l.CombinedAnnualVolume / a.wap_count AS CombinedAnnualVolume
FROM lk2 l JOIN br a ON a.RecordNumber = l.RecordNumber JOIN br b ON b.RecordNumber = l.OtherRecordNumber""")
def linked_pairs(t):
    """Linked permits expanded to sites on both sides."""
    r = V1.run_v1(t)
    return V1.linked_permits(t["b_linked"], r["months"], r["permits"])


@register("lowflow_conditions", uses=V1_USES + ("b_trigger",), recursive=True, sql=ARV_CHAIN + "," + S.TRIG_SQL + """
--
SELECT * FROM lowflow_cond""")
def lowflow_conditions(t):
    """Best trigger band per permit x site on the permit's SW blocks (default block otherwise)."""
    return _lowflow(t)


LF_SITES = """
ls_ab AS (SELECT b, h, row_number() OVER (ORDER BY b, h) AS id FROM (SELECT DISTINCT AllocationBlock AS b FROM allo) JOIN (VALUES ('Groundwater'), ('Surface Water')) x(h) ON true),
ls_s AS (SELECT *, row_number() OVER (ORDER BY ExtSiteID) AS SiteID FROM b_lowflow_site),
ls_t AS (SELECT t.*, s.SiteID, s.SiteType FROM trig t JOIN ls_s s ON s.ExtSiteID = t.ExtSiteID),
ls_sw AS (SELECT DISTINCT a.RecordNumber, b.id AS AlloBlockID FROM allo a JOIN ls_ab b ON b.b = a.AllocationBlock AND b.h = a.HydroGroup
  WHERE a.HydroGroup = 'Surface Water' AND a.AllocationBlock <> 'In Waitaki'),
ls_all AS (SELECT t.*, w.AlloBlockID FROM ls_sw w JOIN ls_t t ON t.RecordNumber = w.RecordNumber
  UNION ALL SELECT t.*, 9 FROM ls_t t WHERE t.RecordNumber IN (SELECT RecordNumber FROM allo) AND t.RecordNumber NOT IN (SELECT RecordNumber FROM ls_sw))"""


def _lowflow_ids(t):
    """(blocks, allocation sites with their conditions) of D19 by ids."""
    arv = V1.run_v1(t)["arv"]
    # written, so that their sizes are known when the joins with them are planned
    blocks = materialize(assign_ids(cross_dims(arv.select("AllocationBlock").distinct(), "HydroGroup", C.HYDRO_GROUPS), ["AllocationBlock", "HydroGroup"], id_col="AlloBlockID"), "blocks")
    sites = materialize(assign_ids(t["b_lowflow_site"], "ExtSiteID", id_col="SiteID"), "lowflow-sites")
    return blocks, V1.lowflow_with_sites(V1.lowflow_register_rows(t["b_trigger"], arv, blocks, sites))


@register("lowflow_allocation_sites", uses=V1_USES + ("b_trigger", "b_lowflow_site"), recursive=True, sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + LF_SITES + """
--
SELECT row_number() OVER (ORDER BY RecordNumber, AlloBlockID, SiteID) AS CrcAlloSiteID, RecordNumber, AlloBlockID, SiteID, SiteType, false AS SiteAllo,
  BandNumber, MinAllocation, MaxAllocation FROM ls_all""")
def lowflow_allocation_sites(t):
    """D19 with ids: low-flow conditions on sites of the register, by allocation block id (default block 9), with their CrcAlloSite rows."""
    return _lowflow_ids(t)[1].drop("ExtSiteID")


ATTRS_SQL = f"""
use_attrs AS (SELECT RecordNumber, WaterUse, coalesce({S.bround('try_cast(IrrigationArea AS DOUBLE)')}, 0.0) AS IrrigationArea FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber ORDER BY UseType, WAP) AS rn FROM uses) WHERE rn = 1)"""


@register("alloc_site_summary", uses=V1_USES + ("b_water_use",), recursive=True,
          sql=USES_CHAIN + "," + VOLS + "," + S.ARV_SQL + "," + ATTRS_SQL + """
--
SELECT a.RecordNumber, p.ConsentStatus, p.FromDate, p.ToDate, a.WAP AS ExtSiteID, a.AllocationBlock, a.HydroGroup, a.AllocatedRate,
  a.AllocatedAnnualVolume, a.FromMonth, a.ToMonth, u.WaterUse, u.IrrigationArea
FROM arv a JOIN permits p ON p.RecordNumber = a.RecordNumber JOIN use_attrs u ON u.RecordNumber = a.RecordNumber""")
def alloc_site_summary(t):
    """D20 CrcAlloSiteSumm."""
    r = V1.run_v1(t)
    attrs = RP.use_attributes(V1.consented_attributes(_uses(t)))
    return RP.alloc_site_summary(r["arv"], r["permits"], attrs)


@register("act_site_summary", uses=V1_USES + ("b_water_use",), recursive=True,
          sql=USES_CHAIN + "," + S.CRV_SQL + "," + ATTRS_SQL + f""",
est0 AS (SELECT * REPLACE (coalesce(ConsentedRate, {S.bround('ConsentedAnnualVolume / 12 / 30.42 / 24 / 60 / 60 * 1000')}, 0.0) AS ConsentedRate)
  FROM crv WHERE ConsentedRate IS NOT NULL OR ConsentedMultiDayVolume IS NULL),
est1 AS (SELECT * REPLACE (CASE WHEN ConsentedMultiDayVolume IS NULL THEN 1.0 ELSE ConsentedMultiDayPeriod END AS ConsentedMultiDayPeriod,
    coalesce(ConsentedMultiDayVolume, {S.bround('ConsentedRate * 60 * 60 * 24 * 0.001')}) AS ConsentedMultiDayVolume) FROM est0),
est AS (SELECT * REPLACE (CAST(ConsentedMultiDayVolume AS BIGINT) AS ConsentedMultiDayVolume,
    CAST(coalesce(ConsentedAnnualVolume, {S.bround('ConsentedRate * 60 * 60 * 24 * 365 * 0.001')}) AS BIGINT) AS ConsentedAnnualVolume) FROM est1)
--
SELECT e.RecordNumber, p.ConsentStatus, p.FromDate, p.ToDate, e.WAP AS ExtSiteID, split_part(e.take_type, ' ', 1) AS Activity,
  substr(e.take_type, instr(e.take_type, ' ') + 1) AS HydroGroup, e.ConsentedRate, e.ConsentedMultiDayVolume, e.ConsentedMultiDayPeriod,
  e.ConsentedAnnualVolume, e.FromMonth, e.ToMonth, u.WaterUse, u.IrrigationArea
FROM est e JOIN permits p ON p.RecordNumber = e.RecordNumber JOIN use_attrs u ON u.RecordNumber = e.RecordNumber""")
def act_site_summary(t):
    """D20 CrcActSiteSumm with estimates for missing quantities."""
    r = V1.run_v1(t)
    attrs = RP.use_attributes(V1.consented_attributes(_uses(t)))
    return RP.act_site_summary(_crv(t), r["permits"], attrs)


LOWFLOW_RUNS = ("2024-01-08 00:00:00", "2024-01-24 00:00:00")


@register("lowflow_summary", uses=V1_USES + ("b_trigger",), recursive=True, sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + (
    S.TRIG_SQL.replace("FROM b_trigger)", "FROM b_trigger WHERE BandNumber > 1)").replace("trig AS", "trig0 AS").replace("JOIN trig t", "JOIN trig0 t")
    .replace("allo AS", "allo0 AS").replace("swb AS", "swb0 AS").replace("lowflow_cond AS", "cond0 AS").replace("'9'", "'8'")) + f"""
--
SELECT c.*, CAST(CASE WHEN o.RecordNumber IS NULL THEN TIMESTAMP '{LOWFLOW_RUNS[1]}' ELSE TIMESTAMP '{LOWFLOW_RUNS[0]}' END AS VARCHAR) AS ModifiedDate
FROM lowflow_cond c LEFT JOIN cond0 o ON o.RecordNumber = c.RecordNumber AND o.AllocationBlock = c.AllocationBlock AND o.ExtSiteID = c.ExtSiteID
  AND o.BandNumber IS NOT DISTINCT FROM c.BandNumber AND o.MinAllocation IS NOT DISTINCT FROM c.MinAllocation
  AND o.MaxAllocation IS NOT DISTINCT FROM c.MaxAllocation""")
def lowflow_summary(t):
    """The low-flow summary, stored by a first run (without the first bands, other default block) and kept in step by a second."""
    arv = V1.run_v1(t)["arv"]
    path = scratch_path(t.spark, f"kept/lowflow-{uuid.uuid4().hex}")
    sites = None
    for run, (triggers, block) in zip(LOWFLOW_RUNS, ((t["b_trigger"].filter("BandNumber > 1"), "8"), (t["b_trigger"], str(C.DEFAULT_LOWFLOW_BLOCK_ID)))):
        own, by_id = RP.lowflow_by_id(V1.lowflow_conditions(triggers, arv, block), sites)
        keep_in_step(t.spark, path, RP.lowflow_summary(own, by_id), ["RecordNumber", "AllocationBlock", "ExtSiteID"], run)
        sites = own
    return read_kept(t.spark, path).withColumn("ModifiedDate", F.col("ModifiedDate").cast("string"))


# ======================================================================== v2 views

SW_ZONE_SQL = """
sw_act AS (SELECT * FROM allocation WHERE HydroGroup = 'Surface Water' AND NOT Combined
  AND ConsentStatus IN ('Issued - Active', 'Issued - Inactive', 'Issued - s124 Continuance')),
sw_inp AS (SELECT * FROM allocation WHERE HydroGroup = 'Surface Water' AND NOT Combined AND ConsentStatus = 'Application in Process'),""" \
    + S.ffill("sw_act", "SpatialUnitId, AllocationBlock", "FromMonth", "AllocatedRate", "swa") + "," \
    + S.ffill("sw_inp", "SpatialUnitId, AllocationBlock", "FromMonth", "AllocatedRate", "swp") + """,
sw_zone AS (SELECT a.SpatialUnitId, a.AllocationBlock, a.Month, a.AllocatedRate, p.AllocatedRate AS NewAllocationInProgress
  FROM swa a LEFT JOIN (SELECT * FROM swp WHERE AllocatedRate IS NOT NULL) p
  ON p.SpatialUnitId = a.SpatialUnitId AND p.AllocationBlock = a.AllocationBlock AND p.Month = a.Month WHERE a.AllocatedRate IS NOT NULL)"""

V2_ALLOC = V2_CHAIN + "," + S.v2_rates() + "," + S.v2_volumes() + "," + S.ALLOC

SW_LIMITS_SQL = S.LIMITS_FLAT + """,
sw_notes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spatialId ORDER BY id, notes) AS rn
  FROM lim_notes WHERE HydroGroup = 'Surface Water') WHERE rn = 1),""" + S.ffill("lim_flat", "id, units, AllocationBlock", "fromMonth", "lim", "lim_m") + """,
sw_limits AS (SELECT n.id AS ManagementGroupId, n.spatialId AS SpatialUnitId, m.AllocationBlock, m.Month, d.Name, d.PlanName, d.PlanSection, d.PlanTable,
    CAST(m.lim AS BIGINT) AS AllocationLimit, m.units AS Units, n.notes AS Notes, TIMESTAMP '2020-07-01 00:00:00' AS EffectiveFromDate
  FROM sw_notes n JOIN lim_m m ON m.id = n.id JOIN lim_docs d ON d.id = n.id WHERE m.lim IS NOT NULL)"""


@register("sw_zone_allocation", uses=V2_USES, recursive=True, sql=V2_ALLOC + "," + SW_ZONE_SQL + """
--
SELECT * FROM sw_zone""")
def sw_zone_allocation(t):
    """Monthly SW rate per zone x block, forward filled."""
    return _v2(t)["sw_zone"]


@register("limits_flat", uses=("b_limit", "b_limit_head"), sql=S.LIMITS_FLAT + """
--
SELECT * FROM gw_limits""")
def limits_flat(t):
    """GW limits per zone x block."""
    return _gw_limits(t)


@register("limits_monthly", uses=("b_limit", "b_limit_head"), sql=SW_LIMITS_SQL + """
--
SELECT * FROM sw_limits""")
def limits_monthly(t):
    """SW limits per zone x block x month, forward filled."""
    return _sw_limits(t)


@register("view_sw_summary", uses=V2_USES + ("b_limit", "b_limit_head"), recursive=True, sql=V2_ALLOC + "," + SW_ZONE_SQL + "," + SW_LIMITS_SQL + f"""
--
SELECT l.SpatialUnitId, l.AllocationBlock, {S.month_name('l.Month', 'Jul')} AS MonthName, l.Month AS MonthId, z.AllocatedRate,
  z.NewAllocationInProgress, l.AllocationLimit,
  CASE WHEN l.AllocationLimit = 0 THEN 0 ELSE l.AllocationLimit - z.AllocatedRate END AS AllocationAvailable,
  CAST(CASE WHEN l.AllocationLimit = 0 THEN 0 ELSE round(CAST(z.AllocatedRate AS DOUBLE) / l.AllocationLimit * 100) END AS INTEGER) AS AllocatedPercentage,
  l.Units AS units, l.Notes AS notes
FROM sw_limits l JOIN sw_zone z ON z.SpatialUnitId = l.SpatialUnitId AND z.AllocationBlock = l.AllocationBlock AND z.Month = l.Month""")
def view_sw_summary(t):
    """D15 SW view: monthly limit vs allocated rate."""
    return L.sw_allocation_summary(_sw_limits(t), _v2(t)["sw_zone"])


@register("view_consent_details", uses=V2_USES, recursive=True, sql=V2_ALLOC + f"""
--
SELECT RecordNumber, HydroGroup, AllocationBlock, Wap, SpatialUnitId, ConsentStatus, FromDate, ToDate,
  {S.month_name('FromMonth', 'Jul')} AS FromMonth, {S.month_name('ToMonth', 'Jun')} AS ToMonth, AllocatedRate, AllocatedAnnualVolume
FROM allocation WHERE ConsentStatus IN ('Issued - Active', 'Issued - Inactive', 'Issued - s124 Continuance', 'Application in Process')""")
def view_consent_details(t):
    """Consent details with month names."""
    return L.consent_details(_v2(t)["allocation"])


@register("view_consent_zone_names", uses=V2_USES + ("b_limit", "b_limit_head"), recursive=True, sql=V2_ALLOC + "," + S.LIMITS_FLAT + """
--
SELECT a.*, z.SpatialUnitName FROM allocation a
JOIN (SELECT DISTINCT SpatialUnitId, Name AS SpatialUnitName FROM gw_limits) z ON z.SpatialUnitId = a.SpatialUnitId""")
def view_consent_zone_names(t):
    """Allocations joined to the distinct zone names of the GW limits."""
    return L.consent_zone_names(_v2(t)["allocation"], _gw_limits(t))


@register("joint_notes", uses=("b_site",), sql="""
lim_units AS (SELECT DISTINCT GwSpatialUnitId AS id, SwSpatialUnitId AS spatialId,
  CASE WHEN Storativity THEN 'Groundwater' ELSE 'Surface Water' END AS HydroGroup FROM b_site),
lim_joint AS (SELECT id, count(*) AS unit_count, string_agg(spatialId, ', ' ORDER BY spatialId) AS ju
  FROM (SELECT DISTINCT id, spatialId FROM lim_units) GROUP BY id),
lim_hydro AS (SELECT id, count(*) AS hydro_count FROM (SELECT DISTINCT id, HydroGroup FROM lim_units) GROUP BY id)
--
SELECT u.id, u.spatialId, u.HydroGroup,
  CASE WHEN coalesce(h.hydro_count, 1) > 1 AND j.unit_count > 1
         THEN 'Allocation limits for this allocation zone are combined between surface water and groundwater. The allocation limits are shared jointly across these zones: ' || j.ju
       WHEN j.unit_count > 1 THEN ' The allocation limits are shared jointly across these zones: ' || j.ju
       WHEN coalesce(h.hydro_count, 1) > 1 THEN 'Allocation limits for this allocation zone are combined between surface water and groundwater. '
       ELSE '' END AS notes
FROM lim_units u LEFT JOIN lim_joint j ON j.id = u.id LEFT JOIN lim_hydro h ON h.id = u.id""")
def joint_notes(t):
    """Notes for limits shared across zones and/or hydro groups (groups = GW zones, units = SW zones)."""
    s = t["b_site"]
    sg = s.select(F.col("GwSpatialUnitId").alias("id"), F.col("SwSpatialUnitId").alias("spatialId"),
                  F.when(F.col("Storativity"), F.lit("Groundwater")).otherwise(F.lit("Surface Water")).alias("HydroGroup")).distinct()
    return L.joint_notes(sg)


@register("alt_split", uses=V2_USES, recursive=True, sql=V2_CHAIN + "," + S.v2_rates(alt=True) + "," + S.v2_volumes(alt=True) + "," + S.ALLOC + """
--
SELECT * FROM allocation""")
def alt_split(t):
    """The allocation under the variant depletion rules."""
    return _v2(t, alt=True)["allocation"]


VARIANT_SQL = ",".join([S.PERMITS_V2, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL, S.SEASONS, VOLS]) + f""",
va_w AS (SELECT ExtSiteID AS Wap, coalesce(SD1_7Day, 0) AS SD1_7Day, coalesce(SD1_150Day, 0) AS SD1_150Day,
  coalesce(Storativity, false) AS Storativity, GwSpatialUnitId, coalesce(Combined, false) AS Combined FROM sites),
va_j AS (SELECT v.RecordNumber, v.TakeType, v.AllocationBlock, v.FullAnnualVolume, v.IncludeInGwAllocation, s.* EXCLUDE (RecordNumber, take_type, AllocationBlock, WAP), s.WAP AS Wap,
    CAST(sum(CAST(s.WapRate AS DECIMAL(18, 2))) OVER (PARTITION BY v.RecordNumber, v.TakeType, v.AllocationBlock) AS DOUBLE) AS agg
  FROM volumes v JOIN seasons s ON s.RecordNumber = v.RecordNumber AND s.take_type = v.TakeType AND s.AllocationBlock = v.AllocationBlock),
va_1 AS (SELECT * EXCLUDE (rn) FROM (SELECT j.* REPLACE ({S.bround('j.FullAnnualVolume * coalesce(j.WapRate / nullif(j.agg, 0), 1.0)')} AS FullAnnualVolume),
    w.SD1_7Day, w.SD1_150Day, w.Storativity, w.GwSpatialUnitId, w.Combined,
    row_number() OVER (PARTITION BY j.RecordNumber, j.AllocationBlock, j.Wap ORDER BY j.TakeType) AS rn FROM va_j j JOIN va_w w ON w.Wap = j.Wap) WHERE rn = 1),
va_2 AS (SELECT *, false AS LowflowCondition, (VolumeDaily / 24 / 60 / 60) * 1000 AS RateDaily, (Volume150Day / 150 / 24 / 60 / 60) * 1000 AS Rate150Day FROM va_1),
inputs AS (SELECT *, CAST(CASE sd_cat WHEN 'low' THEN 0.0 WHEN 'moderate' THEN 0.5 WHEN 'high' THEN 0.75 ELSE 1.0 END AS DOUBLE) AS ratio
  FROM (SELECT *, CASE WHEN TakeType = 'Take Surface Water' THEN 'direct' WHEN SD1_7Day >= 90 THEN 'direct' WHEN SD1_150Day >= 60 THEN 'high'
      WHEN (Rate150Day * (SD1_150Day * CAST(0.01 AS DOUBLE))) > 5 OR SD1_150Day >= 40 THEN 'moderate' ELSE 'low' END AS sd_cat FROM va_2)),""" + S.v2_rates(alt=True) + f""",
va_v AS (SELECT RecordNumber, AllocationBlock, Wap, 'Surface Water' AS HydroGroup, FullAnnualVolume * ratio AS vol FROM inputs
  UNION ALL SELECT RecordNumber, AllocationBlock, Wap, 'Groundwater', CASE
    WHEN (sd_cat = 'moderate' AND (Storativity OR Combined)) OR sd_cat IN ('high', 'direct') THEN FullAnnualVolume - FullAnnualVolume * ratio
    WHEN TakeType = 'Take Surface Water' THEN 0.0 ELSE FullAnnualVolume END FROM inputs),
va_r AS (SELECT i.RecordNumber, h.HydroGroup, i.AllocationBlock, i.Wap, i.GwSpatialUnitId AS SpatialUnitId, i.Combined, i.FromMonth, i.ToMonth,
    r.AllocatedRate AS rate, v.vol FROM inputs i JOIN (VALUES ('Groundwater'), ('Surface Water')) h(HydroGroup) ON true
  LEFT JOIN rates r ON r.RecordNumber = i.RecordNumber AND r.AllocationBlock = i.AllocationBlock AND r.Wap = i.Wap AND r.HydroGroup = h.HydroGroup
  LEFT JOIN va_v v ON v.RecordNumber = i.RecordNumber AND v.AllocationBlock = i.AllocationBlock AND v.Wap = i.Wap AND v.HydroGroup = h.HydroGroup
  WHERE CASE WHEN h.HydroGroup = 'Surface Water' THEN i.IncludeInSwAllocation ELSE i.IncludeInGwAllocation END),
va_f AS (SELECT * REPLACE (CASE WHEN vol = 0 THEN {S.bround('rate * 0.001 * 60 * 60 * 24 * 30.42 * (ToMonth - FromMonth + 1)')} ELSE vol END AS vol) FROM va_r),
va_g AS (SELECT * REPLACE (CASE WHEN rate = 0 THEN floor(vol / 60 / 60 / 24 / 30.42 / (ToMonth - FromMonth + 1) * 1000) ELSE rate END AS rate) FROM va_f)
--
SELECT g.* EXCLUDE (rate, vol, FromMonth, ToMonth), CAST(g.FromMonth AS INTEGER) AS FromMonth, CAST(g.ToMonth AS INTEGER) AS ToMonth, p.ConsentStatus, p.FromDate, p.ToDate,
  CAST({S.bround('coalesce(g.rate, 0.0)')} AS BIGINT) AS AllocatedRate, CAST({S.bround('coalesce(g.vol, 0.0)')} AS BIGINT) AS AllocatedAnnualVolume
FROM va_g g JOIN permits p ON p.RecordNumber = g.RecordNumber WHERE g.vol > 0 OR g.rate > 0"""


@register("variant_allocation", uses=V2_USES, recursive=True, sql=VARIANT_SQL)
def variant_allocation(t):
    """The variant's allocation with its block-level volume join, zero-means-missing fill and flags per row."""
    s = _v2(t)
    return v2.variant_allocation(v2.variant_inputs(s["seasons"], s["volumes"]), s["permits"], s["waps"])


@register("consented_allocation_parity", uses=V2_USES, recursive=True, sql=V2_CHAIN + "," + S.v2_rates() + "," + S.v2_volumes() + "," + S.ALLOC.replace(
    "SELECT rv0.*, mon.FromMonth, mon.ToMonth, i.IncludeInSwAllocation AS sw_inc\n  FROM rv0 JOIN mon ON mon.RecordNumber = rv0.RecordNumber AND mon.Wap = rv0.Wap\n"
    "  LEFT JOIN inputs i ON i.RecordNumber = rv0.RecordNumber AND i.AllocationBlock = rv0.AllocationBlock AND i.Wap = rv0.Wap",
    "SELECT rv0.*, i.FromMonth, i.ToMonth, i.IncludeInSwAllocation AS sw_inc\n  FROM rv0 JOIN inputs i ON i.RecordNumber = rv0.RecordNumber AND i.Wap = rv0.Wap") + """
--
SELECT * FROM allocation""")
def consented_allocation_parity(t):
    """D12 / DF6: the allocation with months and flags joined on (permit, site), which fans out over the permit's blocks."""
    s = _v2(t)
    return v2.consented_allocation(s["seasons"], s["waps"], s["lowflow"], s["volumes"], s["permits"], inputs=s["inputs"], parity=True)


LEGACY_SQL = ",".join([S.PERMITS, S.SITES, S.EDGES, S.WAP_CLEAN, S.HFILL]) + """,
lg0 AS (SELECT RecordNumber, take_type, AllocationBlock, WAP, FromMonth, ToMonth, CASE WHEN IncludeInSwAllocation THEN AllocatedRate ELSE 0.0 END AS rate,
  CASE WHEN IncludeInSwAllocation THEN SD1 ELSE 0.0 END AS sd0 FROM take_filled WHERE WAP IS NOT NULL AND AllocatedRate > 0),
lg1 AS (SELECT *, least(sd0, rate) AS sd FROM lg0),
lg2 AS (SELECT *, CAST(sum(round_even(CAST(CAST(sd AS VARCHAR) AS DECIMAL(38, 12)), 6)) OVER w AS DOUBLE) AS sd_crc_total,
    CAST(sum(round_even(CAST(CAST(rate AS VARCHAR) AS DECIMAL(38, 12)), 6)) OVER w AS DOUBLE) AS rate_crc_total
  FROM lg1 WINDOW w AS (PARTITION BY RecordNumber, take_type, AllocationBlock)),
lg3 AS (SELECT *, sd_crc_total / nullif(rate_crc_total, 0) AS sd_ratio FROM lg2),
lg4 AS (SELECT RecordNumber, take_type, AllocationBlock, WAP, FromMonth, ToMonth, sd_crc_total, rate_crc_total, sd_ratio,
    CAST(CASE WHEN take_type = 'Take Surface Water' THEN 1.0 WHEN sd_crc_total > 5 AND sd_ratio >= 0.9 THEN 1.0
         WHEN sd_crc_total > 5 AND sd_ratio >= 0.6 THEN 0.75 WHEN sd_crc_total > 5 OR sd_ratio >= 0.4 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS sw_vol_ratio,
    CASE WHEN take_type = 'Take Groundwater' THEN rate - (CASE WHEN sd_crc_total <= 5 THEN rate ELSE rate - sd END)
         WHEN take_type = 'Take Surface Water' THEN rate ELSE 0.0 END AS SurfaceWater,
    CASE WHEN take_type = 'Take Groundwater' AND sd_crc_total <= 5 THEN rate WHEN take_type = 'Take Groundwater' THEN rate - sd ELSE 0.0 END AS Groundwater
  FROM lg3)"""


def _legacy(t):
    from ..plans.v2 import filled_rows
    permits = materialize(clean_permits(t["b_permit"]), "permits")  # read for edges and rows
    sites = clean_sites(t["b_site"])
    return legacy_split(filled_rows(t["b_wap_allo"], permits, sites, clean_edges(t["b_parent_child"], permits)))


@register("legacy_sd_ratio", uses=V2_USES[:4], recursive=True, sql=LEGACY_SQL + """
--
SELECT * EXCLUDE (FromMonth, ToMonth) FROM lg4""")
def legacy_sd_ratio(t):
    """Legacy permit-level depletion ratio and SW/GW rates."""
    return _legacy(t).withColumnRenamed("Surface Water", "SurfaceWater").drop("FromMonth", "ToMonth")


@register("legacy_volumes", uses=V2_USES[:4] + ("b_allocated_volume",), recursive=True, sql=LEGACY_SQL + f""",
lv0 AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('take_type')} AS take_type,
    CASE {S.strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('allo_block')} END AS AllocationBlock,
    CAST(FullAnnualVolume AS DOUBLE) AS vol FROM b_allocated_volume
  WHERE FullAnnualVolume > 0 AND coalesce({S.label('IncludeInGwAllocation')} <> 'No', true)),
lvm AS (SELECT *, unnest(CASE WHEN FromMonth > ToMonth THEN range(1, ToMonth + 1) ELSE range(FromMonth, ToMonth + 1) END) AS Month FROM lg4),
lvw AS (SELECT RecordNumber, AllocationBlock, WAP, {S.mean2('Groundwater')} AS gw, {S.mean2('SurfaceWater')} AS sw, min(Month) AS FromMonth, max(Month) AS ToMonth
  FROM lvm GROUP BY ALL),
lvr AS (SELECT RecordNumber, AllocationBlock, 'Groundwater' AS HydroGroup, WAP, FromMonth, ToMonth, gw AS rate FROM lvw
  UNION ALL SELECT RecordNumber, AllocationBlock, 'Surface Water', WAP, FromMonth, ToMonth, sw FROM lvw),
lvs AS (SELECT v.RecordNumber, v.AllocationBlock, v.vol, v.vol * coalesce(g.sw_vol_ratio, CASE WHEN v.take_type = 'Take Surface Water' THEN 1.0 ELSE 0.0 END) AS swv
  FROM lv0 v LEFT JOIN (SELECT DISTINCT RecordNumber, take_type, AllocationBlock, sw_vol_ratio FROM lg4) g
    ON g.RecordNumber = v.RecordNumber AND g.take_type = v.take_type AND g.AllocationBlock = v.AllocationBlock
  WHERE v.RecordNumber IN (SELECT RecordNumber FROM lvr)),
lvl AS (SELECT RecordNumber, AllocationBlock, HydroGroup, CAST(sum(CAST(vol AS DECIMAL(20, 6))) AS DOUBLE) AS vol FROM (
    SELECT RecordNumber, AllocationBlock, 'Surface Water' AS HydroGroup, swv AS vol FROM lvs
    UNION ALL SELECT RecordNumber, AllocationBlock, 'Groundwater', vol - swv FROM lvs) GROUP BY ALL),
lvj AS (
  SELECT r.*, l.vol, CASE WHEN l.vol IS NULL THEN 'rate' ELSE 'both' END AS Source
  FROM lvr r LEFT JOIN lvl l ON l.RecordNumber = r.RecordNumber AND l.AllocationBlock = r.AllocationBlock AND l.HydroGroup = r.HydroGroup
  UNION ALL
  SELECT l.RecordNumber, l.AllocationBlock, l.HydroGroup, r.WAP, r.FromMonth, r.ToMonth, r.rate, l.vol, 'rerouted'
  FROM lvl l LEFT JOIN lvr r ON r.RecordNumber = l.RecordNumber AND r.HydroGroup = l.HydroGroup
  WHERE NOT EXISTS (SELECT 1 FROM lvr x WHERE x.RecordNumber = l.RecordNumber AND x.AllocationBlock = l.AllocationBlock AND x.HydroGroup = l.HydroGroup)),
lvt AS (SELECT *, CAST(sum(CAST(rate AS DECIMAL(20, 2))) OVER (PARTITION BY RecordNumber, AllocationBlock, HydroGroup) AS DOUBLE) AS total FROM lvj),
lvv AS (SELECT * REPLACE (coalesce({S.bround('vol * coalesce(rate / nullif(total, 0), 1.0)')}, 0.0) AS vol) FROM lvt),
lvf AS (SELECT * REPLACE (CASE WHEN vol = 0 THEN {S.bround('rate * 0.001 * 60 * 60 * 24 * 30.42 * (ToMonth - FromMonth + 1)')} ELSE vol END AS vol)
  FROM lvv WHERE NOT coalesce(rate = 0 AND vol = 0, false))
--
SELECT RecordNumber, AllocationBlock, HydroGroup, WAP, FromMonth, ToMonth,
  CASE WHEN rate = 0 THEN {S.bround('vol / 60 / 60 / 24 / 30.42 / (ToMonth - FromMonth + 1) * 1000', 2)} ELSE rate END AS AllocatedRate,
  vol AS AllocatedAnnualVolume, Source FROM lvf""")
def legacy_volumes_q(t):
    """Rates and volumes, with the volumes that have no site in their block rerouted."""
    return legacy_volumes(_legacy(t), clean_legacy_volumes(t["b_allocated_volume"]))


# ======================================================================== time series

@register("incremental_slice", uses=("b_site_log",), sql="""
--
SELECT * FROM b_site_log WHERE RestrDate BETWEEN (SELECT max(RestrDate) FROM b_site_log WHERE RestrDate <= DATE '2024-01-15') + 1
  AND DATE '2024-01-25'""")
def incremental_slice(t):
    """Rows after the last loaded day up to the run date."""
    log = t["b_site_log"]
    loaded = log.filter(F.col("RestrDate") <= F.lit("2024-01-15").cast("date"))
    window = TS.incremental_range(loaded, "RestrDate", "2024-01-25")
    return TS.slice_range(log, "RestrDate", window)


@register("incremental_load", uses=("b_site_log",), sql="""
--
SELECT * FROM b_site_log WHERE RestrDate BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""")
def incremental_load(t):
    """Two runs that load the new days of a log partitioned by day into a table partitioned by day."""
    from ..sources.tables import load_new_days
    base = scratch_path(t.spark, f"kept/days-{uuid.uuid4().hex}")
    t["b_site_log"].hint("rebalance", "RestrDate").write.partitionBy("RestrDate").parquet(f"{base}/log")
    log = t.spark.read.schema(t["b_site_log"].schema).parquet(f"{base}/log")
    for run_date in ("2024-01-15", "2024-01-25"):
        load_new_days(log, f"{base}/table", "RestrDate", run_date, bootstrap="2024-01-05")
    return t.spark.read.schema(log.schema).parquet(f"{base}/table").select(*t["b_site_log"].columns)


@register("site_day_log", uses=("b_site_log",), sql="""
--
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ExtSiteID, RestrDate ORDER BY MeasurementMethod DESC NULLS LAST,
  event_id DESC NULLS LAST, Measurement DESC NULLS LAST, MeasurementMethod DESC NULLS LAST, Allocation DESC NULLS LAST) AS rn FROM b_site_log) WHERE rn = 1""")
def site_day_log(t):
    """One row per site-day, preferred measurement method first."""
    return TS.site_day(t["b_site_log"])


@register("restriction_ts", uses=V1_USES + ("b_trigger", "b_site_log"), recursive=True,
          sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + S.restr_sql(RUN_DATE, WINDOW_START) + """
--
SELECT * FROM restr""")
def restriction_ts(t):
    """Daily restriction per permit x block x site within permit validity."""
    return _restr(t)


@register("block_restriction_min", uses=V1_USES + ("b_trigger", "b_site_log"), recursive=True,
          sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + S.restr_sql(RUN_DATE, WINDOW_START) + """
--
SELECT RecordNumber, AllocationBlock, ExtSiteID, RestrDate, min(Allocation) AS Allocation FROM restr
GROUP BY RecordNumber, AllocationBlock, ExtSiteID, RestrDate""")
def block_restriction_min(t):
    """T4: minimum restriction per permit x block x site x day."""
    return TS.block_restriction(_restr(t))


RESTR_IDS = LF_SITES + f""",
rf_c AS (SELECT *, row_number() OVER (ORDER BY RecordNumber, AlloBlockID, SiteID) AS CrcAlloSiteID FROM ls_all),
rf AS (SELECT c.CrcAlloSiteID, l.RestrDate, min(l.Allocation) AS Allocation FROM b_site_log l JOIN rf_c c ON c.ExtSiteID = l.ExtSiteID
  JOIN permits p ON p.RecordNumber = c.RecordNumber AND l.RestrDate BETWEEN p.FromDate AND p.ToDate
  WHERE l.RestrDate BETWEEN DATE '{WINDOW_START}' AND DATE '{RUN_DATE}' AND p.FromDate < DATE '{RUN_DATE}' AND p.ToDate > DATE '{WINDOW_START}'
  GROUP BY c.CrcAlloSiteID, l.RestrDate)"""


def _restr_ids(t, listed=False):
    """(daily fact by allocation-site ids, allocation sites, blocks)."""
    r = V1.run_v1(t)
    blocks, allo_sites = _lowflow_ids(t)
    feed = TS.restriction_feed(_allocations(t), allo_sites, r["permits"], RUN_DATE, WINDOW_START, listed=True)
    return TS.restriction_fact(feed, r["permits"], None, allo_sites, None, RUN_DATE, WINDOW_START, listed=listed), allo_sites, blocks


@register("restriction_fact", uses=V1_USES + ("b_trigger", "b_lowflow_site", "b_site_log"), recursive=True,
          sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + RESTR_IDS + """
--
SELECT * FROM rf""")
def restriction_fact(t):
    """T2 by ids: daily restriction per allocation site within permit validity."""
    return _restr_ids(t)[0]


@register("block_restriction_by_ids", uses=V1_USES + ("b_trigger", "b_lowflow_site", "b_site_log"), recursive=True,
          sql=ARV_CHAIN + "," + S.TRIG_SQL + "," + RESTR_IDS + """
--
SELECT c.RecordNumber, b.b AS AllocationBlock, rf.RestrDate, min(rf.Allocation) AS Allocation FROM rf JOIN rf_c c ON c.CrcAlloSiteID = rf.CrcAlloSiteID
JOIN ls_ab b ON b.id = c.AlloBlockID GROUP BY c.RecordNumber, b.b, rf.RestrDate""")
def block_restriction_by_ids(t):
    """T4 by ids: minimum restriction per permit x block label x day over the permit's allocation sites."""
    return TS.block_restriction_by_ids(*_restr_ids(t, listed=True))


# ======================================================================== spatial

@register("point_in_zone", uses=("b_site", "b_zone_vertex"), sql=S.EDGES_POLY + """
--
SELECT ExtSiteID, zone_id FROM pip""")
def point_in_zone(t):
    """G1: GW zone of each site by point in polygon (grid-bucketed ray casting)."""
    return points_in_zones(t["b_site"].select("ExtSiteID", "NZTMX", "NZTMY"), t["b_zone_vertex"], "ExtSiteID",
                           "NZTMX", "NZTMY").select("ExtSiteID", "zone_id")


@register("nearest_vertex", uses=("b_site", "b_reach_vertex"), sql=S.NEAREST + """
--
SELECT * FROM nearest""")
def nearest_vertex(t):
    """Nearest reach vertex and distance for each site (multi-level grid search)."""
    out = nearest_vertex_op(t["b_site"].select("ExtSiteID", "NZTMX", "NZTMY"), t["b_reach_vertex"], "ExtSiteID", "NZTMX", "NZTMY")
    return out.select("ExtSiteID", "vertex_id", "reach_id", "distance")


@register("wap_table", uses=("b_site", "b_aquifer_test", "b_zone_vertex", "b_reach_vertex"), sql=S.EDGES_POLY + "," + S.NEAREST + f"""
--
SELECT s.ExtSiteID AS Wap, CAST({S.bround('CAST(coalesce(s.SD1_7Day, 0) AS DOUBLE)')} AS INTEGER) AS SD1_7Day,
  CAST({S.bround('CAST(coalesce(s.SD1_30Day, 0) AS DOUBLE)')} AS INTEGER) AS SD1_30Day,
  CAST({S.bround('CAST(coalesce(s.SD1_150Day, 0) AS DOUBLE)')} AS INTEGER) AS SD1_150Day,
  s.ExtSiteID IN (SELECT Wap FROM b_aquifer_test WHERE Storativity IS NOT NULL) AS Storativity,
  p.zone_id AS GwSpatialUnitId, z.Name AS SpatialUnitName, coalesce(contains(p.zone_id, 'CWAZ'), false) AS Combined,
  n.reach_id AS SwSpatialUnitId, CAST({S.bround('n.distance')} AS INTEGER) AS DistanceToSw, s.NZTMX AS NzTmX, s.NZTMY AS NzTmY
FROM b_site s JOIN pip p ON p.ExtSiteID = s.ExtSiteID
LEFT JOIN (SELECT DISTINCT zone_id, Name FROM b_zone_vertex) z ON z.zone_id = p.zone_id
LEFT JOIN nearest n ON n.ExtSiteID = s.ExtSiteID""")
def wap_table(t):
    """The Waps table (depletion, aquifer-test flag, zone, nearest reach)."""
    return RP.wap_table(t["b_site"], t["b_aquifer_test"], t["b_zone_vertex"], t["b_reach_vertex"])


@register("lowflow_site_view", uses=("b_trigger", "b_reach_vertex"), sql="""
--
SELECT c.ExtSiteID, c.SiteName, l.NZTMX, l.NZTMY
FROM (SELECT DISTINCT t.ExtSiteID, s.s_name AS SiteName FROM b_trigger t JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = t.ExtSiteID) c
JOIN (SELECT CAST(vertex_id AS VARCHAR) AS ExtSiteID, x AS NZTMX, y AS NZTMY FROM b_reach_vertex) l ON l.ExtSiteID = c.ExtSiteID""")
def lowflow_site_view(t):
    """Consents sites joined to low-flow site coordinates."""
    sites = t["b_trigger"].select("ExtSiteID").distinct().join(
        t["supplier"].select(F.col("s_suppkey").cast("string").alias("ExtSiteID"), F.col("s_name").alias("SiteName")), "ExtSiteID")
    lf = t["b_reach_vertex"].select(F.col("vertex_id").cast("string").alias("ExtSiteID"), F.col("x").alias("NZTMX"), F.col("y").alias("NZTMY"))
    return RP.lowflow_site_view(sites, lf)


# ======================================================================== data quality

@register("dq_constraints", uses=("b_permit", "b_allocated_volume"), sql=S.PERMITS + f""",
av AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('take_type')} AS TakeType,
  CASE {S.strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('allo_block')} END AS AllocationBlock,
  CAST(trunc(CAST(FullAnnualVolume AS DOUBLE)) AS BIGINT) AS FullAnnualVolume FROM b_allocated_volume)
--
SELECT 'pk_duplicate' AS rule, RecordNumber, TakeType, AllocationBlock, count(*) AS n FROM av GROUP BY 2, 3, 4 HAVING count(*) > 1
UNION ALL SELECT 'pk_null', RecordNumber, TakeType, AllocationBlock, count(*) FROM av
  WHERE RecordNumber IS NULL OR TakeType IS NULL OR AllocationBlock IS NULL GROUP BY 2, 3, 4
UNION ALL SELECT 'fk_missing:RecordNumber', RecordNumber, TakeType, AllocationBlock, count(*) FROM av
  WHERE RecordNumber IS NOT NULL AND RecordNumber NOT IN (SELECT RecordNumber FROM permits) GROUP BY 2, 3, 4
UNION ALL SELECT 'null:FullAnnualVolume', RecordNumber, TakeType, AllocationBlock, count(*) FROM av WHERE FullAnnualVolume IS NULL GROUP BY 2, 3, 4""")
def dq_constraints(t):
    """Q2: PK, FK and not-null violations of the allocated-volume table."""
    av = t["b_allocated_volume"].select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"), title_words(strip_ws("take_type")).alias("TakeType"),
        recode(strip_ws("allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"),
        F.col("FullAnnualVolume").try_cast("double").cast("bigint").alias("FullAnnualVolume"))
    return Q.check_constraints(av, ["RecordNumber", "TakeType", "AllocationBlock"],
                               fks=[(["RecordNumber"], clean_permits(t["b_permit"]), ["RecordNumber"])],
                               not_null=["FullAnnualVolume"])


@register("dq_band_class", uses=("b_trigger",), sql="""
--
SELECT * FROM (SELECT RecordNumber, ExtSiteID, BandNumber, MinAllocation, MaxAllocation,
  CASE WHEN MaxAllocation < 100 THEN 'max_allo_under_100' WHEN MinAllocation = 100 AND MaxAllocation > 100 THEN 'min_allo_equals_100'
       WHEN MinAllocation < 100 AND MaxAllocation > 100 THEN 'min_allo_less_than_100' END AS band_class FROM b_trigger) WHERE band_class IS NOT NULL""")
def dq_band_class(t):
    """Q4: trigger-band anomaly classes."""
    b = t["b_trigger"].select("RecordNumber", "ExtSiteID", "BandNumber", "MinAllocation", "MaxAllocation",
                              Q.band_class().alias("band_class"))
    return b.filter(F.col("band_class").isNotNull())


@register("join_interval", uses=("b_permit", "b_trigger", "b_site_log"),
          sql=S.PERMITS + "," + S.restr_sql(RUN_DATE, WINDOW_START).split("rj AS (")[0].rstrip().rstrip(",") + """
--
SELECT * FROM fv""")
def join_interval(t):
    """Daily feed rows joined to their permit's validity span [FromDate, ToDate]."""
    permits = clean_permits(t["b_permit"])
    # the feed's join of days and bands holds each day against its permit's span: this is the interval join
    return TS.restriction_feed(t["b_site_log"], t["b_trigger"], permits, RUN_DATE, WINDOW_START)
