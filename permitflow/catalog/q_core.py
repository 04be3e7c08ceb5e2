"""Source, sink, cleaning and scalar-function queries (S*, K*, P*, F*, C*, X*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from . import register
from . import sqlparts as S
from .. import config as C
from ..functions import dates as D
from ..functions.measures import half_even, rate_to_volume, share, volume_to_rate
from ..functions.months import water_month, water_month_name
from ..functions.text import contains_text, fix_spacing, replace_word, strip_ws, title_words
from ..functions.json import json_field
from ..operators import clean as CL
from ..operators.sync import assign_ids, compare, delete_keys, mirror, upsert_diff
from ..plans import limits as L
from ..plans.common import clean_permits, clean_wap_allo
from ..sources.tables import high_water, read_table

RUN_TS = "2020-07-01 00:00:00"
OLD_TS = "2020-01-01 00:00:00"
AS_OF = "2020-07-01"

# ---------------------------------------------------------------- sources


@register("scan_project_rename", sql="""
SELECT l_orderkey AS OrderKey, l_linenumber AS LineNumber, l_quantity AS Quantity, l_shipdate AS ShipDate FROM lineitem""")
def scan_project_rename(t):
    """Column list + rename map, pruned at the scan."""
    return read_table(t.spark, f"{t.sf_dir}/lineitem.parquet",
                      cols=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
                      rename={"l_orderkey": "OrderKey", "l_linenumber": "LineNumber",
                              "l_quantity": "Quantity", "l_shipdate": "ShipDate"})


@register("scan_where_in", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3))""")
def scan_where_in(t):
    """Literal IN list (pushed to the scan) and an id list from another table (semi join)."""
    custs = t["customer"].filter(F.col("c_nationkey").isin(1, 2, 3)).select("c_custkey")
    return read_table(t.spark, f"{t.sf_dir}/orders.parquet", cols=["o_orderkey", "o_custkey", "o_orderstatus"],
                      where_in={"o_orderstatus": ["F", "P"], "o_custkey": custs})


@register("scan_date_range", uses=("b_site_log",), sql="""
SELECT ExtSiteID, RestrDate, Allocation FROM b_site_log
WHERE RestrDate BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def scan_date_range(t):
    """S3: inclusive date range on the date column."""
    return read_table(t.spark, t["b_site_log"], cols=["ExtSiteID", "RestrDate", "Allocation"],
                      from_date="2024-01-10", to_date="2024-01-20", date_col="RestrDate")


@register("high_water_mark", uses=("b_site_log",), sql="""
SELECT max(RestrDate) AS max_RestrDate, min(RestrDate) AS min_RestrDate FROM b_site_log""")
def high_water_mark(t):
    """Last and first loaded date."""
    return high_water(t["b_site_log"], "RestrDate")


@register("json_nested_scan", uses=("b_limit", "b_limit_head"), sql="""
jn AS (SELECT DISTINCT h.id, l.spatialId, l.HydroGroup, l.AllocationBlock, l.units, l.AllocationLimit, l.fromMonth
  FROM b_limit_head h JOIN b_limit l ON l.id = h.id % 1000 WHERE h.has_unit)
--
SELECT * FROM jn UNION ALL SELECT DISTINCT id, spatialId, HydroGroup, 'Flow', 'l/s', 999, 1 FROM jn""")
def json_nested_scan(t):
    """S7 + R4: files of nested documents read with a fixed schema (a unit field is an array or one object) and flattened."""
    from .q_domain import limit_files
    docs = L.read_limits(t.spark, limit_files(t))
    return L.group_units(docs).join(L.flatten_limits(docs), "id").select(
        "id", "spatialId", "HydroGroup", "AllocationBlock", "units", F.col("limit").alias("AllocationLimit"), F.col("fromMonth").cast("int").alias("fromMonth"))


@register("catalog_scan", uses=("b_permit",), sql="""
--
SELECT RecordNumber AS "Permit Record", ConsentStatus, FromDate FROM b_permit WHERE ConsentStatus IN ('Issued - Active', 'Application in Process') AND FromDate BETWEEN '1994-01-01' AND '1995-12-31'""")
def catalog_scan(t):
    """A schema-qualified table of the session catalog, read by name with columns, names and filters from configuration."""
    import uuid
    from ..session import scratch_path
    from ..sources.tables import catalog_table, read_table
    config = {"cols": ["RecordNumber", "ConsentStatus", "FromDate"], "rename": {"RecordNumber": "Permit Record"},
              "where_in": {"ConsentStatus": ["Issued - Active", "Application in Process"]}, "from_date": "1994-01-01", "to_date": "1995-12-31", "date_col": "FromDate"}
    name = catalog_table(t["b_permit"], "permit_source", f"permits_{uuid.uuid4().hex}", scratch_path(t.spark, "catalog"))
    return read_table(t.spark, name, **config)


# ---------------------------------------------------------------- sync

def _old_new_permits(t):
    new = clean_permits(t["b_permit"])
    old = new.filter(F.col("FromDate") < F.lit("1998-01-01").cast("date")).withColumn(
        "ConsentStatus", CL.recode("ConsentStatus", {"Issued - Active": "Application in Process"}))
    return old, new


OLD_NEW_SQL = S.PERMITS + """,
old_p AS (SELECT RecordNumber, CASE WHEN ConsentStatus = 'Issued - Active' THEN 'Application in Process' ELSE ConsentStatus END AS ConsentStatus,
  FromDate, ToDate, NZTMX, NZTMY, EcanID FROM permits WHERE FromDate < DATE '1998-01-01'),
changed AS (SELECT n.*, CASE WHEN o.RecordNumber IS NULL THEN 'new'
    WHEN n.ConsentStatus IS DISTINCT FROM o.ConsentStatus OR n.FromDate IS DISTINCT FROM o.FromDate OR n.ToDate IS DISTINCT FROM o.ToDate
      OR n.NZTMX IS DISTINCT FROM o.NZTMX OR n.NZTMY IS DISTINCT FROM o.NZTMY OR n.EcanID IS DISTINCT FROM o.EcanID THEN 'diff' END AS _change
  FROM permits n LEFT JOIN old_p o ON o.RecordNumber = n.RecordNumber)"""


@register("upsert_diff", uses=("b_permit",), sql=OLD_NEW_SQL + f"""
--
SELECT o.*, TIMESTAMP '{OLD_TS}' AS ModifiedDate FROM old_p o
WHERE o.RecordNumber NOT IN (SELECT RecordNumber FROM changed WHERE _change IS NOT NULL)
UNION ALL
SELECT RecordNumber, ConsentStatus, FromDate, ToDate, NZTMX, NZTMY, EcanID, TIMESTAMP '{RUN_TS}' FROM changed WHERE _change IS NOT NULL""")
def upsert_diff_q(t):
    """K2: permits upserted by difference; only new/changed rows are re-stamped."""
    old, new = _old_new_permits(t)
    old = old.withColumn("ModifiedDate", F.lit(OLD_TS).cast("timestamp_ntz"))
    merged, _, _ = upsert_diff(old, new, "RecordNumber", RUN_TS)
    return merged


@register("table_diff", uses=("b_permit",), sql=OLD_NEW_SQL + """
--
SELECT * FROM changed WHERE _change IS NOT NULL
UNION ALL
SELECT o.*, 'remove' FROM old_p o WHERE o.RecordNumber NOT IN (SELECT RecordNumber FROM permits)""")
def table_diff(t):
    """K4: new / diff / remove in one frame."""
    old, new = _old_new_permits(t)
    return compare(old, new, "RecordNumber")


SCOPED_SQL = S.PERMITS + "," + S.WAP_CLEAN + """,
old_cas AS (SELECT DISTINCT RecordNumber, AllocationBlock, WAP FROM wa_clean WHERE WAP IS NOT NULL),
new_cas AS (SELECT DISTINCT RecordNumber, AllocationBlock, WAP FROM wa_clean WHERE WAP IS NOT NULL AND take_type = 'Take Groundwater')"""


@register("upsert_diff_scoped", uses=("b_permit", "b_wap_allo"), sql=SCOPED_SQL + """
--
SELECT o.* FROM old_cas o
WHERE o.WAP IN (SELECT WAP FROM new_cas)
  AND NOT EXISTS (SELECT 1 FROM new_cas n WHERE n.RecordNumber = o.RecordNumber AND n.AllocationBlock = o.AllocationBlock AND n.WAP = o.WAP)""")
def upsert_diff_scoped(t):
    """K3: upsert limited to the sites present in the new run; returns the rows to remove."""
    wa = clean_wap_allo(t["b_wap_allo"]).filter(F.col("WAP").isNotNull())
    old = wa.select("RecordNumber", "AllocationBlock", "WAP").distinct()
    new = wa.filter(F.col("take_type") == C.TAKE_GW).select("RecordNumber", "AllocationBlock", "WAP").distinct()
    _, _, removed = upsert_diff(old, new, ["RecordNumber", "AllocationBlock", "WAP"], RUN_TS, scope_cols=["WAP"])
    return removed


@register("delete_by_keys", uses=("b_permit", "b_wap_allo"), sql=S.PERMITS + "," + S.WAP_CLEAN + """
--
SELECT * FROM wa_clean WHERE RecordNumber NOT IN (SELECT RecordNumber FROM permits WHERE ConsentStatus = 'Issued - s124 Continuance')""")
def delete_by_keys(t):
    """K5: delete s124 permits; the dependent take rows are removed first (cascade)."""
    permits = clean_permits(t["b_permit"])
    gone = permits.filter(F.col("ConsentStatus") == C.S124_STATUS).select("RecordNumber")
    _, children = delete_keys(permits, gone, "RecordNumber", cascade=[(clean_wap_allo(t["b_wap_allo"]), "RecordNumber")])
    return children[0]


@register("audit_summary", uses=("b_permit", "b_parent_child", "b_site"), sql=S.PERMITS + "," + S.SITES + "," + S.EDGES + f"""
,counts AS (SELECT 'Permit' AS HydroTable, count(*) AS n FROM permits
  UNION ALL SELECT 'ParentChild', count(*) FROM edges
  UNION ALL SELECT 'ConsentsSites', count(*) FROM sites)
--
SELECT TIMESTAMP '{OLD_TS}' AS RunTimeStart, TIMESTAMP '{RUN_TS}' AS RunTimeEnd, DATE '1900-01-01' AS DataFromTime,
  HydroTable, 'pass' AS RunResult, left(CAST(n AS VARCHAR) || ' rows updated', 299) AS Comment FROM counts""")
def audit_summary(t):
    """Run-log rows whose counts the writes of the tables observed."""
    from ..operators.hierarchy import clean_edges
    from ..operators.kept import RunLog
    from ..plans.common import clean_sites
    log = RunLog(t.spark, OLD_TS, "1900-01-01")
    permits = log.write(clean_permits(t["b_permit"]), "Permit")
    log.write(clean_edges(t["b_parent_child"], permits), "ParentChild")
    log.write(clean_sites(t["b_site"]), "ConsentsSites")
    return log.rows(RUN_TS)


@register("surrogate_keys", uses=("b_site",), sql="""
ex AS (SELECT ExtSiteID, row_number() OVER (ORDER BY ExtSiteID) AS SiteID FROM b_site WHERE NZTMX < 1450000),
nw AS (SELECT ExtSiteID, (SELECT max(SiteID) FROM ex) + row_number() OVER (ORDER BY ExtSiteID) AS SiteID
  FROM b_site WHERE ExtSiteID NOT IN (SELECT ExtSiteID FROM ex))
--
SELECT ExtSiteID, SiteID FROM ex UNION ALL SELECT ExtSiteID, SiteID FROM nw""")
def surrogate_keys(t):
    """K8: ids kept for known sites, new sites numbered after the max."""
    sites = t["b_site"].select("ExtSiteID")
    existing = assign_ids(t["b_site"].filter(F.col("NZTMX") < 1450000).select("ExtSiteID"), "ExtSiteID", id_col="SiteID")
    return assign_ids(sites, "ExtSiteID", existing, id_col="SiteID").select("ExtSiteID", "SiteID")


@register("mirror_dedup", uses=("b_wap_allo",), sql="""
--
SELECT * EXCLUDE (rn) REPLACE (CAST(VolumeDaily AS BIGINT) AS VolumeDaily, CAST(VolumeWeekly AS BIGINT) AS VolumeWeekly,
  CAST(Volume30Day AS BIGINT) AS Volume30Day, CAST(Volume150Day AS BIGINT) AS Volume150Day)
FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, take_type, sw_allo_block, WAP, FromMonth
  ORDER BY ToMonth NULLS LAST, AllocatedRate NULLS FIRST, WapRate NULLS FIRST, VolumeDaily NULLS FIRST, VolumeWeekly NULLS FIRST,
  Volume30Day NULLS FIRST, Volume150Day NULLS FIRST, ToMonth NULLS FIRST, SD1 NULLS FIRST, SD2 NULLS FIRST, IncludeInSwAllocation NULLS FIRST) AS rn
  FROM b_wap_allo WHERE RecordNumber IS NOT NULL AND take_type IS NOT NULL AND sw_allo_block IS NOT NULL AND WAP IS NOT NULL AND FromMonth IS NOT NULL)
WHERE rn = 1""")
def mirror_dedup(t):
    """Raw mirror, null PKs dropped, one row per PK."""
    return mirror(t["b_wap_allo"], ["RecordNumber", "take_type", "sw_allo_block", "WAP", "FromMonth"], [("ToMonth", "asc")])


# ---------------------------------------------------------------- projections / filters

def _act_sources(t):
    takes = t["b_wap_allo"].select(title_words(strip_ws("take_type")).alias("a"))
    uses = t["b_water_use"].select(fix_spacing(title_words(strip_ws("UseType")), 3).alias("a"))
    return takes.unionByName(uses)


@register("activity_names", uses=("b_wap_allo", "b_water_use"), sql=f"""
acts AS (SELECT {S.label('take_type')} AS a FROM b_wap_allo UNION ALL
  SELECT CASE WHEN substr({S.label('UseType')}, 4, 2) = '  ' THEN substr({S.label('UseType')}, 1, 3) || substr({S.label('UseType')}, 5) ELSE {S.label('UseType')} END FROM b_water_use)
--
SELECT DISTINCT split_part(a, ' ', 1) AS ActivityType, substr(a, instr(a, ' ') + 1) AS HydroGroup,
  split_part(a, ' ', 1) || ' ' || substr(a, instr(a, ' ') + 1) AS ActivityName FROM acts""")
def activity_names(t):
    """ActivityType + ' ' + HydroGroup."""
    a = _act_sources(t)
    parts = a.select(F.substring_index("a", " ", 1).alias("ActivityType"),
                     F.substr(F.col("a"), F.instr("a", " ") + 1).alias("HydroGroup"))
    return parts.withColumn("ActivityName", CL.concat_label(["ActivityType", "HydroGroup"])).distinct()


@register("masked_assign", uses=("b_wap_allo",), sql="wa_clean AS (" + S.WAP_CLEAN.split("wa_clean AS (", 1)[1].split("take_rows AS (")[0].rstrip().rstrip(",") + """
--
SELECT RecordNumber, take_type, AllocationBlock, WAP,
  CASE WHEN take_type = 'Take Groundwater' THEN SD1 WHEN take_type = 'Take Surface Water' THEN AllocatedRate ELSE 0.0 END AS sw_rate,
  CASE WHEN take_type = 'Take Groundwater' THEN AllocatedRate - SD1 ELSE 0.0 END AS gw_rate
FROM wa_clean""")
def masked_assign(t):
    """Masked assignments in order (last write wins)."""
    wa = clean_wap_allo(t["b_wap_allo"]).withColumns({"sw_rate": F.lit(0.0), "gw_rate": F.lit(0.0)})
    sw, gw = F.col("take_type") == C.TAKE_SW, F.col("take_type") == C.TAKE_GW
    wa = CL.assign_when(wa, "sw_rate", [(sw, F.col("AllocatedRate")), (gw, F.col("SD1"))])
    wa = CL.assign_when(wa, "gw_rate", [(gw, F.col("AllocatedRate") - F.col("SD1"))])
    return wa.select("RecordNumber", "take_type", "AllocationBlock", "WAP", "sw_rate", "gw_rate")


@register("filter_valid_permits", uses=("b_permit",), sql=f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, {S.strip('ConsentStatus')} AS ConsentStatus, {S.key('EcanID')} AS EcanID
FROM b_permit WHERE {S.key('RecordNumber')} IS NOT NULL AND {S.strip('ConsentStatus')} IS NOT NULL AND {S.key('EcanID')} IS NOT NULL""")
def filter_valid_permits(t):
    """required columns non-null."""
    p = CL.norm_key(t["b_permit"], ["RecordNumber", "EcanID"])
    p = CL.strip_cols(p, ["ConsentStatus"])
    return CL.require(p, ["RecordNumber", "ConsentStatus", "EcanID"]).select("RecordNumber", "ConsentStatus", "EcanID")


def _consented(t):
    c = t["b_consented"]
    c = c.select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                 title_words(strip_ws("take_type")).alias("TakeType"),
                 F.col("ConsentedRate").try_cast("double").alias("ConsentedRate"),
                 F.bround(F.col("ConsentedMultiDayVolume").try_cast("double")).alias("ConsentedMultiDayVolume"),
                 F.bround(F.col("ConsentedMultiDayPeriod").try_cast("double")).alias("ConsentedMultiDayPeriod"),
                 F.bround(F.col("ConsentedAnnualVolume").try_cast("double")).alias("ConsentedAnnualVolume"),
                 "LowflowCondition")
    return CL.nullify_nonpositive(c, ["ConsentedRate", "ConsentedMultiDayVolume", "ConsentedMultiDayPeriod",
                                      "ConsentedAnnualVolume"])


CONSENTED_SQL = f"""
cons0 AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('take_type')} AS TakeType,
  CAST(ConsentedRate AS DOUBLE) AS r, round_even(CAST(ConsentedMultiDayVolume AS DOUBLE), 0) AS v,
  round_even(CAST(ConsentedMultiDayPeriod AS DOUBLE), 0) AS p, round_even(CAST(ConsentedAnnualVolume AS DOUBLE), 0) AS a, LowflowCondition
  FROM b_consented),
cons AS (SELECT RecordNumber, TakeType, CASE WHEN r > 0 THEN r END AS ConsentedRate, CASE WHEN v > 0 THEN v END AS ConsentedMultiDayVolume,
  CASE WHEN p > 0 THEN p END AS ConsentedMultiDayPeriod, CASE WHEN a > 0 THEN a END AS ConsentedAnnualVolume, LowflowCondition FROM cons0)"""


@register("nullify_nonpositive", uses=("b_wap_allo", "b_consented"), sql=CONSENTED_SQL + """
--
SELECT * EXCLUDE (LowflowCondition) FROM cons""")
def nullify_nonpositive(t):
    """values <= 0 become null."""
    return _consented(t).drop("LowflowCondition")


@register("dropna_all", uses=("b_wap_allo", "b_consented"), sql=CONSENTED_SQL + """
--
SELECT RecordNumber, TakeType, ConsentedRate, ConsentedMultiDayVolume FROM cons
WHERE ConsentedRate IS NOT NULL OR ConsentedMultiDayVolume IS NOT NULL""")
def dropna_all(t):
    """drop rows with no rate and no multi-day volume."""
    return CL.drop_all_null(_consented(t), ["ConsentedRate", "ConsentedMultiDayVolume"]).select(
        "RecordNumber", "TakeType", "ConsentedRate", "ConsentedMultiDayVolume")


@register("flag_to_bool", uses=("b_wap_allo", "b_consented"), sql=f"""
fl AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('take_type')} AS TakeType,
  coalesce(upper({S.strip('LowflowCondition')}), 'NO') AS f FROM b_consented)
--
SELECT RecordNumber, TakeType,
  CASE CASE WHEN f = 'COMPLEX' THEN 'YES' ELSE f END WHEN 'YES' THEN true WHEN 'NO' THEN false END AS LowflowTakes,
  CASE WHEN f IN ('NO', 'YES') THEN f = 'YES' ELSE true END AS LowflowDiverts
FROM fl""")
def flag_to_bool(t):
    """Two Yes/No vocabularies."""
    c = t["b_consented"]
    return c.select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                    title_words(strip_ws("take_type")).alias("TakeType"),
                    CL.to_bool("LowflowCondition", "takes").alias("LowflowTakes"),
                    CL.to_bool("LowflowCondition", "diverts").alias("LowflowDiverts"))


@register("status_class", uses=("b_permit",), sql=S.PERMITS + """
--
SELECT RecordNumber, ConsentStatus, CASE WHEN ConsentStatus IN ('Issued - Active', 'Issued - Inactive', 'Issued - s124 Continuance') THEN 'active'
  WHEN ConsentStatus = 'Application in Process' THEN 'in_process' END AS StatusClass FROM permits""")
def status_class(t):
    """active / in-process class per permit."""
    p = clean_permits(t["b_permit"])
    return p.select("RecordNumber", "ConsentStatus", CL.status_class("ConsentStatus").alias("StatusClass"))


@register("limits_filter", uses=("b_limit", "b_limit_head"), sql=S.LIMITS_FLAT + """
--
SELECT id, count(DISTINCT spatialId) AS n_units, count(DISTINCT AllocationBlock || '|' || units) AS n_blocks
FROM lim_all GROUP BY id HAVING NOT (min(HydroGroup) = 'Surface Water' AND max(HydroGroup) = 'Surface Water')""")
def limits_filter(t):
    """operative, in force at the run date, with a spatial unit, allocation-block units, not SW-only."""
    from .q_domain import limit_files
    d = L.filter_limits(L.read_limits(t.spark, limit_files(t)), AS_OF, only_operative=True, only_gw=True)
    return d.select("id", F.size("spatialUnit").alias("n_units"), F.size("managementUnit").alias("n_blocks"))


# ---------------------------------------------------------------- cleaning

@register("clean_keys", uses=("b_wap_allo",), sql=f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, {S.key('WAP')} AS WAP FROM b_wap_allo""")
def clean_keys(t):
    """Strip + upper."""
    return CL.norm_key(t["b_wap_allo"], ["RecordNumber", "WAP"]).select("RecordNumber", "WAP")


@register("clean_labels", uses=("b_wap_allo",), sql=f"""
--
SELECT {S.label('take_type')} AS take_type, {S.label('FromMonth')} AS FromMonth, {S.label('ToMonth')} AS ToMonth,
  {S.label('IncludeInSwAllocation')} AS IncludeInSwAllocation FROM b_wap_allo""")
def clean_labels(t):
    """Strip + title."""
    cols = ["take_type", "FromMonth", "ToMonth", "IncludeInSwAllocation"]
    return CL.norm_label(t["b_wap_allo"], cols).select(*cols)


@register("validate_site_code", uses=("b_wap_allo",), sql=f"""
--
SELECT WAP AS RawWAP, CASE WHEN regexp_matches({S.key('WAP')}, {S.SITE_RE}) THEN {S.key('WAP')} END AS WAP FROM b_wap_allo""")
def validate_site_code(t):
    """Unanchored site-code pattern; non-matching -> null."""
    w = t["b_wap_allo"]
    return w.select(F.col("WAP").alias("RawWAP"), CL.validate_code(F.upper(strip_ws("WAP"))).alias("WAP"))


@register("recode_values", uses=("b_wap_allo", "b_allocated_volume"), sql=f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, CASE {S.strip('sw_allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('sw_allo_block')} END AS AllocationBlock FROM b_wap_allo
UNION ALL
SELECT {S.key('RecordNumber')}, CASE {S.strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {S.strip('allo_block')} END FROM b_allocated_volume""")
def recode_values(t):
    """C4: block recodes."""
    a = t["b_wap_allo"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                               CL.recode(strip_ws("sw_allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    b = t["b_allocated_volume"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                                       CL.recode(strip_ws("allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"))
    return a.unionByName(b)


@register("coerce_types", uses=("b_permit", "b_water_use"), sql=f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, try_cast(FromDate AS DATE) AS FromDate, try_cast(ToDate AS DATE) AS ToDate,
  round_even(CAST(NZTMX AS DOUBLE), 0) AS NZTMX FROM b_permit""")
def coerce_types(t):
    """Text -> date (bad -> null), number rounding."""
    p = CL.norm_key(t["b_permit"], ["RecordNumber"])
    p = CL.coerce_date(p, ["FromDate", "ToDate"])
    p = CL.coerce_numeric(p, ["NZTMX"], digits=0)
    return p.select("RecordNumber", "FromDate", "ToDate", "NZTMX")


@register("repair_dates", uses=("b_permit",), sql=f"""
r0 AS (SELECT {S.key('RecordNumber')} AS RecordNumber, try_cast(FromDate AS DATE) AS fd,
  CASE WHEN {S.strip('ConsentStatus')} = 'Issued - s124 Continuance' THEN CAST(try_cast(FromDate AS DATE) + INTERVAL 30 YEAR AS DATE) ELSE try_cast(ToDate AS DATE) END AS td
  FROM b_permit)
--
SELECT RecordNumber, coalesce(CASE WHEN fd < DATE '1950-01-01' THEN NULL ELSE fd END, DATE '1900-01-01') AS FromDate,
  coalesce(CASE WHEN td < DATE '1950-01-01' THEN NULL ELSE td END, DATE '1900-01-01') AS ToDate FROM r0""")
def repair_dates(t):
    """s124 +30 years, pre-1950 -> null, null -> 1900-01-01."""
    p = CL.norm_key(t["b_permit"], ["RecordNumber"])
    p = CL.strip_cols(p, ["ConsentStatus"])
    p = CL.coerce_date(p, ["FromDate", "ToDate"])
    p = CL.repair_dates(p, "ConsentStatus", "FromDate", "ToDate")
    return p.select("RecordNumber", "FromDate", "ToDate")


@register("fix_spacing", uses=("b_water_use",), sql=f"""
u AS (SELECT {S.key('RecordNumber')} AS RecordNumber, {S.label('UseType')} AS ut FROM b_water_use),
f AS (SELECT RecordNumber, CASE WHEN substr(ut, 4, 2) = '  ' THEN substr(ut, 1, 3) || substr(ut, 5) ELSE ut END AS UseType FROM u)
--
SELECT RecordNumber, UseType, replace(UseType, 'Use', 'Take') AS take_type FROM f""")
def fix_spacing_q(t):
    """C8 + C9: double space repaired at a fixed position, 'Use' -> 'Take'."""
    u = t["b_water_use"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
                                fix_spacing(title_words(strip_ws("UseType")), 3).alias("UseType"))
    return u.withColumn("take_type", replace_word("UseType", "Use", "Take"))


# FIXED VALUES (ours; the reference reads its use-type codes from a YAML not in its repository)
USE_CODES = {"Irrigation": ["ECONOMY", "STANDARD"], "Stockwater": ["SMALL", "MEDIUM"], "Industrial": ["LARGE", "PROMO"]}
USE_PRIORITIES = ["Industrial", "Irrigation", "Stockwater"]


def _use_case_sql(x: str) -> str:
    whens = " ".join(f"WHEN {x} IN ({', '.join(repr(c) for c in codes)}) THEN '{cls}'" for cls, codes in USE_CODES.items())
    return f"CASE {whens} END"


@register("rollup_codes", uses=("b_water_use",), sql=f"""
--
SELECT {S.key('RecordNumber')} AS RecordNumber, {_use_case_sql('WaterUse')} AS WaterUse FROM b_water_use""")
def rollup_codes(t):
    """Use codes rolled up to classes; an unknown code fails the job."""
    u = t["b_water_use"].select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"), "WaterUse")
    return CL.rollup_codes(u, "WaterUse", USE_CODES, strict=True)


# ---------------------------------------------------------------- scalar functions

@register("water_month", uses=("b_wap_allo",), sql=f"""
--
SELECT DISTINCT {S.label('FromMonth')} AS FromMonthName, {S.water_month(S.label('FromMonth'), 'Jul')} AS FromMonth,
  {S.label('ToMonth')} AS ToMonthName, {S.water_month(S.label('ToMonth'), 'Jun')} AS ToMonth FROM b_wap_allo""")
def water_month_q(t):
    """Month names -> water-year numbers (Jul = 1)."""
    w = t["b_wap_allo"].select(title_words(strip_ws("FromMonth")).alias("FromMonthName"),
                               title_words(strip_ws("ToMonth")).alias("ToMonthName"))
    return w.select("FromMonthName", water_month("FromMonthName", "Jul").alias("FromMonth"),
                    "ToMonthName", water_month("ToMonthName", "Jun").alias("ToMonth")).distinct()


@register("water_month_name", uses=("b_wap_allo",), sql=f"""
m AS (SELECT DISTINCT {S.water_month(S.label('ToMonth'), 'Jun')} AS MonthId FROM b_wap_allo)
--
SELECT MonthId, {S.month_name('MonthId', 'Jun')} AS MonthName, {S.month_name('MonthId + 12', 'Jul')} AS OutOfRange FROM m""")
def water_month_name_q(t):
    """Water-year numbers -> names, unmapped -> default."""
    m = t["b_wap_allo"].select(water_month(title_words(strip_ws("ToMonth")), "Jun").alias("MonthId")).distinct()
    return m.select("MonthId", water_month_name("MonthId", "Jun").alias("MonthName"),
                    water_month_name(F.col("MonthId") + 12, "Jul").alias("OutOfRange"))


@register("rate_volume_convert", uses=("b_wap_allo",), sql=f"""
w AS (SELECT {S.key('RecordNumber')} AS RecordNumber, WAP, CAST(VolumeDaily AS DOUBLE) AS VolumeDaily, CAST(VolumeWeekly AS DOUBLE) AS VolumeWeekly,
  CAST(Volume150Day AS DOUBLE) AS Volume150Day, AllocatedRate,
  {S.water_month(S.label('FromMonth'), 'Jul')} AS fm, {S.water_month(S.label('ToMonth'), 'Jun')} AS tm FROM b_wap_allo)
--
SELECT RecordNumber, WAP, (VolumeDaily / 24 / 60 / 60) * 1000 AS RateDaily, (VolumeWeekly / 7 / 24 / 60 / 60) * 1000 AS RateWeekly,
  (Volume150Day / 150 / 24 / 60 / 60) * 1000 AS Rate150Day,
  AllocatedRate * 0.001 * 60 * 60 * 24 * 30.42 * (CASE WHEN fm > tm THEN tm ELSE tm - fm + 1 END) AS SeasonVolume,
  AllocatedRate * 86400 * 0.001 * 365 AS AnnualVolume FROM w""")
def rate_volume_convert(t):
    """Volumes over 1/7/150 days -> l/s; rate -> season and annual volume."""
    w = t["b_wap_allo"]
    fm = water_month(title_words(strip_ws("FromMonth")), "Jul")
    tm = water_month(title_words(strip_ws("ToMonth")), "Jun")
    months = F.when(fm > tm, tm).otherwise(tm - fm + 1)
    return w.select(F.upper(strip_ws("RecordNumber")).alias("RecordNumber"), "WAP",
                    volume_to_rate(F.col("VolumeDaily").cast("double"), days=1).alias("RateDaily"),
                    volume_to_rate(F.col("VolumeWeekly").cast("double"), days=7).alias("RateWeekly"),
                    volume_to_rate(F.col("Volume150Day").cast("double"), days=150).alias("Rate150Day"),
                    rate_to_volume("AllocatedRate", months=months).alias("SeasonVolume"),
                    rate_to_volume("AllocatedRate", days=365).alias("AnnualVolume"))


@register("rounding", uses=("b_wap_allo",), sql="""
--
SELECT SD2, CAST(round_even(CAST(CAST(SD2 AS VARCHAR) AS DECIMAL(38, 18)), 1) AS DOUBLE) AS HalfEven1,
  CAST(floor(SD2) AS BIGINT) AS Floor, CAST(trunc(SD2) AS BIGINT) AS Trunc,
  CAST(round_even(CAST(CAST(SD2 AS VARCHAR) AS DECIMAL(38, 18)), 0) AS BIGINT) AS HalfEvenInt FROM b_wap_allo""")
def rounding(t):
    """Half-even (numpy round), floor, truncation."""
    w = t["b_wap_allo"]
    return w.select("SD2", half_even("SD2", 1).alias("HalfEven1"), F.floor("SD2").cast("bigint").alias("Floor"),
                    F.col("SD2").cast("bigint").alias("Trunc"), half_even("SD2", 0).cast("bigint").alias("HalfEvenInt"))


@register("string_funcs", uses=("b_site",), sql="""
--
SELECT ExtSiteID, contains(GwSpatialUnitId, 'CWAZ') AS Combined, substr(ExtSiteID, 1, 3) AS Prefix,
  regexp_replace(ExtSiteID, '/', '-') AS Dashed, printf('%s-%04d', SwSpatialUnitId, SD1_7Day) AS Label FROM b_site""")
def string_funcs(t):
    """Contains (the 'Combined' flag), substring, replace, format."""
    s = t["b_site"]
    return s.select("ExtSiteID", contains_text("GwSpatialUnitId", "CWAZ").alias("Combined"),
                    F.substring("ExtSiteID", 1, 3).alias("Prefix"),
                    F.regexp_replace("ExtSiteID", "/", "-").alias("Dashed"),
                    F.format_string("%s-%04d", "SwSpatialUnitId", "SD1_7Day").alias("Label"))


@register("date_funcs", uses=("b_permit",), sql=S.PERMITS + f"""
--
SELECT RecordNumber, CAST(FromDate + INTERVAL 30 YEAR AS DATE) AS Plus30Years, CAST(ToDate + INTERVAL 1 DAY AS DATE) AS NextDay,
  strftime(FromDate, '%Y-%m-%d') AS FromText, ToDate <= DATE '{AS_OF}' AS Expired FROM permits""")
def date_funcs(t):
    """+ years, + days, to text, compare to the run date (a parameter)."""
    p = clean_permits(t["b_permit"])
    return p.select("RecordNumber", D.add_years("FromDate", 30).alias("Plus30Years"), D.add_days("ToDate", 1).alias("NextDay"),
                    D.date_text("FromDate").alias("FromText"), D.on_or_before("ToDate", AS_OF).alias("Expired"))


@register("proportional_split", uses=("b_permit", "b_wap_allo"), sql="wa_clean AS (" + S.WAP_CLEAN.split("wa_clean AS (", 1)[1].split("take_rows AS (")[0].rstrip().rstrip(",") + """,
tot AS (SELECT RecordNumber, take_type, AllocationBlock, CAST(sum(CAST(WapRate AS DECIMAL(18, 2))) AS DOUBLE) AS total
  FROM wa_clean GROUP BY RecordNumber, take_type, AllocationBlock)
--
SELECT w.RecordNumber, w.take_type, w.AllocationBlock, w.WAP, w.WapRate,
  coalesce(w.WapRate / nullif(t.total, 0), 1.0) AS ShareV1, coalesce(w.WapRate / nullif(t.total, 0), 0.0) AS ShareV2
FROM wa_clean w JOIN tot t ON t.RecordNumber = w.RecordNumber AND t.take_type = w.take_type AND t.AllocationBlock = w.AllocationBlock""")
def proportional_split(t):
    """X9 + A5: share of the group total, default 1 (v1) or 0 (v2) when undefined."""
    wa = clean_wap_allo(t["b_wap_allo"])
    keys = ["RecordNumber", "take_type", "AllocationBlock"]
    tot = wa.groupBy(*keys).agg(F.sum(F.col("WapRate").cast(DecimalType(18, 2))).cast("double").alias("total"))
    j = wa.join(tot, keys)
    return j.select(*keys, "WAP", "WapRate", share("WapRate", "total", 1.0).alias("ShareV1"),
                    share("WapRate", "total", 0.0).alias("ShareV2"))


@register("json_field", sql="""
--
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_field_q(t):
    """Field of loose JSON text."""
    return t["events"].select("event_id", json_field("props", "$.k", "int").alias("k"))
