"""DuckDB building blocks for the oracle texts (SQL text helpers only)."""

from __future__ import annotations


def strip(x: str) -> str:
    return f"trim({x}, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def bround(x: str, n: int = 0) -> str:
    """Half-even rounding of a DOUBLE on its shortest decimal text, as Spark's
    ``bround`` does (DuckDB's ``round_even`` on DOUBLE can differ on halves)."""
    return f"CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def key(x: str) -> str:
    return f"upper({strip(x)})"


def label(x: str) -> str:
    return title(strip(x))


MONTHS = {"Jan": 7, "Feb": 8, "Mar": 9, "Apr": 10, "May": 11, "Jun": 12,
          "Jul": 1, "Aug": 2, "Sep": 3, "Oct": 4, "Nov": 5, "Dec": 6}


def water_month(x: str, default: str) -> str:
    v = f"CASE WHEN {x} = 'Migration: Not Classified' THEN '{default}' ELSE {x} END"
    whens = " ".join(f"WHEN '{k}' THEN {n}" for k, n in MONTHS.items())
    return f"(CASE {v} {whens} END)"


def month_name(x: str, default: str) -> str:
    whens = " ".join(f"WHEN {n} THEN '{k}'" for k, n in MONTHS.items())
    return f"(CASE {x} {whens} ELSE '{default}' END)"


SITE_RE = "'[A-Z]+\\d\\d/\\d\\d\\d\\d'"

# --- v1/v2 shared chain ----------------------------------------------------

PERMITS = f"""
permits_raw AS (
  SELECT {key('RecordNumber')} AS RecordNumber, {strip('ConsentStatus')} AS ConsentStatus,
    try_cast(FromDate AS DATE) AS fd0,
    CASE WHEN {strip('ConsentStatus')} = 'Issued - s124 Continuance'
         THEN CAST(try_cast(FromDate AS DATE) + INTERVAL 30 YEAR AS DATE) ELSE try_cast(ToDate AS DATE) END AS td0,
    round_even(CAST(NZTMX AS DOUBLE), 0) AS NZTMX, round_even(CAST(NZTMY AS DOUBLE), 0) AS NZTMY,
    {key('EcanID')} AS EcanID
  FROM b_permit),
permits_rep AS (
  SELECT RecordNumber, ConsentStatus,
    CASE WHEN fd0 < DATE '1950-01-01' THEN NULL ELSE fd0 END AS FromDate,
    CASE WHEN td0 < DATE '1950-01-01' THEN NULL ELSE td0 END AS ToDate, NZTMX, NZTMY, EcanID
  FROM permits_raw),
permits_dd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber ORDER BY FromDate NULLS LAST, ToDate NULLS LAST,
      ConsentStatus NULLS LAST, NZTMX NULLS FIRST, NZTMY NULLS FIRST, EcanID NULLS FIRST) AS rn FROM permits_rep) WHERE rn = 1),
permits AS (
  SELECT RecordNumber, ConsentStatus, coalesce(FromDate, DATE '1900-01-01') AS FromDate,
    coalesce(ToDate, DATE '1900-01-01') AS ToDate, NZTMX, NZTMY, EcanID
  FROM permits_dd WHERE ConsentStatus IS NOT NULL AND RecordNumber IS NOT NULL AND EcanID IS NOT NULL)"""

# the v2 pipeline takes dates as they are and keeps permits without EcanID
PERMITS_V2 = f"""
permits_raw AS (
  SELECT {key('RecordNumber')} AS RecordNumber, {strip('ConsentStatus')} AS ConsentStatus,
    try_cast(FromDate AS DATE) AS FromDate, try_cast(ToDate AS DATE) AS ToDate,
    round_even(CAST(NZTMX AS DOUBLE), 0) AS NZTMX, round_even(CAST(NZTMY AS DOUBLE), 0) AS NZTMY, {key('EcanID')} AS EcanID
  FROM b_permit WHERE RecordNumber IS NOT NULL),
permits AS (
  SELECT RecordNumber, ConsentStatus, coalesce(FromDate, DATE '1900-01-01') AS FromDate, coalesce(ToDate, DATE '1900-01-01') AS ToDate,
    NZTMX, NZTMY, EcanID
  FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber ORDER BY FromDate NULLS LAST, ToDate NULLS LAST,
      ConsentStatus NULLS LAST, NZTMX NULLS FIRST, NZTMY NULLS FIRST, EcanID NULLS FIRST) AS rn FROM permits_raw)
  WHERE rn = 1 AND ConsentStatus IS NOT NULL)"""

SITES = f"""
sites AS (SELECT * REPLACE ({key('ExtSiteID')} AS ExtSiteID) FROM b_site)"""

EDGES = f"""
edges0 AS (SELECT DISTINCT {key('ParentRecordNumber')} AS p, {key('ChildRecordNumber')} AS c FROM b_parent_child),
edges AS (SELECT p, c FROM edges0 WHERE p IS NOT NULL AND c IS NOT NULL
  AND p IN (SELECT RecordNumber FROM permits) AND c IN (SELECT RecordNumber FROM permits))"""

WAP_CLEAN = f"""
wa_clean AS (
  SELECT {key('RecordNumber')} AS RecordNumber, {label('take_type')} AS take_type,
    CASE {strip('sw_allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {strip('sw_allo_block')} END AS AllocationBlock,
    CASE WHEN regexp_matches({key('WAP')}, {SITE_RE}) THEN {key('WAP')} END AS WAP,
    round_even(CAST(AllocatedRate AS DOUBLE), 2) AS AllocatedRate,
    round_even(CAST(WapRate AS DOUBLE), 2) AS WapRate,
    CAST(trunc(CAST(VolumeDaily AS DOUBLE)) AS BIGINT) AS VolumeDaily,
    CAST(trunc(CAST(VolumeWeekly AS DOUBLE)) AS BIGINT) AS VolumeWeekly,
    CAST(Volume30Day AS DOUBLE) AS Volume30Day,
    CAST(trunc(CAST(Volume150Day AS DOUBLE)) AS BIGINT) AS Volume150Day,
    {water_month(label('FromMonth'), 'Jul')} AS FromMonth,
    {water_month(label('ToMonth'), 'Jun')} AS ToMonth,
    CAST(SD1 AS DOUBLE) AS SD1, CAST(SD2 AS DOUBLE) AS SD2,
    coalesce({label('IncludeInSwAllocation')} <> 'No', true) AS IncludeInSwAllocation
  FROM b_wap_allo),
take_rows AS (
  SELECT * FROM wa_clean
  WHERE RecordNumber IN (SELECT RecordNumber FROM permits)
    AND (WAP IS NULL OR WAP IN (SELECT ExtSiteID FROM sites)))"""

HFILL = """
h_seeds AS (SELECT DISTINCT RecordNumber AS seed FROM take_rows WHERE WAP IS NULL),
h_known AS (SELECT DISTINCT RecordNumber AS node, WAP AS val FROM take_rows WHERE WAP IS NOT NULL),
h_walk(seed, node, depth) AS (
  SELECT s.seed, e.c, 1 FROM h_seeds s JOIN edges e ON e.p = s.seed WHERE e.c <> s.seed
  UNION
  SELECT w.seed, e.c, w.depth + 1 FROM h_walk w JOIN edges e ON e.p = w.node
  WHERE w.depth <= (SELECT count(*) FROM edges) AND e.c <> w.seed),
h_hits AS (SELECT w.seed, w.depth, k.val FROM h_walk w JOIN h_known k ON k.node = w.node),
h_fill AS (SELECT seed, min(val) AS val FROM h_hits h
  WHERE depth = (SELECT min(depth) FROM h_hits h2 WHERE h2.seed = h.seed) GROUP BY seed),
take_filled AS (
  SELECT t.* REPLACE (coalesce(f.val, t.WAP) AS WAP) FROM take_rows t LEFT JOIN h_fill f ON f.seed = t.RecordNumber)"""

def mean2(x: str) -> str:
    """Half-even mean to 2 digits on exact values (inputs to 6 decimals, integer
    arithmetic), so exact halves round to even in any summation order."""
    num = f"sum(CAST(round(CAST({x} AS DOUBLE) * 1000000) AS HUGEINT))"
    den = f"(count({x}) * 10000)"
    q = f"({num} // {den})"
    r = f"({num} - {q} * {den})"
    return (f"CAST({q} + CASE WHEN 2 * {r} > {den} THEN 1 WHEN 2 * {r} = {den} THEN {q} % 2 ELSE 0 END AS DOUBLE) / 100")


SEASONS = f"""
season_months AS (
  SELECT *, unnest(CASE WHEN FromMonth > ToMonth THEN range(1, ToMonth + 1) ELSE range(FromMonth, ToMonth + 1) END) AS Month
  FROM take_filled WHERE WAP IS NOT NULL),
seasons AS (
  SELECT RecordNumber, take_type, AllocationBlock, WAP,
    {mean2('WapRate')} AS WapRate, {mean2('AllocatedRate')} AS AllocatedRate,
    {mean2('VolumeDaily')} AS VolumeDaily, {mean2('VolumeWeekly')} AS VolumeWeekly,
    {mean2('Volume30Day')} AS Volume30Day, {mean2('Volume150Day')} AS Volume150Day,
    {mean2('SD1')} AS SD1, {mean2('SD2')} AS SD2,
    min(Month) AS FromMonth, max(Month) AS ToMonth,
    (array_agg(IncludeInSwAllocation ORDER BY FromMonth, ToMonth, IncludeInSwAllocation))[1] AS IncludeInSwAllocation
  FROM season_months GROUP BY RecordNumber, take_type, AllocationBlock, WAP)"""

V2_INPUTS = f"""
waps AS (SELECT ExtSiteID AS Wap, coalesce(SD1_7Day, 0) AS SD1_7Day, coalesce(SD1_150Day, 0) AS SD1_150Day,
  coalesce(Storativity, false) AS Storativity, GwSpatialUnitId, SwSpatialUnitId, coalesce(Combined, false) AS Combined FROM sites),
lowflow AS (
  SELECT {key('RecordNumber')} AS RecordNumber, {label('take_type')} AS TakeType,
    CASE CASE coalesce(upper({strip('LowflowCondition')}), 'NO') WHEN 'COMPLEX' THEN 'YES' ELSE coalesce(upper({strip('LowflowCondition')}), 'NO') END
      WHEN 'YES' THEN true WHEN 'NO' THEN false END AS LowflowCondition
  FROM b_consented),
inp0 AS (
  SELECT s.RecordNumber, s.take_type AS TakeType, s.AllocationBlock, s.WAP AS Wap, s.AllocatedRate,
    s.VolumeDaily, s.VolumeWeekly, s.Volume150Day, s.FromMonth, s.ToMonth, s.IncludeInSwAllocation,
    w.SD1_7Day, w.SD1_150Day, w.Storativity, w.Combined, coalesce(c.LowflowCondition, false) AS LowflowCondition
  FROM seasons s JOIN waps w ON w.Wap = s.WAP
  LEFT JOIN lowflow c ON c.RecordNumber = s.RecordNumber AND c.TakeType = s.take_type),
inp1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, AllocationBlock, Wap ORDER BY TakeType) AS rn FROM inp0) WHERE rn = 1),
inp2 AS (SELECT *, (VolumeDaily / 24 / 60 / 60) * 1000 AS RateDaily, (VolumeWeekly / 7 / 24 / 60 / 60) * 1000 AS RateWeekly,
  (Volume150Day / 150 / 24 / 60 / 60) * 1000 AS Rate150Day FROM inp1),
inputs AS (
  SELECT *, CAST(CASE sd_cat WHEN 'low' THEN 0.0 WHEN 'moderate' THEN 0.5 WHEN 'high' THEN 0.75 ELSE 1.0 END AS DOUBLE) AS sw_vol_ratio
  FROM (SELECT *, CASE WHEN TakeType = 'Take Surface Water' THEN 'direct' WHEN SD1_7Day >= 90 THEN 'direct'
      WHEN SD1_150Day >= 60 THEN 'high' WHEN (Rate150Day * (SD1_150Day * CAST(0.01 AS DOUBLE))) > 5 OR SD1_150Day >= 40 THEN 'moderate'
      ELSE 'low' END AS sd_cat FROM inp2))"""


def v2_rates(alt: bool = False) -> str:
    if alt:
        alt_bool = ("((sd_cat = 'moderate' AND Storativity) OR sd_cat = 'high' OR (sd_cat = 'moderate' AND Combined))")
    else:
        alt_bool = ("(((Storativity OR LowflowCondition) AND sd_cat IN ('moderate', 'high')) OR Combined)")
    return f"""
rates_wide AS (
  SELECT RecordNumber, AllocationBlock, Wap,
    CAST(CASE WHEN {alt_bool} THEN Rate150Day - (CASE WHEN sd_cat IN ('moderate', 'high') THEN Rate150Day * (SD1_150Day * CAST(0.01 AS DOUBLE)) ELSE 0.0 END)
         WHEN TakeType = 'Take Groundwater' THEN Rate150Day ELSE 0.0 END AS DOUBLE) AS gw,
    CAST(CASE WHEN TakeType = 'Take Surface Water' THEN AllocatedRate
         WHEN sd_cat = 'direct' AND TakeType = 'Take Groundwater' THEN RateDaily
         WHEN sd_cat IN ('moderate', 'high') THEN Rate150Day * (SD1_150Day * CAST(0.01 AS DOUBLE)) ELSE 0.0 END AS DOUBLE) AS sw
  FROM inputs),
rates AS (
  SELECT RecordNumber, AllocationBlock, Wap, 'Groundwater' AS HydroGroup, gw AS AllocatedRate FROM rates_wide WHERE gw IS NOT NULL
  UNION ALL
  SELECT RecordNumber, AllocationBlock, Wap, 'Surface Water', sw FROM rates_wide WHERE sw IS NOT NULL)"""


def v2_volumes(alt: bool = False) -> str:
    if alt:
        disc = ("((sd_cat = 'moderate' AND Storativity) OR (sd_cat = 'moderate' AND Combined) OR sd_cat = 'high' OR sd_cat = 'direct')")
    else:
        disc = "(((Storativity OR LowflowCondition) AND sd_cat IN ('moderate', 'high', 'direct')) OR Combined)"
    return f"""
av0 AS (
  SELECT {key('RecordNumber')} AS RecordNumber, {label('take_type')} AS TakeType, {strip('allo_block')} AS raw_block,
    CASE {strip('allo_block')} WHEN 'Migration: Not Classified' THEN 'A' WHEN 'In Waitaki' THEN 'A' ELSE {strip('allo_block')} END AS AllocationBlock,
    CAST(trunc(CAST(FullAnnualVolume AS DOUBLE)) AS BIGINT) AS FullAnnualVolume,
    coalesce({label('IncludeInGwAllocation')} <> 'No', true) AS IncludeInGwAllocation
  FROM b_allocated_volume),
volumes AS (SELECT RecordNumber, TakeType, AllocationBlock, FullAnnualVolume, IncludeInGwAllocation FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber, TakeType, AllocationBlock ORDER BY raw_block) AS rn FROM av0) WHERE rn = 1),
ar AS (
  SELECT RecordNumber, TakeType, Wap, sum(Rate150Day) AS Rate150Day,
    arg_min(Storativity, AllocationBlock) AS Storativity, arg_min(Combined, AllocationBlock) AS Combined,
    arg_min(sd_cat, AllocationBlock) AS sd_cat, arg_min(sw_vol_ratio, AllocationBlock) AS sw_vol_ratio,
    arg_min(LowflowCondition, AllocationBlock) AS LowflowCondition
  FROM inputs GROUP BY RecordNumber, TakeType, Wap),
vj AS (SELECT v.*, ar.Wap, ar.Rate150Day, ar.Storativity, ar.Combined, ar.sd_cat, ar.sw_vol_ratio, ar.LowflowCondition,
    sum(ar.Rate150Day) OVER (PARTITION BY v.RecordNumber, v.TakeType) AS agg
  FROM volumes v JOIN ar ON ar.RecordNumber = v.RecordNumber AND ar.TakeType = v.TakeType),
vr AS (SELECT *, round_even(FullAnnualVolume * coalesce(Rate150Day / nullif(agg, 0), 0.0), 0) AS FullVol FROM vj),
vw AS (SELECT RecordNumber, AllocationBlock, Wap, TakeType, IncludeInGwAllocation,
    CAST(CASE WHEN {disc} THEN FullVol - FullVol * sw_vol_ratio WHEN TakeType = 'Take Surface Water' THEN 0.0 ELSE FullVol END AS DOUBLE) AS gw,
    CAST(FullVol * sw_vol_ratio AS DOUBLE) AS sw FROM vr),
vlong AS (
  SELECT RecordNumber, AllocationBlock, Wap, TakeType, IncludeInGwAllocation, 'Groundwater' AS HydroGroup, gw AS AllocatedAnnualVolume FROM vw WHERE gw IS NOT NULL
  UNION ALL
  SELECT RecordNumber, AllocationBlock, Wap, TakeType, IncludeInGwAllocation, 'Surface Water', sw FROM vw WHERE sw IS NOT NULL),
vols AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, HydroGroup, AllocationBlock, Wap ORDER BY TakeType) AS rn FROM vlong) WHERE rn = 1)"""


ALLOC = """
rv0 AS (
  SELECT coalesce(r.RecordNumber, v.RecordNumber) AS RecordNumber, coalesce(r.HydroGroup, v.HydroGroup) AS HydroGroup,
    coalesce(r.AllocationBlock, v.AllocationBlock) AS AllocationBlock, coalesce(r.Wap, v.Wap) AS Wap,
    r.AllocatedRate, v.AllocatedAnnualVolume, v.IncludeInGwAllocation AS gw_inc
  FROM rates r FULL JOIN vols v ON r.RecordNumber = v.RecordNumber AND r.HydroGroup = v.HydroGroup
    AND r.AllocationBlock = v.AllocationBlock AND r.Wap = v.Wap),
mon AS (SELECT RecordNumber, Wap, min(FromMonth) AS FromMonth, max(ToMonth) AS ToMonth FROM inputs GROUP BY RecordNumber, Wap),
rv1 AS (
  SELECT rv0.*, mon.FromMonth, mon.ToMonth, i.IncludeInSwAllocation AS sw_inc
  FROM rv0 JOIN mon ON mon.RecordNumber = rv0.RecordNumber AND mon.Wap = rv0.Wap
  LEFT JOIN inputs i ON i.RecordNumber = rv0.RecordNumber AND i.AllocationBlock = rv0.AllocationBlock AND i.Wap = rv0.Wap
  WHERE (rv0.RecordNumber, rv0.Wap) IN (SELECT (RecordNumber, Wap) FROM vj)),
rv2 AS (
  SELECT *,
    coalesce(AllocatedAnnualVolume, round_even(AllocatedRate * 0.001 * 60 * 60 * 24 * 30.42 * (ToMonth - FromMonth + 1), 0)) AS vol,
    coalesce(AllocatedRate, CAST(floor(AllocatedAnnualVolume / 60 / 60 / 24 / 30.42 / (ToMonth - FromMonth + 1) * 1000) AS DOUBLE)) AS rate
  FROM rv1
  WHERE (HydroGroup = 'Surface Water' OR coalesce(gw_inc, true)) AND (HydroGroup <> 'Surface Water' OR coalesce(sw_inc, true))),
allocation AS (
  SELECT rv2.RecordNumber, rv2.HydroGroup, rv2.AllocationBlock, rv2.Wap, w.GwSpatialUnitId, w.SwSpatialUnitId,
    CASE WHEN rv2.HydroGroup = 'Groundwater' OR w.Combined THEN w.GwSpatialUnitId ELSE w.SwSpatialUnitId END AS SpatialUnitId,
    w.Combined, p.ConsentStatus, p.FromDate, p.ToDate, CAST(rv2.FromMonth AS INTEGER) AS FromMonth, CAST(rv2.ToMonth AS INTEGER) AS ToMonth,
    CAST(round_even(coalesce(rv2.rate, 0.0), 0) AS BIGINT) AS AllocatedRate,
    CAST(round_even(coalesce(rv2.vol, 0.0), 0) AS BIGINT) AS AllocatedAnnualVolume
  FROM rv2 JOIN permits p ON p.RecordNumber = rv2.RecordNumber JOIN waps w ON w.Wap = rv2.Wap
  WHERE rv2.vol > 0 OR rv2.rate > 0)"""


def gw_zone(in_process_is_active: bool = False) -> str:
    act = "('Issued - Active', 'Issued - Inactive', 'Issued - s124 Continuance'" + (
        ", 'Application in Process')" if in_process_is_active else ")")
    return f"""
gw_zone AS (
  SELECT SpatialUnitId, AllocationBlock,
    sum(CASE WHEN ConsentStatus IN {act} THEN AllocatedAnnualVolume END) AS AllocatedVolume,
    sum(CASE WHEN ConsentStatus = 'Application in Process' THEN AllocatedAnnualVolume END) AS NewAllocationInProgress
  FROM allocation
  WHERE (HydroGroup = 'Groundwater' OR Combined) AND SpatialUnitId IS NOT NULL
    AND ConsentStatus IN ('Issued - Active', 'Issued - Inactive', 'Issued - s124 Continuance', 'Application in Process')
  GROUP BY SpatialUnitId, AllocationBlock)"""


def ffill(src: str, keys: str, month: str, value: str, name: str) -> str:
    """Sum per (keys, month), densify 1..12, forward fill, drop leading gaps."""
    k = ", ".join(f"s.{x.strip()}" for x in keys.split(","))
    kk = " AND ".join(f"g.{x.strip()} = s.{x.strip()}" for x in keys.split(","))
    return f"""
{name}_sum AS (SELECT {keys}, {month} AS m, sum({value}) AS v FROM {src} GROUP BY {keys}, {month}),
{name}_keys AS (SELECT DISTINCT {keys} FROM {name}_sum),
{name} AS (
  SELECT {k}, CAST(g.mm AS INTEGER) AS Month,
    CAST((SELECT x.v FROM {name}_sum x WHERE {" AND ".join(f"x.{y.strip()} = s.{y.strip()}" for y in keys.split(","))} AND x.m <= g.mm ORDER BY x.m DESC LIMIT 1) AS DOUBLE) AS {value}
  FROM {name}_keys s JOIN (SELECT {keys}, unnest(range(1, 13)) AS mm FROM {name}_keys) g ON {kk}
)"""


LIMITS_FLAT = """
lim_docs AS (SELECT * FROM b_limit_head WHERE status = 'Operative' AND CAST(fromDate AS DATE) <= DATE '2020-07-01' AND has_unit),
lim_all AS (SELECT d.id, l.* EXCLUDE (id) FROM lim_docs d JOIN b_limit l ON l.id = d.id % 1000),
lim_units AS (SELECT DISTINCT id, spatialId, HydroGroup FROM lim_all),
lim_joint AS (SELECT id, count(*) AS unit_count, string_agg(spatialId, ', ' ORDER BY spatialId) AS ju
  FROM (SELECT DISTINCT id, spatialId FROM lim_units) GROUP BY id),
lim_hydro AS (SELECT id, count(*) AS hydro_count FROM (SELECT DISTINCT id, HydroGroup FROM lim_units) GROUP BY id),
lim_notes AS (
  SELECT u.id, u.spatialId, u.HydroGroup,
    CASE WHEN coalesce(h.hydro_count, 1) > 1 AND j.unit_count > 1
           THEN 'Allocation limits for this allocation zone are combined between surface water and groundwater. The allocation limits are shared jointly across these zones: ' || j.ju
         WHEN j.unit_count > 1 THEN ' The allocation limits are shared jointly across these zones: ' || j.ju
         WHEN coalesce(h.hydro_count, 1) > 1 THEN 'Allocation limits for this allocation zone are combined between surface water and groundwater. '
         ELSE '' END AS notes
  FROM lim_units u LEFT JOIN lim_joint j ON j.id = u.id LEFT JOIN lim_hydro h ON h.id = u.id),
lim_flat AS (SELECT DISTINCT id, AllocationBlock, units, AllocationLimit AS lim, fromMonth FROM lim_all),
gw_notes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spatialId ORDER BY id, notes) AS rn
  FROM lim_notes WHERE HydroGroup = 'Groundwater') WHERE rn = 1),
gw_limits AS (
  SELECT n.id AS ManagementGroupId, n.spatialId AS SpatialUnitId, f.AllocationBlock, d.Name, d.PlanName, d.PlanSection, d.PlanTable,
    f.lim AS AllocationLimit, f.units AS Units, n.notes AS Notes, TIMESTAMP '2020-07-01 00:00:00' AS EffectiveFromDate
  FROM gw_notes n JOIN lim_flat f ON f.id = n.id JOIN lim_docs d ON d.id = n.id)"""


# --- v1 chain ---------------------------------------------------------------

MONTHS_SQL = """
months AS (SELECT RecordNumber, take_type, WAP, min(FromMonth) AS FromMonth, max(ToMonth) AS ToMonth,
  count(*) OVER (PARTITION BY RecordNumber, take_type) AS wap_count
  FROM take_filled WHERE WAP IS NOT NULL GROUP BY RecordNumber, take_type, WAP)"""

ARV_SQL = f"""
arv_j AS (SELECT v.RecordNumber, v.TakeType, v.AllocationBlock, v.FullAnnualVolume, v.IncludeInGwAllocation, s.WAP, s.WapRate,
    s.AllocatedRate, s.SD1, s.FromMonth, s.ToMonth, s.IncludeInSwAllocation,
    CAST(sum(CAST(s.WapRate AS DECIMAL(18, 2))) OVER (PARTITION BY v.RecordNumber, v.TakeType, v.AllocationBlock) AS DOUBLE) AS agg
  FROM volumes v JOIN seasons s ON s.RecordNumber = v.RecordNumber AND s.take_type = v.TakeType AND s.AllocationBlock = v.AllocationBlock),
arv_r AS (SELECT * REPLACE ({bround('FullAnnualVolume * coalesce(WapRate / nullif(agg, 0), 1.0)')} AS FullAnnualVolume) FROM arv_j),
arv_s AS (SELECT RecordNumber, AllocationBlock, WAP, FromMonth, ToMonth, IncludeInSwAllocation, IncludeInGwAllocation,
    CASE WHEN TakeType = 'Take Groundwater' THEN SD1 WHEN TakeType = 'Take Surface Water' THEN AllocatedRate ELSE 0.0 END AS sw_rate,
    CASE WHEN TakeType = 'Take Groundwater' THEN AllocatedRate - SD1 ELSE 0.0 END AS gw_rate,
    CASE WHEN TakeType = 'Take Groundwater' THEN (SD1 / nullif(AllocatedRate, 0)) * FullAnnualVolume
         WHEN TakeType = 'Take Surface Water' THEN CAST(FullAnnualVolume AS DOUBLE) ELSE 0.0 END AS sw_vol,
    CASE WHEN TakeType = 'Take Groundwater' THEN ((AllocatedRate - SD1) / nullif(AllocatedRate, 0)) * FullAnnualVolume ELSE 0.0 END AS gw_vol
  FROM arv_r WHERE FullAnnualVolume >= 0),
arv_rows AS (
  SELECT RecordNumber, AllocationBlock, WAP, FromMonth, ToMonth, 'Surface Water' AS HydroGroup, coalesce(sw_rate, 0.0) AS r, coalesce(sw_vol, 0.0) AS v
  FROM arv_s WHERE IncludeInSwAllocation
  UNION ALL
  SELECT RecordNumber, AllocationBlock, WAP, FromMonth, ToMonth, 'Groundwater', coalesce(gw_rate, 0.0), coalesce(gw_vol, 0.0)
  FROM arv_s WHERE IncludeInGwAllocation),
arv_v AS (SELECT * REPLACE (CASE WHEN v = 0 THEN r * 0.001 * 60 * 60 * 24 * 30.42 * (ToMonth - FromMonth + 1) ELSE v END AS v)
  FROM arv_rows WHERE v > 0 OR r > 0),
arv_w AS (SELECT * REPLACE (CASE WHEN r = 0 THEN v / 60 / 60 / 24 / 30.42 / (ToMonth - FromMonth + 1) * 1000 ELSE r END AS r) FROM arv_v),
arv AS (SELECT RecordNumber, AllocationBlock, HydroGroup, WAP, FromMonth, ToMonth,
  CAST({bround('r')} AS BIGINT) AS AllocatedRate, CAST({bround('v')} AS BIGINT) AS AllocatedAnnualVolume FROM arv_w)"""

CRV_SQL = f"""
crv0 AS (SELECT {key('RecordNumber')} AS RecordNumber, {label('take_type')} AS take_type,
    {bround('CAST(ConsentedAnnualVolume AS DOUBLE)')} AS a, {bround('CAST(ConsentedMultiDayVolume AS DOUBLE)')} AS v,
    {bround('CAST(ConsentedMultiDayPeriod AS DOUBLE)')} AS p, CAST(ConsentedRate AS DOUBLE) AS r FROM b_consented),
crv1 AS (SELECT RecordNumber, take_type, CASE WHEN a > 0 THEN a END AS ConsentedAnnualVolume, CASE WHEN v > 0 THEN v END AS ConsentedMultiDayVolume,
    CASE WHEN p > 0 THEN p END AS ConsentedMultiDayPeriod, CASE WHEN r > 0 THEN r END AS ConsentedRate FROM crv0),
crv AS (SELECT c.RecordNumber, c.take_type, m.WAP, {bround('c.ConsentedRate / m.wap_count', 2)} AS ConsentedRate,
    {bround('c.ConsentedMultiDayVolume / m.wap_count')} AS ConsentedMultiDayVolume, c.ConsentedMultiDayPeriod,
    {bround('c.ConsentedAnnualVolume / m.wap_count')} AS ConsentedAnnualVolume, m.FromMonth, m.ToMonth
  FROM crv1 c JOIN months m ON m.RecordNumber = c.RecordNumber AND m.take_type = c.take_type
  WHERE c.ConsentedRate IS NOT NULL AND c.RecordNumber IN (SELECT RecordNumber FROM permits))"""


def uses_sql(codes_case: str, priorities: list) -> str:
    fixed = f"CASE WHEN substr({label('UseType')}, 4, 2) = '  ' THEN substr({label('UseType')}, 1, 3) || substr({label('UseType')}, 5) ELSE {label('UseType')} END"
    return f"""
wu0 AS (SELECT {key('RecordNumber')} AS RecordNumber, {fixed} AS UseType, WaterUse, IrrigationArea,
    {bround('CAST(ConsentedRate AS DOUBLE)', 2)} AS r FROM b_water_use),
wu1 AS (SELECT RecordNumber, UseType, WaterUse, IrrigationArea, CASE WHEN r > 0 THEN r END AS ConsentedRate, replace(UseType, 'Use', 'Take') AS take_type
  FROM wu0 WHERE RecordNumber IN (SELECT RecordNumber FROM permits)),
wu2 AS (SELECT w.RecordNumber, w.UseType, {codes_case} AS WaterUse, w.IrrigationArea, {bround('w.ConsentedRate / m.wap_count', 2)} AS ConsentedRate, m.WAP
  FROM wu1 w JOIN months m ON m.RecordNumber = w.RecordNumber AND m.take_type = w.take_type WHERE m.WAP IN (SELECT ExtSiteID FROM sites)),
wu3 AS (SELECT *, coalesce(list_position({priorities!r}, WaterUse), {len(priorities) + 1}) AS prio FROM wu2),
uses AS (SELECT RecordNumber, UseType, WaterUse, IrrigationArea, ConsentedRate, WAP FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber, UseType, WAP ORDER BY prio, IrrigationArea NULLS LAST, WaterUse NULLS FIRST,
    IrrigationArea NULLS FIRST, ConsentedRate NULLS FIRST, prio) AS rn FROM wu3) WHERE rn = 1)"""


TRIG_SQL = """
trig AS (SELECT RecordNumber, ExtSiteID, BandNumber, MinAllocation, MaxAllocation FROM (
  SELECT *, row_number() OVER (PARTITION BY RecordNumber, ExtSiteID ORDER BY IsActive DESC NULLS LAST, MinAllocation NULLS LAST,
    BandNumber NULLS LAST, MaxAllocation NULLS FIRST) AS rn FROM b_trigger) WHERE rn = 1),
allo AS (SELECT DISTINCT RecordNumber, AllocationBlock, HydroGroup FROM arv),
swb AS (SELECT DISTINCT RecordNumber, AllocationBlock FROM allo WHERE HydroGroup = 'Surface Water' AND AllocationBlock <> 'In Waitaki'),
lowflow_cond AS (
  SELECT s.RecordNumber, s.AllocationBlock, t.ExtSiteID, t.BandNumber, t.MinAllocation, t.MaxAllocation FROM swb s JOIN trig t ON t.RecordNumber = s.RecordNumber
  UNION ALL
  SELECT n.RecordNumber, '9', t.ExtSiteID, t.BandNumber, t.MinAllocation, t.MaxAllocation
  FROM (SELECT DISTINCT RecordNumber FROM allo WHERE RecordNumber NOT IN (SELECT RecordNumber FROM swb)) n JOIN trig t ON t.RecordNumber = n.RecordNumber)"""


def restr_sql(run_date: str, start: str) -> str:
    return f"""
valid AS (SELECT RecordNumber, FromDate, ToDate FROM permits WHERE FromDate < DATE '{run_date}' AND ToDate > DATE '{start}'),
feed AS (SELECT l.ExtSiteID, l.RestrDate, l.Allocation, t.RecordNumber, t.BandNumber FROM b_site_log l
  JOIN (SELECT DISTINCT RecordNumber, ExtSiteID, BandNumber FROM b_trigger) t ON t.ExtSiteID = l.ExtSiteID
  WHERE l.RestrDate BETWEEN DATE '{start}' AND DATE '{run_date}' AND t.RecordNumber IN (SELECT RecordNumber FROM valid)),
fv AS (SELECT f.* FROM feed f JOIN valid v ON v.RecordNumber = f.RecordNumber AND f.RestrDate BETWEEN v.FromDate AND v.ToDate),
rj AS (SELECT fv.RecordNumber, fv.ExtSiteID, fv.BandNumber, fv.RestrDate, fv.Allocation, c.AllocationBlock FROM fv
  JOIN lowflow_cond c ON c.RecordNumber = fv.RecordNumber AND c.ExtSiteID = fv.ExtSiteID AND c.BandNumber = fv.BandNumber),
restr AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY RecordNumber, AllocationBlock, ExtSiteID, RestrDate
  ORDER BY BandNumber NULLS LAST, BandNumber NULLS FIRST, Allocation NULLS FIRST) AS rn FROM rj) WHERE rn = 1)"""


EDGES_POLY = """
zv AS (SELECT zone_id, seq, x, y, max(seq) OVER (PARTITION BY zone_id) AS mx, min(seq) OVER (PARTITION BY zone_id) AS mn FROM b_zone_vertex),
ze AS (SELECT a.zone_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM zv a JOIN zv b ON b.zone_id = a.zone_id
  AND b.seq = CASE WHEN a.seq = a.mx THEN a.mn ELSE a.seq + 1 END),
zhits AS (SELECT s.ExtSiteID, ze.zone_id,
    sum(CASE WHEN ((ze.y1 > s.py) <> (ze.y2 > s.py)) AND s.px < ze.x1 + (s.py - ze.y1) * (ze.x2 - ze.x1) / nullif(ze.y2 - ze.y1, 0) THEN 1 ELSE 0 END) AS n
  FROM (SELECT ExtSiteID, CAST(NZTMX AS DOUBLE) AS px, CAST(NZTMY AS DOUBLE) AS py FROM b_site) s, ze GROUP BY s.ExtSiteID, ze.zone_id),
pip AS (SELECT ExtSiteID, min(zone_id) AS zone_id FROM zhits WHERE n % 2 = 1 GROUP BY ExtSiteID)"""

NEAREST = """
nv_all AS (SELECT s.ExtSiteID, v.vertex_id, v.reach_id,
    sqrt((CAST(s.NZTMX AS DOUBLE) - v.x) * (CAST(s.NZTMX AS DOUBLE) - v.x) + (CAST(s.NZTMY AS DOUBLE) - v.y) * (CAST(s.NZTMY AS DOUBLE) - v.y)) AS d
  FROM b_site s, b_reach_vertex v),
nearest AS (SELECT ExtSiteID, arg_min(vertex_id, (d, vertex_id)) AS vertex_id, arg_min(reach_id, (d, vertex_id)) AS reach_id, min(d) AS distance
  FROM nv_all GROUP BY ExtSiteID)"""
