"""Bindings B1-B14: the driver's star-schema tables seen as permit tables.

Each binding is one SQL template over the base tables (and earlier bindings).
Spark runs it through ``spark.sql(template, name=DataFrame)``; the DuckDB
oracle runs the same text as a CTE. Two bindings (B12, B13) expand a fixed
value list; Spark does that with ``explode``/``inline`` (a generator, no join)
and the DuckDB text uses ``unnest``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_MONTHS3 = "'JanFebMarAprMayJunJulAugSepOctNovDec'"

# A site is a pair of supplier and part, so sites grow with the tables: letters for the supplier's hundreds and two digits
# for the rest, then the part with four digits at least.
_SITE = ("translate(CAST(CAST(floor(l_suppkey / 100) AS BIGINT) AS STRING), '0123456789', 'ABCDEFGHIJ') || lpad(CAST(l_suppkey % 100 AS STRING), 2, '0') || '/' || "
         "CASE WHEN l_partkey < 10000 THEN lpad(CAST(l_partkey AS STRING), 4, '0') ELSE CAST(l_partkey AS STRING) END")

_SQL: dict[str, str] = {
    "b_permit": """
SELECT ' crc' || CAST(o_orderkey AS STRING) || ' ' AS RecordNumber,
    CASE o_orderstatus WHEN 'F' THEN 'Issued - Active' WHEN 'O' THEN 'Application in Process' ELSE 'Issued - s124 Continuance' END AS ConsentStatus,
    CASE WHEN o_orderkey % 50 = 0 THEN 'not a date' WHEN o_orderkey % 50 = 1 THEN '1949-06-30' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS FromDate,
    CAST(CAST(o_orderdate + INTERVAL '24' MONTH AS DATE) AS STRING) AS ToDate,
    1400000 + o_custkey * 10.5 AS NZTMX,
    5100000 + o_custkey * 10.5 AS NZTMY,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'ec' || CAST(o_custkey AS STRING) END AS EcanID
FROM {orders}""",
    "b_wap_allo": f"""
SELECT ' crc' || CAST(l_orderkey AS STRING) AS RecordNumber,
    CASE l_linestatus WHEN 'F' THEN 'take groundwater ' ELSE ' TAKE SURFACE WATER' END AS take_type,
    CASE l_returnflag WHEN 'A' THEN ' A' WHEN 'N' THEN 'Migration: Not Classified' ELSE 'B' END AS sw_allo_block,
    CASE WHEN l_partkey % 20 = 0 THEN CAST(NULL AS STRING) WHEN l_partkey % 20 = 1 THEN 'bad code' ELSE ' l' || lower({_SITE}) END AS WAP,
    l_quantity AS AllocatedRate,
    CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_quantity END AS WapRate,
    floor(l_extendedprice / 10) AS VolumeDaily,
    floor(l_extendedprice * 7 / 20) AS VolumeWeekly,
    floor(l_extendedprice * 30 / 20) AS Volume30Day,
    floor(l_extendedprice * 150 / 20) AS Volume150Day,
    substr({_MONTHS3}, CAST((month(l_shipdate) - 1) * 3 + 1 AS INT), 3) AS FromMonth,
    CASE WHEN l_partkey % 33 = 0 THEN 'Migration: Not Classified' ELSE substr({_MONTHS3}, CAST(((month(l_shipdate) - 1 + l_linenumber) % 12) * 3 + 1 AS INT), 3) END AS ToMonth,
    l_quantity * l_discount * 10 AS SD1,
    l_quantity * l_tax AS SD2,
    CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.04 THEN ' no' ELSE 'yes' END AS IncludeInSwAllocation
FROM {{lineitem}}""",
    "b_allocated_volume": """
SELECT ' crc' || CAST(l_orderkey AS STRING) AS RecordNumber,
    CASE l_linestatus WHEN 'F' THEN 'Take Groundwater' ELSE 'Take Surface Water' END AS take_type,
    CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'In Waitaki' ELSE 'B' END AS allo_block,
    CASE WHEN min(l_linenumber) = 2 THEN 0.0 ELSE sum(floor(l_extendedprice)) * 100 END AS FullAnnualVolume,
    CASE WHEN min(l_linenumber) % 3 = 0 THEN 'No' ELSE 'Yes' END AS IncludeInGwAllocation
FROM {lineitem} GROUP BY 1, 2, 3""",
    "b_site": f"""
SELECT DISTINCT 'L' || {_SITE} AS ExtSiteID,
    CAST(1400000 + (l_suppkey * 7919 + l_partkey * 31) % 100000 AS INT) AS NZTMX,
    CAST(5100000 + (l_partkey * 7907 + l_suppkey * 13) % 40000 AS INT) AS NZTMY,
    CAST((l_suppkey * 37 + l_partkey * 11) % 101 AS INT) AS SD1_7Day,
    CAST(CASE WHEN l_suppkey % 10 = l_partkey % 10 THEN NULL ELSE (l_suppkey * 41 + l_partkey * 13) % 101 END AS INT) AS SD1_30Day,
    CAST((l_suppkey * 53 + l_partkey * 17) % 101 AS INT) AS SD1_150Day,
    l_partkey % 3 = 0 AS Storativity,
    CASE WHEN l_suppkey % 10 = 0 THEN 'CWAZ' ELSE 'GWAZ' END || lpad(CAST(l_suppkey % 25 AS STRING),4,'0') AS GwSpatialUnitId,
    'SWAZ' || lpad(CAST(l_partkey % 10 AS STRING),4,'0') AS SwSpatialUnitId,
    l_suppkey % 10 = 0 AS Combined
FROM {{lineitem}}""",
    # the register of sites_missing and join_anti, which lacks some of the sites in use
    "b_register": "SELECT * FROM {b_site} WHERE SD1_7Day <> 7",
    # aquifer tests of sites, several for some, without a result for others
    "b_aquifer_test": f"""
SELECT 'L' || {_SITE} AS Wap,
    CASE WHEN l_tax > 0.04 THEN l_discount ELSE NULL END AS Storativity
FROM {{lineitem}} WHERE l_returnflag <> 'N'""",
    # the register of low-flow sites, which lacks those of suppliers in debt
    "b_lowflow_site": """
SELECT CAST(s_suppkey AS STRING) AS ExtSiteID,
    s_name AS SiteName,
    CASE WHEN s_nationkey < 5 THEN 'Residual' ELSE 'LowFlow' END AS SiteType
FROM {supplier} WHERE s_acctbal >= 0""",
    "b_parent_child": """
SELECT RecA AS ParentRecordNumber,
    RecB AS ChildRecordNumber
FROM (SELECT ' crc' || CAST(o_orderkey AS STRING) AS RecA, 'CRC' || CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS STRING) || ' ' AS RecB
FROM {orders}) t WHERE RecB IS NOT NULL""",
    "b_consented": """
SELECT RecordNumber,
    take_type,
    sum(AllocatedRate) - 20 AS ConsentedRate,
    CASE WHEN count(*) % 2 = 0 THEN NULL ELSE sum(VolumeWeekly) END AS ConsentedMultiDayVolume,
    CASE WHEN count(*) % 2 = 0 THEN NULL ELSE 7 END AS ConsentedMultiDayPeriod,
    CASE WHEN count(*) > 2 THEN sum(Volume150Day) ELSE NULL END AS ConsentedAnnualVolume,
    CASE count(*) WHEN 1 THEN NULL WHEN 2 THEN 'complex' WHEN 3 THEN 'yes' ELSE 'no' END AS LowflowCondition
FROM {b_wap_allo} GROUP BY RecordNumber, take_type""",
    "b_water_use": """
SELECT ' crc' || CAST(l_orderkey AS STRING) AS RecordNumber,
    CASE l_linestatus WHEN 'F' THEN 'Use  Groundwater' ELSE 'Use Surface Water' END AS UseType,
    p_type AS WaterUse,
    CAST(p_size AS STRING) AS IrrigationArea,
    l_quantity - 10 AS ConsentedRate
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "b_attribute": """
SELECT p_partkey AS CrcActSiteID,
    'WaterUse' AS Attribute,
    p_type AS Value
FROM {part}
UNION ALL SELECT p_partkey,
    'IrrigationArea',
    CAST(p_size AS STRING)
FROM {part} WHERE p_partkey % 4 <> 0""",
    "b_linked": """
SELECT ParentRecordNumber AS RecordNumber,
    ChildRecordNumber AS OtherRecordNumber,
    'Combined' AS Relationship,
    1000.0 AS CombinedAnnualVolume
FROM {b_parent_child}""",
    "b_site_log": """
SELECT CAST(user_id AS STRING) AS ExtSiteID,
    CAST(ts AS DATE) AS RestrDate,
    value AS Measurement,
    event_type AS MeasurementMethod,
    CAST(least(100, floor(value)) AS INT) AS Allocation,
    event_id
FROM {events}""",
    "b_trigger": """
SELECT DISTINCT 'CRC' || CAST(o_orderkey AS STRING) AS RecordNumber,
    CAST(l_suppkey AS STRING) AS ExtSiteID,
    l_linenumber AS BandNumber,
    CAST(l_quantity AS INT) * 2 AS MinAllocation,
    CAST(l_quantity AS INT) * 2 + 10 AS MaxAllocation,
    l_returnflag <> 'N' AS IsActive
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Not in FIXTURES.md: divert conditions per permit x site (for D7), derived
    # from lineitem the same way as B2.
    "b_divert": f"""
SELECT ' crc' || CAST(l_orderkey AS STRING) AS RecordNumber,
    CASE l_linestatus WHEN 'F' THEN ' divert groundwater' ELSE 'Divert Surface Water ' END AS DivertType,
    CASE WHEN l_partkey % 20 = 2 THEN 'bad code' ELSE 'l' || lower({_SITE}) || ' ' END AS WAP,
    CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'yes' WHEN 3 THEN 'Complex' ELSE 'no' END AS LowflowCondition,
    l_quantity - 25 AS ConsentedRate,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE floor(l_extendedprice / 10) END AS ConsentedMultiDayVolume,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 7 END AS ConsentedMultiDayPeriod
FROM {{lineitem}}""",
    # Heads of the limit documents (not in FIXTURES.md): each group of b_limit as an operative document, and as three more
    # that a rule drops: proposed (id + 1000), not yet in force (+ 2000), without a spatial unit (+ 3000).
    "b_limit_head": " UNION ALL ".join(f"""
SELECT id + {add} AS id,
    'Group ' || CAST(id + {add} AS STRING) AS Name,
    'Plan ' || CAST(id % 3 AS STRING) AS PlanName,
    CASE WHEN id % 4 = 0 THEN NULL ELSE 'Section ' || CAST(id % 7 AS STRING) END AS PlanSection,
    'Table ' || CAST(id % 5 AS STRING) AS PlanTable,
    '{status}' AS status,
    '{start}' AS fromDate,
    {unit} AS has_unit
FROM (SELECT DISTINCT id FROM {{b_limit}}) g""" for add, status, start, unit in (
        (0, "Operative", "2000-01-01", "true"), (1000, "Proposed", "2000-01-01", "true"), (2000, "Operative", "2030-01-01", "true"), (3000, "Operative", "2000-01-01", "false"))),
    "b_reach_vertex": """
SELECT 'SWAZ' || lpad(CAST(s_suppkey % 10 AS STRING),4,'0') AS reach_id,
    s_suppkey AS vertex_id,
    CAST(1400300 + (s_suppkey * 7919) % 100 * 1000 AS DOUBLE) AS x,
    CAST(5100200 + (s_suppkey * 104729) % 40 * 1000 AS DOUBLE) AS y
FROM {supplier}""",
}

# B12 and B13 expand fixed value lists per nation row.
_SPARK_ONLY = {
    "b_limit": """
SELECT n_nationkey AS id,
    (CASE WHEN n_nationkey % 10 = 0 THEN 'CWAZ' ELSE 'GWAZ' END) || lpad(CAST(n_nationkey AS STRING),4,'0') AS spatialId,
    'Groundwater' AS HydroGroup,
    b AS AllocationBlock,
    CAST(CASE WHEN n_nationkey % 6 = 0 THEN 0 ELSE (n_nationkey + 1) * 1000000 END AS BIGINT) AS AllocationLimit,
    'm3/year' AS units,
    CAST(1 AS INT) AS fromMonth
FROM {nation} LATERAL VIEW explode(array('A', 'B')) x AS b
UNION ALL SELECT 100 + n_nationkey,
    'SWAZ' || lpad(CAST(n_nationkey AS STRING),4,'0'),
    'Surface Water',
    b,
    CAST((n_nationkey + 1) * 1000 AS BIGINT),
    'l/s',
    m
FROM {nation} LATERAL VIEW inline(array(named_struct('b', 'A', 'm', 1), named_struct('b', 'A', 'm', 7), named_struct('b', 'B', 'm', 4))) x AS b, m""",
    "b_zone_vertex": """
SELECT 'GWAZ' || lpad(CAST(n_nationkey AS STRING),4,'0') AS zone_id,
    'Zone ' || n_name AS Name,
    seq,
    CAST(1400000 + n_nationkey * 4000 - 500 + dx AS DOUBLE) AS x,
    CAST(5099500 + dy AS DOUBLE) AS y
FROM {nation} LATERAL VIEW inline(array(named_struct('seq', 1, 'dx', 0, 'dy', 0), named_struct('seq', 2, 'dx', 4000, 'dy', 0),
    named_struct('seq', 3, 'dx', 4000, 'dy', 30000), named_struct('seq', 4, 'dx', 2000, 'dy', 40000), named_struct('seq', 5, 'dx', 0, 'dy', 30000))) v AS seq, dx, dy""",
}

# The same rows as the templates of these names, by a deal of narrow keys: a site's columns follow from its keys, and from
# keys that are not negative (and exact as doubles) a code is made once; only other keys need their rows compared.
_PLAIN_KEYS = "l_suppkey BETWEEN 0 AND 1000000000000 AND l_partkey BETWEEN 0 AND 1000000000000"
_SITE_COLUMNS = _SQL["b_site"].split("SELECT DISTINCT ", 1)[1].split("FROM {lineitem}")[0]
_SPARK_FORM = {
    "b_site": f"""
SELECT {_SITE_COLUMNS}FROM (SELECT DISTINCT l_suppkey, l_partkey FROM {{lineitem}} WHERE {_PLAIN_KEYS}) pairs
UNION ALL SELECT DISTINCT {_SITE_COLUMNS}FROM {{lineitem}} WHERE ({_PLAIN_KEYS}) IS NOT TRUE""",
    "b_trigger": """
SELECT 'CRC' || CAST(l_orderkey AS STRING) AS RecordNumber,
    CAST(l_suppkey AS STRING) AS ExtSiteID,
    l_linenumber AS BandNumber,
    quantity * 2 AS MinAllocation,
    quantity * 2 + 10 AS MaxAllocation,
    IsActive
FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber, CAST(l_quantity AS INT) AS quantity, l_returnflag <> 'N' AS IsActive
    FROM {lineitem} LEFT SEMI JOIN {orders} ON l_orderkey = o_orderkey) bands""",
}

_DUCK_ONLY = {
    "b_limit": """
SELECT n_nationkey AS id,
    (CASE WHEN n_nationkey % 10 = 0 THEN 'CWAZ' ELSE 'GWAZ' END) || lpad(CAST(n_nationkey AS STRING),4,'0') AS spatialId,
    'Groundwater' AS HydroGroup,
    b AS AllocationBlock,
    CAST(CASE WHEN n_nationkey % 6 = 0 THEN 0 ELSE (n_nationkey + 1) * 1000000 END AS BIGINT) AS AllocationLimit,
    'm3/year' AS units,
    CAST(1 AS INT) AS fromMonth
FROM nation CROSS JOIN (VALUES ('A'),('B')) x(b)
UNION ALL SELECT 100 + n_nationkey,
    'SWAZ' || lpad(CAST(n_nationkey AS STRING),4,'0'),
    'Surface Water',
    b,
    CAST((n_nationkey + 1) * 1000 AS BIGINT),
    'l/s',
    m
FROM nation CROSS JOIN (VALUES ('A',1),('A',7),('B',4)) x(b,m)""",
    "b_zone_vertex": """
SELECT 'GWAZ' || lpad(CAST(n_nationkey AS STRING),4,'0') AS zone_id,
    'Zone ' || n_name AS Name,
    seq,
    CAST(1400000 + n_nationkey * 4000 - 500 + dx AS DOUBLE) AS x,
    CAST(5099500 + dy AS DOUBLE) AS y
FROM nation CROSS JOIN (VALUES (1,0,0),(2,4000,0),(3,4000,30000),(4,2000,40000),(5,0,30000)) v(seq,dx,dy)""",
}

_DEPS = {
    "b_consented": ("b_wap_allo",),
    "b_linked": ("b_parent_child",),
    "b_limit_head": ("b_limit",),
    "b_register": ("b_site",),
}

BINDING_NAMES = tuple(list(_SQL) + list(_SPARK_ONLY))


def _spark_template(name: str) -> str:
    return _SPARK_ONLY.get(name) or _SPARK_FORM.get(name) or _SQL[name]


def _placeholders(template: str) -> list[str]:
    import string
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


@dataclass
class Tables:
    """Lazy catalog of base tables and bindings for one data folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def base(self, name: str) -> DataFrame:
        key = ("base", name)
        if key not in self._cache:
            df = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
            self._cache[key] = df
        return self._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        key = ("binding", name)
        if key not in self._cache:
            template = _spark_template(name)
            args = {p: self[p] for p in set(_placeholders(template))}
            self._cache[key] = self.spark.sql(template, **args)
        return self._cache[key]


def oracle_ctes(names: list[str] | tuple[str, ...]) -> str:
    """``WITH`` clause defining the given bindings (and their dependencies) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text = _DUCK_ONLY.get(n) or _SQL[n]
        text = text.format(**{p: p for p in _placeholders(text)})
        parts.append(f"{n} AS ({text.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
