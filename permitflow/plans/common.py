"""Cleaning steps shared by the v1 and v2 pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import config as C
from ..functions.months import water_month
from ..functions.text import strip_ws, title_words
from ..operators.clean import include_flag, recode, repair_dates, validate_code
from ..operators.dedup import first_by
from ..operators.joins import keep_existing, missing_from
from ..session import materialize


def clean_permits(permit: DataFrame, form: str = "v1") -> DataFrame:
    """D3: cleaned permits, one row per RecordNumber.

    ``v1`` repairs dates (s124 rule, floor) and drops permits without a site
    owner id (EcanID); ``v2`` keeps these permits and the dates as they are.

    Duplicates keep the first row under (FromDate, ToDate, ConsentStatus) with
    the remaining columns as tie-break (a total order, N4).
    """
    p = permit.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        strip_ws("ConsentStatus").alias("ConsentStatus"),
        F.col("FromDate").cast("string").try_cast("date").alias("FromDate"),
        F.col("ToDate").cast("string").try_cast("date").alias("ToDate"),
        F.bround(F.col("NZTMX").try_cast("double")).alias("NZTMX"),
        F.bround(F.col("NZTMY").try_cast("double")).alias("NZTMY"),
        F.upper(strip_ws("EcanID")).alias("EcanID"),
    )
    if form == "v1":
        p = repair_dates(p, "ConsentStatus", "FromDate", "ToDate", C.S124_STATUS, C.S124_EXTENSION_YEARS,
                         C.DATE_FLOOR, sentinel=None)
    p = first_by(p, ["RecordNumber"], [("FromDate", "asc"), ("ToDate", "asc"), ("ConsentStatus", "asc")])
    p = p.filter(F.col("ConsentStatus").isNotNull() & F.col("RecordNumber").isNotNull())
    if form == "v1":
        p = p.filter(F.col("EcanID").isNotNull())
    s = F.lit(C.DATE_SENTINEL).cast("date")
    return p.withColumns({"FromDate": F.coalesce("FromDate", s), "ToDate": F.coalesce("ToDate", s)})


def clean_sites(site: DataFrame) -> DataFrame:
    """Site register with its key normalised."""
    return site.withColumn("ExtSiteID", F.upper(strip_ws("ExtSiteID")))


def clean_wap_allo(wap_allo: DataFrame) -> DataFrame:
    """C1-C6 on the take x block x site rows, before any join."""
    return wap_allo.select(
        F.upper(strip_ws("RecordNumber")).alias("RecordNumber"),
        title_words(strip_ws("take_type")).alias("take_type"),
        recode(strip_ws("sw_allo_block"), C.BLOCK_RECODES).alias("AllocationBlock"),
        validate_code(F.upper(strip_ws("WAP"))).alias("WAP"),
        F.bround(F.col("AllocatedRate").try_cast("double"), 2).alias("AllocatedRate"),
        F.bround(F.col("WapRate").try_cast("double"), 2).alias("WapRate"),
        F.col("VolumeDaily").try_cast("double").cast("bigint").alias("VolumeDaily"),
        F.col("VolumeWeekly").try_cast("double").cast("bigint").alias("VolumeWeekly"),
        F.col("Volume30Day").try_cast("double").alias("Volume30Day"),
        F.col("Volume150Day").try_cast("double").cast("bigint").alias("Volume150Day"),
        water_month(title_words(strip_ws("FromMonth")), C.DEFAULT_FROM_MONTH_NAME).alias("FromMonth"),
        water_month(title_words(strip_ws("ToMonth")), C.DEFAULT_TO_MONTH_NAME).alias("ToMonth"),
        F.col("SD1").try_cast("double").alias("SD1"),
        F.col("SD2").try_cast("double").alias("SD2"),
        include_flag("IncludeInSwAllocation").alias("IncludeInSwAllocation"),
    )


def take_rows(wap_allo: DataFrame, permits: DataFrame, sites: DataFrame) -> DataFrame:
    """D2 + FK checks: cleaned take rows whose permit exists and whose (non-null)
    site is in the register. Null-site rows are kept for H1.

    Codes are held against the register on their own, and those it lacks are written: rows in full are only dealt by
    permit, unless the register lacks so many codes that they can't be broadcast."""
    return keep_existing(known_rows(wap_allo, sites), permits, "RecordNumber")


def known_rows(wap_allo: DataFrame, sites: DataFrame) -> DataFrame:
    """Cleaned take rows without those whose (non-null) site the register lacks, of any permit."""
    wa = clean_wap_allo(wap_allo)
    codes = wa.select("WAP").filter(F.col("WAP").isNotNull()).distinct()
    unknown = materialize(missing_from(codes, sites, "WAP", ref_on="ExtSiteID"), "unknown-sites")
    return missing_from(wa, unknown, "WAP")


class Stages:
    """Lazily built pipeline stages: ``stages["name"]`` builds a stage (and the
    stages it reads) on first use only, so a query pays just for what it needs."""

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict = {}

    def __getitem__(self, name: str):
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]
