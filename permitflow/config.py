"""Fixed values of the domain and default parameters.

The reference keeps these in a YAML file that is not part of its repository,
so the parameter defaults below are our own. Values that must match for right
results (month numbering, status classes, conversion factors, note templates)
are stated together in the FIXED VALUES block.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for right results)
# ---------------------------------------------------------------------------

# Water-year month numbers: July is month 1.
MONTH_TO_WATER_MONTH = {
    "Jan": 7, "Feb": 8, "Mar": 9, "Apr": 10, "May": 11, "Jun": 12,
    "Jul": 1, "Aug": 2, "Sep": 3, "Oct": 4, "Nov": 5, "Dec": 6,
}
WATER_MONTH_TO_NAME = {
    1: "Jul", 2: "Aug", 3: "Sep", 4: "Oct", 5: "Nov", 6: "Dec",
    7: "Jan", 8: "Feb", 9: "Mar", 10: "Apr", 11: "May", 12: "Jun",
}
UNCLASSIFIED = "Migration: Not Classified"
DEFAULT_FROM_MONTH_NAME = "Jul"
DEFAULT_TO_MONTH_NAME = "Jun"

# Allocation block recodes (both map to block A).
BLOCK_RECODES = {"Migration: Not Classified": "A", "In Waitaki": "A"}

# Permit status classes.
ACTIVE_STATUSES = ("Issued - Active", "Issued - Inactive", "Issued - s124 Continuance")
IN_PROCESS_STATUSES = ("Application in Process",)
S124_STATUS = "Issued - s124 Continuance"

# Take types and hydro groups.
TAKE_SW = "Take Surface Water"
TAKE_GW = "Take Groundwater"
HG_SW = "Surface Water"
HG_GW = "Groundwater"

# Site code pattern (unanchored search).
SITE_CODE_PATTERN = r"[A-Z]+\d\d/\d\d\d\d"

# Conversion constants.
DAYS_PER_MONTH = 30.42
SECONDS_PER_DAY = 86400

# Date repair.
DATE_FLOOR = "1950-01-01"
DATE_SENTINEL = "1900-01-01"
S124_EXTENSION_YEARS = 30

# Stream-depletion categories (v2) and their surface-water volume ratios.
SD_VOLUME_RATIO = {"low": 0.0, "moderate": 0.5, "high": 0.75, "direct": 1.0}

# Notes for plan limits shared across zones / hydro groups.
JOINT_HYDRO_NOTE = "Allocation limits for this allocation zone are combined between surface water and groundwater."
JOINT_UNITS_NOTE = "The allocation limits are shared jointly across these zones: "
NOTE_TEMPLATE = "{hydro} {unit_notes}{units}"

# Default block id for low-flow permits without a surface-water block.
DEFAULT_LOWFLOW_BLOCK_ID = 9


# ---------------------------------------------------------------------------
# Parameter defaults (ours; the reference reads them from a YAML not shipped)
# ---------------------------------------------------------------------------

HYDRO_GROUPS = [HG_SW, HG_GW]
ACTIVITY_TYPES = ["Take", "Divert", "Use"]
ATTRIBUTES = ["WaterUse", "IrrigationArea"]
