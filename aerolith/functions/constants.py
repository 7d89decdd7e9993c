"""Fixed values.

These values must equal the source system's for the same results; they are
stated here plainly and in their natural order. Everything else in the library
takes them as parameters with these as defaults.
"""

from __future__ import annotations

from datetime import date

# --- fixed values -----------------------------------------------------------

# Time zone of the air-quality feed's local date/time strings.
SOURCE_TIMEZONE = "Asia/Bangkok"

# Pollutant measures; any negative value is a missing-data sentinel.
POLLUTANT_COLUMNS = (
    "pm25_value",
    "pm10_value",
    "o3_value",
    "co_value",
    "no2_value",
    "so2_value",
)

# Daily-summary exceedance threshold for PM2.5 (strictly greater than).
PM25_THRESHOLD = 50.0

# Share-of-hours threshold for PM2.5 used in the clean-air question.
PM25_GUIDELINE = 15.0

# Sigma by sensor type.
SENSOR_SIGMA = {"temperature": 1.5, "pressure": 2.0, "vibration": 0.1, "flow": 3.0}

# Anomaly rule: |value - target| > ANOMALY_SIGMA * sigma(type); unknown type sigma.
ANOMALY_SIGMA = 3.0
DEFAULT_SIGMA = 1.0

# Hot path: tumbling window length, flush cadence, record time-to-live.
WINDOW_DURATION = "1 minute"
FLUSH_INTERVAL = "30 seconds"
TTL_HOURS = 24

# Live view: look-back and row count.
LIVE_LOOKBACK_MINUTES = 10
LIVE_ROWS = 50

# Zones and their display names.
ZONE_NAMES = {
    "Z01": "Production A",
    "Z02": "Production B",
    "Z03": "Warehouse",
    "Z04": "Utilities",
    "Z05": "Office",
}
ZONE_DESCRIPTION = "Bangkok facility zone"

# Region dimension country and sensor-type typical range.
COUNTRY = "Thailand"
SENSOR_RANGE_MIN = 0.0
SENSOR_RANGE_MAX = 999.0

# SCD2 open-ended expiry date.
FAR_FUTURE = date(9999, 12, 31)

# Date dimension range and public holidays (2026 only).
DIM_DATE_START = date(2020, 1, 1)
DIM_DATE_END = date(2030, 12, 31)
HOLIDAYS_2026 = (
    "2026-01-01", "2026-02-03", "2026-04-06",
    "2026-04-13", "2026-04-14", "2026-04-15",
    "2026-05-01", "2026-05-04", "2026-06-03",
    "2026-07-28", "2026-08-12", "2026-10-13",
    "2026-10-23", "2026-12-05", "2026-12-10",
    "2026-12-31",
)

# Placeholder for a missing attribute on the hot path.
UNKNOWN = "unknown"

# --- end of fixed values ------------------------------------------------------
