"""Texts and numbers that results depend on and that must stay exactly as they are."""

# Violation records.
VIOLATION_TYPES = ["Speeding", "Red Light", "Illegal Parking", "Stop Sign", "Expired Registration"]
LOCATIONS = ["Main St", "Broadway", "Elm St", "Maple Ave", "Washington Blvd"]
PERIOD_START = "2025-01-01 00:00:00"
PERIOD_SECONDS = 31536000
SAMPLE_ROWS = 5

# Vehicle telemetry.
VEHICLE_PREFIX = "AV-"
VEHICLE_DIGITS = 8
SPEED_MIN = 0.0
SPEED_MAX = 120.0
DRAIN_PER_KMH = 0.001
START_BALANCE = {"Platoon_A": 100.0, "Platoon_B": 85.0}
TICK_SECONDS = 10
TRIGGER = "10 seconds"
TELEMETRY_COLUMNS = {
    "vehicle_id": "string",
    "timestamp": "timestamp",
    "speed_kmh": "double",
    "battery_kwh": "double",
    "lidar_anomaly_flag": "boolean",
    "cooperative_platoon_id": "string",
}
PLATOON = "cooperative_platoon_id"

# Preview of a result.
PREVIEW_ROWS = 10
SHOWN_ROWS = 20
PREVIEW_WIDTH = 20

# Clean-up and check of statement text. The rewrites apply in this order.
CATALOG = "nessie"
TABLE = "nessie.autonomous_telemetry"
FENCES = ["```sql", "```"]
REWRITES = [
    (f"IN {TABLE}", f"IN {CATALOG} FROM main"),
    (f"ALTER TABLE {TABLE}", ""),
    (f"SHOW PARTITIONS '{TABLE}'", f"SHOW PARTITIONS {TABLE}"),
    (f'SHOW PARTITIONS "{TABLE}"', f"SHOW PARTITIONS {TABLE}"),
]
SYSTEM_PREFIX = f"{CATALOG}.system."
ALLOWED_PROCEDURE = "rewrite_data_files"

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
