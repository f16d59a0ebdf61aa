"""Labels, codes, defaults and table schemas shared by every operator."""

from pyspark.sql import types as T

# Category label -> code, in code order.
CATEGORY_CODES = {
    "on_off": {"OFF": 0, "ON": 1},
    "mode": {"OFF": 0, "COOL": 1, "HEAT": 2, "FAN": 3},
    "fan_speed": {"AUTO": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "TOP": 4},
    "status": {"OFF": 0, "COOL": 1, "HEAT": 2, "FAN": 3},
}

# Code given to a label outside the table. The fan default is a label
# ("Low") that is not a key of the table, so it resolves to the first code, AUTO.
DEFAULT_CODES = {"on_off": 0, "mode": 3, "fan_speed": 0, "status": 0}

# Modes a pattern may have for an operation type.
ALLOWED_MODES = {"COOL": [1, 3], "HEAT": [2, 3], "FAN": [3], "OFF": [0]}

# Zone order of reports and wide tables.
ZONE_ORDER = [
    "Area 1",
    "Area2_1",
    "Area2_2",
    "Area 3",
    "Area 4",
    "Meeting Room",
    "Break Room",
]

# Names of the zone that is split in two, and the indoor units of each part.
SPLIT_ZONE_NAMES = ["Area 2", "エリア2"]
SPLIT_ZONE_UNITS = {
    "Area2_1": ["D-8北2", "D-6北1", "D-7南2", "D-5南1"],
    "Area2_2": ["D-4北2", "D-2北1"],
}

# Zone whose pattern history is limited, and the limit in months.
RECENT_ONLY_ZONE = "area 1"
RECENT_MONTHS = 12

# Settings used where the master has none.
SETTING_DEFAULTS = {
    "start_time": "07:00",
    "end_time": "20:00",
    "comfort_min": 22.0,
    "comfort_max": 25.0,
    "setpoint_min": 22.0,
    "setpoint_max": 28.0,
    "target_room_temp": 25.0,
}
DEFAULT_FAN_CANDIDATES = ["Low", "Medium", "High"]
ROW_FAN_CANDIDATES = ["Low"]
MODE_CANDIDATES = ["COOL", "HEAT", "FAN"]
DEFAULT_OPEN_HOUR = 7
DEFAULT_CLOSE_HOUR = 20

# Raw CSV heading -> working name.
AC_COLUMNS = {
    "A/C Name": "unit",
    "Datetime": "ts",
    "Outdoor Temp.": "outdoor_temp",
    "Indoor Temp.": "indoor_temp",
    "A/C Set Temperature": "set_temp",
    "A/C ON/OFF": "on_off",
    "A/C Mode": "mode",
    "A/C Fan Speed": "fan_speed",
}
POWER_COLUMNS = {
    "Mesh ID": "mesh_id",
    "PM Addr ID": "pm_addr_id",
    "Datetime": "ts",
    "Phase A": "phase_a",
    "Phase B": "phase_b",
    "Phase C": "phase_c",
}
MASTER_COLUMNS = {
    "制御区分": "zone",
    "電力予測区分": "outdoor_unit",
    "環境予測区分": "indoor_unit",
    "月": "month_label",
    "始業時間": "start_time",
    "就業時間": "end_time",
    "目標室内温度下限": "comfort_min",
    "目標室内温度上限": "comfort_max",
    "設定温度下限": "setpoint_min",
    "設定温度上限": "setpoint_max",
    "風量候補": "fan_candidates",
    "運転区分": "operation_type",
}
# Weather headings that mean the same measure.
WEATHER_ALIASES = {
    "outdoor_temp": ["Outdoor Temp.", "outdoor_temp", "temperature C", "out_temp"],
    "outdoor_humidity": ["Outdoor Humidity", "outdoor_humidity", "humidity", "out_hum"],
    "solar_radiation": ["Solar Radiation", "solar_radiation"],
}
TIME_COLUMN_NAMES = ["Datetime", "datetime", "日時"]

LOCAL_ZONE = "Asia/Tokyo"

# Settings carried by a plan row.
PLAN_SETTINGS = [
    "set_temp",
    "mode",
    "fan_speed",
    "numb_units_on",
    "ac_on_off",
    "power",
    "indoor_temp",
    "hist_outdoor_temp",
    "hist_solar_radiation",
    "hist_indoor_temp",
    "hist_datetime_used",
]

# Model inputs.
BASE_FEATURES = [
    "set_temp",
    "indoor_temp_lag1",
    "status",
    "fan_speed",
    "outdoor_temp",
    "outdoor_humidity",
    "solar_radiation",
    "day_of_week",
    "hour",
    "month",
    "is_weekend",
    "is_holiday",
]
CORRELATION_TARGETS = ["indoor_temp", "adjusted_power"]

SIMILAR_DAYS = 20
BLOCK_HOURS = 2
OUTLIER_SIGMAS = 5.0


def _schema(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Warehouse tables of raw readings.
AC_CONTROL_SCHEMA = _schema(
    ("AC_Name", T.StringType(), False),
    ("Datetime", T.TimestampType(), False),
    ("Outdoor_Temp", T.LongType(), True),
    ("Indoor_Temp", T.DoubleType(), True),
    ("AC_Set_Temperature", T.DoubleType(), True),
    ("AC_ON_OFF", T.StringType(), True),
    ("AC_Mode", T.StringType(), True),
    ("AC_Fan_Speed", T.StringType(), True),
    ("Outdoor_Room_Temp", T.DoubleType(), True),
    ("Outdoor_Set_Temp", T.DoubleType(), True),
    ("Room_Set_Temp", T.DoubleType(), True),
)
POWER_METER_SCHEMA = _schema(
    ("Mesh_ID", T.LongType(), False),
    ("PM_Addr_ID", T.LongType(), False),
    ("Datetime", T.TimestampType(), False),
    ("Phase_A", T.LongType(), True),
    ("Phase_B", T.LongType(), True),
    ("Phase_C", T.LongType(), True),
)
WEATHER_SCHEMA = _schema(
    ("measured_at", T.TimestampType(), False),
    ("out_temp", T.DoubleType(), True),
    ("out_hum", T.DoubleType(), True),
    ("created_at", T.TimestampType(), True),
)
# Vendor level columns (any heading ending so) are kept as whole numbers.
LEVEL_SUFFIX = "_Energy_Level"
RAW_KEYS = {
    "ac_control": ["AC_Name", "Datetime"],
    "power_meter": ["Mesh_ID", "PM_Addr_ID", "Datetime"],
}
WEATHER_JSON = (
    "struct<days: array<struct<datetime: string, "
    "hours: array<map<string, string>>>>>"
)
