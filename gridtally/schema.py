"""Column names and types of the tables this library works on."""

from pyspark.sql import types as T

READING_ID = "reading_id"
METER = "meter_id"
TS = "ts"
WORK_TYPE = "work_type"

USAGE = "usage_kwh"
REACTIVE_LAG = "reactive_lag_kvarh"
REACTIVE_LEAD = "reactive_lead_kvarh"
CARBON = "carbon_tco2"
PF_LAG = "pf_lag_pct"
PF_LEAD = "pf_lead_pct"
COST = "cost_krw"

MEASURES = (USAGE, REACTIVE_LAG, REACTIVE_LEAD, CARBON, PF_LAG, PF_LEAD, COST)

# Readings carry the meter's own wall-clock time, hence no time zone.
READINGS_SCHEMA = T.StructType(
    [
        T.StructField(READING_ID, T.LongType()),
        T.StructField(METER, T.IntegerType()),
        T.StructField(TS, T.TimestampNTZType()),
        T.StructField(WORK_TYPE, T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in MEASURES],
    ]
)

TO_FORECAST_SCHEMA = T.StructType(READINGS_SCHEMA.fields[:4])

MONTH = "month"
POWER_FACTOR_FEE = "power_factor_fee"

# The headers input files use, and the column each one feeds.
HEADER_NAMES = {
    "id": READING_ID,
    "측정일시": TS,
    "datetime": TS,
    "작업유형": WORK_TYPE,
    "전력사용량(kWh)": USAGE,
    "전력사용량": USAGE,
    "power_usage": USAGE,
    "지상무효전력량(kVarh)": REACTIVE_LAG,
    "진상무효전력량(kVarh)": REACTIVE_LEAD,
    "탄소배출량(tCO2)": CARBON,
    "탄소배출량": CARBON,
    "co2": CARBON,
    "지상역률(%)": PF_LAG,
    "진상역률(%)": PF_LEAD,
    "전기요금(원)": COST,
    "전기요금": COST,
    "cost": COST,
    "월": MONTH,
    "역률요금": POWER_FACTOR_FEE,
    "예측 전기요금(원)": "prediction",
}
