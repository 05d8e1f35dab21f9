"""Reading and writing, choosing rows and columns, relational combination."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (
    MONTH,
    rd,
    readings,
    rounded,
    table,
    to_forecast,
    train,
    with_readings,
)
from catalog.registry import query
from gridtally.operators import filters, relational
from gridtally.operators.ordered import ensure_id
from gridtally.operators.report import monthly_rollup
from gridtally.session import scratch_path
from gridtally.sources import readings as files

FILE_HEADERS = {
    "reading_id": "id",
    "ts": "측정일시",
    "work_type": "작업유형",
    "usage_kwh": "전력사용량(kWh)",
    "carbon_tco2": "탄소배출량(tCO2)",
    "cost_krw": "전기요금(원)",
}


def _file_frame(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.select(*[F.col(c).alias(h) for c, h in FILE_HEADERS.items()])


_FILE_SQL = with_readings(
    "SELECT reading_id, ts, work_type, usage_kwh, carbon_tco2, cost_krw FROM readings"
)


@query("read_readings_csv", _FILE_SQL)
def read_readings_csv(spark, sf_dir):
    path = scratch_path(spark, "readings-csv")
    _file_frame(spark, sf_dir).write.csv(path, header=True)
    return files.read_readings(spark, path, "csv")


@query(
    "read_readings_csv_mixed_headers",
    with_readings(
        "SELECT reading_id, ts, work_type, usage_kwh, CASE WHEN reading_id % 3 = 0 THEN carbon_tco2 END AS carbon_tco2, cost_krw FROM readings"
    ),
)
def read_readings_csv_mixed_headers(spark, sf_dir):
    """One folder, three headers: other names, another order, and a column that most files lack."""
    path = scratch_path(spark, "mixed-csv")
    df, third = readings(spark, sf_dir), F.col("reading_id") % 3
    _file_frame(spark, sf_dir).filter(F.col("id") % 3 == 0).write.csv(path, header=True)
    swapped = df.filter(third == 1).select("cost_krw", "usage_kwh", F.col("ts").alias("datetime"), "work_type", F.col("reading_id").alias("id"))
    swapped.write.mode("append").csv(path, header=True)
    renamed = df.filter(third == 2).select("reading_id", "ts", F.col("cost_krw").alias("cost"), "work_type", F.col("usage_kwh").alias("power_usage"))
    renamed.write.mode("append").csv(path, header=True, compression="gzip")
    out = files.read_readings(spark, path, "csv")
    return out.select("reading_id", "ts", "work_type", "usage_kwh", "carbon_tco2", "cost_krw")


@query(
    "read_readings_months",
    with_readings(
        "SELECT reading_id, meter_id, ts, work_type, usage_kwh, cost_krw FROM readings "
        "WHERE ts >= TIMESTAMP '2024-02-10 00:00:00' AND ts < TIMESTAMP '2024-04-05 00:00:00'"
    ),
)
def read_readings_months(spark, sf_dir):
    path = scratch_path(spark, "readings")
    files.write_predictions(readings(spark, sf_dir), path, ["usage_kwh", "cost_krw"])
    return files.read_readings(spark, path, start="2024-02-10", end="2024-04-05").drop("month")


@query("normalize_columns", _FILE_SQL)
def normalize_columns(spark, sf_dir):
    return files.normalize_columns(_file_frame(spark, sf_dir))


@query(
    "resolve_column",
    with_readings("SELECT reading_id AS id, cost_krw AS found FROM readings"),
)
def resolve_column(spark, sf_dir):
    df = _file_frame(spark, sf_dir)
    return df.select("id", F.col(f"`{files.resolve_column(df, ['전기요금', 'cost'])}`").alias("found"))


@query(
    "coerce_valid",
    with_readings(
        "SELECT reading_id, ts, usage_kwh FROM readings WHERE reading_id % 7 <> 0 AND reading_id % 5 <> 0"
    ),
)
def coerce_valid(spark, sf_dir):
    key = F.col("reading_id")
    dirty = readings(spark, sf_dir).select(
        "reading_id",
        F.when(key % 7 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(key % 5 == 0, "n/a").otherwise(F.col("usage_kwh").cast("string")).alias("usage_kwh"),
    )
    return files.coerce_valid(dirty, "ts", "usage_kwh")


@query(
    "read_csv_korean_code_page",
    with_readings(
        "SELECT CAST(reading_id AS VARCHAR) AS reading_id, "
        "CASE work_type WHEN 'Light_Load' THEN '경부하' WHEN 'Medium_Load' THEN '중간부하' "
        "ELSE '최대부하' END AS work_type FROM readings"
    ),
)
def read_csv_korean_code_page(spark, sf_dir):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = scratch_path(spark, "korean-csv")
    name = (
        F.when(F.col("work_type") == "Light_Load", "경부하")
        .when(F.col("work_type") == "Medium_Load", "중간부하")
        .otherwise("최대부하")
    )
    df = readings(spark, sf_dir).select(F.col("reading_id").alias("id"), name.alias("작업유형"))
    df.write.csv(path, header=True, encoding="EUC-KR")
    return files.read_csv_encoded(spark, path, "CP949")


_ROLLUP_SQL = (
    "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, "
    + ", ".join(f"{rd(f'sum({c})', 3)} AS {c}" for c in ("usage_kwh", "cost_krw", "carbon_tco2"))
    + " FROM readings GROUP BY 1"
)


@query("read_monthly_summary", with_readings(_ROLLUP_SQL))
def read_monthly_summary(spark, sf_dir):
    path = scratch_path(spark, "summary-csv")
    monthly_rollup(readings(spark, sf_dir)).select(
        F.date_format("month", "yyyy-MM").alias("월"),
        F.col("usage_kwh").alias("전력사용량(kWh)"),
        F.col("cost_krw").alias("전기요금(원)"),
        F.col("carbon_tco2").alias("탄소배출량(tCO2)"),
    ).write.csv(path, header=True)
    summary = files.read_monthly_summary(spark, path)
    return rounded(summary, 3, "usage_kwh", "cost_krw", "carbon_tco2")


@query(
    "write_submission",
    with_readings("SELECT reading_id AS id, cost_krw * CAST(0.5 AS DOUBLE) AS prediction FROM readings"),
)
def write_submission(spark, sf_dir):
    path = scratch_path(spark, "submission")
    files.write_submission(readings(spark, sf_dir), path, F.col("cost_krw") * 0.5)
    return spark.read.csv(path, header=True, schema="id bigint, prediction double")


@query(
    "write_predictions",
    with_readings("SELECT *, CAST(date_trunc('month', ts) AS DATE) AS month FROM readings"),
)
def write_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    files.write_predictions(readings(spark, sf_dir), path)
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("date"))


@query(
    "ensure_id",
    with_readings(
        "SELECT row_number() OVER (ORDER BY ts, cost_krw, usage_kwh) - 1 AS id, ts, "
        "cost_krw, usage_kwh FROM readings"
    ),
)
def ensure_id_query(spark, sf_dir):
    df = readings(spark, sf_dir).select("ts", "cost_krw", "usage_kwh")
    return ensure_id(df, ["ts", "cost_krw", "usage_kwh"])


@query(
    "read_to_forecast",
    with_readings("SELECT reading_id, ts, work_type FROM to_forecast"),
)
def read_to_forecast(spark, sf_dir):
    path = scratch_path(spark, "to-forecast")
    names = {c: h for c, h in FILE_HEADERS.items() if c in ("reading_id", "ts", "work_type")}
    to_forecast(spark, sf_dir).select(*[F.col(c).alias(h) for c, h in names.items()]).write.csv(
        path, header=True
    )
    return files.read_to_forecast(spark, path)


# Rows by time, columns by name

_ROWS = "SELECT reading_id, ts, usage_kwh, cost_krw FROM readings WHERE "


def _slim(df):
    return df.select("reading_id", "ts", "usage_kwh", "cost_krw")


@query("in_month", with_readings("SELECT reading_id, ts, usage_kwh, cost_krw FROM chosen"))
def in_month(spark, sf_dir):
    return _slim(filters.in_month(readings(spark, sf_dir), MONTH))


@query(
    "in_dates",
    with_readings(_ROWS + "CAST(ts AS DATE) BETWEEN DATE '2024-03-05' AND DATE '2024-04-20'"),
)
def in_dates(spark, sf_dir):
    return _slim(filters.in_dates(readings(spark, sf_dir), "2024-03-05", "2024-04-20"))


@query(
    "between_instants",
    with_readings(
        _ROWS + "ts BETWEEN TIMESTAMP '2024-03-05 06:15:00' AND TIMESTAMP '2024-04-20 18:45:00'"
    ),
)
def between_instants(spark, sf_dir):
    return _slim(
        filters.between(readings(spark, sf_dir), "2024-03-05 06:15:00", "2024-04-20 18:45:00")
    )


@query(
    "trailing_year",
    with_readings(_ROWS + "ts >= (SELECT max(ts) FROM readings) - INTERVAL 1 YEAR"),
)
def trailing_year(spark, sf_dir):
    return _slim(filters.trailing_year(readings(spark, sf_dir)))


@query(
    "trailing_year_per_meter",
    with_readings(
        "SELECT r.reading_id, r.ts, r.usage_kwh, r.cost_krw FROM readings r JOIN "
        "(SELECT meter_id, max(ts) AS newest FROM readings GROUP BY 1) USING (meter_id) "
        "WHERE ts >= newest - INTERVAL 1 YEAR"
    ),
)
def trailing_year_per_meter(spark, sf_dir):
    return _slim(filters.trailing_year(readings(spark, sf_dir), by=["meter_id"]))


@query(
    "previous_month",
    with_readings(_ROWS + "ts >= TIMESTAMP '2024-04-01 00:00:00' AND ts < TIMESTAMP '2024-05-01 00:00:00'"),
)
def previous_month(spark, sf_dir):
    return _slim(filters.previous_month(readings(spark, sf_dir), MONTH))


@query(
    "previous_days",
    with_readings(
        _ROWS + "ts < (SELECT min(ts) FROM chosen) AND ts >= (SELECT min(ts) FROM chosen) - INTERVAL 30 DAY"
    ),
)
def previous_days(spark, sf_dir):
    df = readings(spark, sf_dir)
    return _slim(filters.previous_days(df, filters.in_month(df, MONTH)))


@query("select_metrics", with_readings("SELECT ts, usage_kwh, carbon_tco2 FROM readings"))
def select_metrics(spark, sf_dir):
    return filters.select_metrics(readings(spark, sf_dir), ["usage_kwh", "carbon_tco2"])


@query(
    "drop_columns",
    with_readings(
        "SELECT * EXCLUDE (reactive_lag_kvarh, reactive_lead_kvarh, pf_lag_pct, pf_lead_pct) FROM readings"
    ),
)
def drop_columns(spark, sf_dir):
    absent = ["reactive_lag_kvarh", "reactive_lead_kvarh", "pf_lag_pct", "pf_lead_pct", "not_there"]
    return filters.drop_columns(readings(spark, sf_dir), absent)


@query(
    "feature_columns",
    with_readings(
        "SELECT usage_kwh, reactive_lag_kvarh, reactive_lead_kvarh, carbon_tco2, pf_lag_pct, "
        "pf_lead_pct FROM readings"
    ),
)
def feature_columns(spark, sf_dir):
    df = readings(spark, sf_dir).withColumn("usage_kwh_rolling_mean_6", F.lit(0.0))
    names = filters.feature_columns(
        df, ["reading_id", "meter_id", "cost_krw"], without_marks=filters.ROLLING_MARKS
    )
    return df.select(*names)


# Combination, order, top rows


@query(
    "union_history",
    with_readings(
        "SELECT *, 0 AS origin FROM train UNION ALL BY NAME SELECT *, 1 AS origin FROM to_forecast"
    ),
)
def union_history(spark, sf_dir):
    return relational.union_history(train(spark, sf_dir), to_forecast(spark, sf_dir), "origin")


@query(
    "lookup_default",
    with_readings(
        "SELECT r.reading_id, r.meter_id, CASE WHEN n.n_name IS NULL THEN 'none' ELSE n.n_name END AS n_name "
        "FROM readings r LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 5) n "
        "ON r.meter_id = n.n_nationkey"
    ),
)
def lookup_default(spark, sf_dir):
    names = table(spark, sf_dir, "nation").filter("n_nationkey < 5")
    names = names.select(F.col("n_nationkey").cast("int").alias("meter_id"), "n_name")
    df = readings(spark, sf_dir).select("reading_id", "meter_id")
    return relational.lookup(df, names, "meter_id", "n_name", F.lit("none"))


@query(
    "keep_ids",
    with_readings(
        "SELECT reading_id, ts, usage_kwh, cost_krw FROM readings "
        "WHERE reading_id IN (SELECT reading_id FROM to_forecast)"
    ),
)
def keep_ids(spark, sf_dir):
    return _slim(relational.keep_ids(readings(spark, sf_dir), to_forecast(spark, sf_dir)))


@query(
    "latest_n",
    with_readings(
        "SELECT reading_id, ts, usage_kwh, cost_krw FROM readings ORDER BY ts DESC, reading_id DESC LIMIT 168"
    ),
)
def latest_n(spark, sf_dir):
    return _slim(relational.latest_n(readings(spark, sf_dir), 168))


@query(
    "latest_n_per_meter",
    with_readings(
        "SELECT reading_id, ts, usage_kwh, cost_krw FROM readings "
        "QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) <= 24"
    ),
)
def latest_n_per_meter(spark, sf_dir):
    return _slim(relational.latest_n(readings(spark, sf_dir), 24, by=["meter_id"]))


@query(
    "latest_n_per_meter_long",
    with_readings(
        "SELECT reading_id, ts, usage_kwh, cost_krw FROM readings "
        "QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY ts DESC, reading_id DESC) <= 1344"
    ),
)
def latest_n_per_meter_long(spark, sf_dir):
    return _slim(relational.latest_n(readings(spark, sf_dir), 1344, by=["meter_id"]))


@query(
    "top_k",
    with_readings("SELECT reading_id, cost_krw FROM readings ORDER BY cost_krw DESC, reading_id LIMIT 20"),
)
def top_k(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", "cost_krw")
    return relational.top_k(df, "cost_krw", 20, tie=["reading_id"])


@query(
    "pivot_counts",
    with_readings(
        "SELECT CAST(hour(ts) AS INTEGER) AS hour, "
        "count(*) FILTER (work_type = 'Light_Load') AS \"Light_Load\", "
        "count(*) FILTER (work_type = 'Medium_Load') AS \"Medium_Load\", "
        "count(*) FILTER (work_type = 'Maximum_Load') AS \"Maximum_Load\" FROM readings GROUP BY 1"
    ),
)
def pivot_counts(spark, sf_dir):
    return relational.pivot_counts(
        readings(spark, sf_dir),
        [F.hour("ts").alias("hour")],
        "work_type",
        ["Light_Load", "Medium_Load", "Maximum_Load"],
    )


@query(
    "pivot_counts_rest",
    with_readings(
        "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) FILTER (work_type = 'Light_Load') AS \"Light_Load\", "
        "count(*) FILTER (work_type <> 'Light_Load') AS other FROM readings GROUP BY 1"
    ),
)
def pivot_counts_rest(spark, sf_dir):
    hour = F.hour("ts").alias("hour")
    return relational.pivot_counts(readings(spark, sf_dir), [hour], "work_type", ["Light_Load"], rest="other")


@query(
    "align_predictions_of_different_ids",
    with_readings(
        "SELECT reading_id, CASE WHEN reading_id % 3 <> 0 THEN usage_kwh END AS first, "
        "CASE WHEN reading_id % 4 <> 0 THEN cost_krw END AS second FROM readings "
        "WHERE reading_id % 3 <> 0 OR reading_id % 4 <> 0"
    ),
)
def align_predictions_of_different_ids(spark, sf_dir):
    df = readings(spark, sf_dir)
    first = df.filter("reading_id % 3 <> 0").select("reading_id", F.col("usage_kwh").alias("prediction"))
    second = df.filter("reading_id % 4 <> 0").select("reading_id", F.col("cost_krw").alias("prediction"))
    return relational.align_predictions({"first": first, "second": second})


@query(
    "argmin_column",
    with_readings(
        "SELECT reading_id, CASE WHEN reactive_lag_kvarh <= reactive_lead_kvarh "
        "AND reactive_lag_kvarh <= carbon_tco2 THEN 'reactive_lag_kvarh' "
        "WHEN reactive_lead_kvarh <= carbon_tco2 THEN 'reactive_lead_kvarh' "
        "ELSE 'carbon_tco2' END AS smallest FROM readings"
    ),
)
def argmin_column(spark, sf_dir):
    cols = ["reactive_lag_kvarh", "reactive_lead_kvarh", "carbon_tco2"]
    df = relational.argmin_column(readings(spark, sf_dir), cols, "smallest")
    return df.select("reading_id", "smallest")


@query(
    "align_predictions",
    with_readings(
        "SELECT reading_id, usage_kwh * 100 AS first, usage_kwh * 150 AS second, cost_krw AS third "
        "FROM readings"
    ),
)
def align_predictions(spark, sf_dir):
    df = readings(spark, sf_dir)
    value = {"first": F.col("usage_kwh") * 100, "second": F.col("usage_kwh") * 150, "third": F.col("cost_krw")}
    return relational.align_predictions(
        {n: df.select("reading_id", v.alias("prediction")) for n, v in value.items()}
    )
