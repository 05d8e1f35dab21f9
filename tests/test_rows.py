"""Edge cases on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridtally.functions import calendar, tariff
from gridtally.operators import encoding, evaluate, filters, pricing, relational, report
from gridtally.sources import readings as files


def at(text):
    return dt.datetime.fromisoformat(text)


def frame(spark, rows, schema):
    """Rows with times given as text."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = schema.replace("timestamp_ntz", "string")
    df = spark.createDataFrame(rows, text)
    casts = [c.split()[0] for c in schema.split(", ") if c.endswith("timestamp_ntz")]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in casts}).select(*names)


READING = "reading_id long, meter_id int, ts timestamp_ntz, work_type string, usage_kwh double, cost_krw double, carbon_tco2 double"


def reading(i, ts, usage=1.0, cost=1.0, work_type="Light_Load"):
    return (i, 0, ts, work_type, usage, cost, usage / 1000)


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize(
    "ts, season, band, era, price",
    [
        ("2024-07-01 07:59", "여름", "경부하", "before", 93.1),
        ("2024-07-01 08:00", "여름", "중간부하", "before", 146.3),
        ("2024-07-01 11:00", "여름", "최대부하", "before", 216.6),
        ("2024-07-01 12:00", "여름", "중간부하", "before", 146.3),
        ("2024-07-01 13:00", "여름", "최대부하", "before", 216.6),
        ("2024-07-01 18:00", "여름", "중간부하", "before", 146.3),
        ("2024-07-01 22:00", "여름", "경부하", "before", 93.1),
        ("2024-05-01 13:00", "봄가을", "최대부하", "before", 138.9),
        ("2024-01-01 08:00", "겨울", "중간부하", "before", 146.5),
        ("2024-01-01 09:00", "겨울", "최대부하", "before", 193.4),
        ("2024-01-01 12:00", "겨울", "중간부하", "before", 146.5),
        ("2024-01-01 16:00", "겨울", "최대부하", "before", 193.4),
        ("2024-01-01 19:00", "겨울", "중간부하", "before", 146.5),
        ("2024-01-01 22:00", "겨울", "경부하", "before", 100.4),
        ("2024-10-23 23:45", "봄가을", "경부하", "before", 93.1),
        ("2024-10-24 00:00", "봄가을", "경부하", "after", 110.0),
        ("2024-12-01 10:00", "겨울", "최대부하", "after", 210.3),
    ],
)
def test_unit_price_at_the_edges(spark, ts, season, band, era, price):
    row = pricing.unit_price(frame(spark, [reading(1, ts)], READING)).first()
    assert (row.season, row.band, row.era, row.unit_price) == (season, band, era, price)


def test_rate_table_is_whole(spark):
    table = tariff.rate_table(spark)
    assert table.count() == 162
    assert table.select("plan", "era", "season", "band").distinct().count() == 162
    after = {(r.plan, r.season, r.band): r.price for r in table.filter("era = 'after'").collect()}
    assert after["고압A_선택1", "여름", "경부하"] == 116.4
    assert after["고압B_선택2", "여름", "최대부하"] == 256.0
    assert after["고압C_선택3", "겨울", "최대부하"] == 229.1


def test_nearest_plan_takes_the_first_of_equals(spark):
    # In summer, 고압A_선택2 and 고압A_선택1 off-peak differ; a cost of 0 is nearest to the cheapest.
    rows = [reading(1, "2024-07-01 00:00", 0.0, 5.0), reading(2, "2024-07-01 00:00", 1.0, 0.0)]
    found = pricing.nearest_plan(frame(spark, rows, READING)).orderBy("reading_id")
    assert values(found, "nearest_plan", "nearest_difference") == [
        ("고압A_선택1_before", 5.0),
        ("고압A_선택3_before", 93.1),
    ]


def test_labels_and_weekday_names(spark):
    df = frame(spark, [reading(1, "2024-05-06 13:45"), reading(2, "2024-05-12 00:00")], READING)
    labels = df.orderBy("reading_id").select(
        *[calendar.time_label(u).alias(u) for u in ("hour", "day", "weekday")]
    )
    assert values(labels, "*") == [("05/06 13:00", "05/06", "월요일"), ("05/12 00:00", "05/12", "일요일")]
    with pytest.raises(ValueError):
        calendar.time_label("year")


def test_month_keeps_its_last_day(spark):
    times = ["2024-04-30 23:45", "2024-05-01 00:00", "2024-05-31 23:45", "2024-06-01 00:00"]
    df = frame(spark, [reading(i, t) for i, t in enumerate(times)], READING)
    assert values(filters.in_month(df, "2024-05").orderBy("reading_id"), "reading_id") == [(1,), (2,)]
    assert values(filters.previous_month(df, "2024-05"), "reading_id") == [(0,)]
    both = filters.between(df, "2024-05-01 00:00:00", "2024-06-01 00:00:00")
    assert both.count() == 3


def test_trailing_year_includes_its_first_instant(spark):
    times = ["2023-05-31 23:44", "2023-05-31 23:45", "2024-05-31 23:45"]
    df = frame(spark, [reading(i, t) for i, t in enumerate(times)], READING)
    assert values(filters.trailing_year(df).orderBy("reading_id"), "reading_id") == [(1,), (2,)]


def test_compare_months_counts_empty_months(spark):
    rows = [
        reading(1, "2024-01-10 00:00", 30.0),
        reading(2, "2024-03-10 00:00", 60.0),
    ]
    row = report.compare_months(frame(spark, rows, READING), "2024-03").first()
    assert (row.previous, row.selected, row.yearly_mean, row.change_pct) == (0.0, 60.0, 30.0, 0.0)


def test_first_month_has_no_change(spark):
    df = frame(spark, [reading(1, "2024-01-10 00:00", 30.0, 3.0)], READING)
    row = report.monthly_change(df, "2024-01").first()
    assert (row.usage_change_pct, row.cost_change_pct) == (0.0, 0.0)
    assert report.change_vs_30d(df, "2024-01").first().change_pct == 0.0


def test_ties_take_the_earliest_peak_and_the_first_name(spark):
    rows = [
        reading(3, "2024-01-02 00:00", cost=9.0, work_type="b"),
        reading(2, "2024-01-01 00:00", cost=9.0, work_type="a"),
        reading(1, "2024-01-01 00:00", cost=8.0, work_type="b"),
        reading(4, "2024-01-03 00:00", cost=1.0, work_type="a"),
    ]
    df = frame(spark, rows, READING)
    peak = report.peak_reading(df).first()
    assert (peak.peak_reading_id, peak.peak_cost_krw, peak.peak_weekday) == (2, 9.0, "Monday")
    main = report.main_work_type(df).first()
    assert (main.main_work_type, main.readings, main.share_pct) == ("a", 2, 50.0)


def test_baseline_counts_cut_weeks(spark):
    # 2024-11-01 is a Friday: its week has three days in the month
    rows = [reading(i, f"2024-11-{d:02d} 00:00", float(d)) for i, d in enumerate((1, 1, 2, 4))]
    row = report.baseline(frame(spark, rows, READING), "2024-11").first()
    assert (row.usage_daily, row.usage_weekly, row.usage_monthly) == (8 / 3, 4.0, 8.0)


def test_argmin_takes_the_first_and_skips_nulls(spark):
    df = spark.createDataFrame([(2.0, 1.0, 1.0), (None, 5.0, 7.0)], "a double, b double, c double")
    assert values(relational.argmin_column(df, ["a", "b", "c"]), "argmin") == [("b",), ("b",)]


def test_unseen_label_is_an_error(spark):
    known = spark.createDataFrame([("b",), ("a",)], "kind string")
    labels = encoding.fit_labels(known, "kind")
    coded = encoding.label_encode(known, labels, "kind")
    assert dict(values(coded, "kind", "kind_encoded")) == {"a": 0, "b": 1}
    unseen = spark.createDataFrame([("z",)], "kind string")
    with pytest.raises(PySparkException):
        encoding.label_encode(unseen, labels, "kind").collect()


def test_target_mean_of_ten_rows_has_half_weight(spark):
    rows = [("a", 1.0)] * 10 + [("b", 4.0)] * 5
    df = spark.createDataFrame(rows, "kind string, y double")
    means = dict(values(encoding.fit_target_means(df, "kind", "y"), "kind", "kind_te"))
    assert means["a"] == pytest.approx(0.5 * 1 + 0.5 * 2)


def test_oof_encoding_of_a_lone_category_is_the_global_mean(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (1, "a", 3.0), (2, "b", 5.0)], "i int, kind string, y double")
    out = encoding.target_encode_oof(df, "kind", "y", F.col("i"), smoothing=-1e9)
    assert dict(values(out, "i", "kind_te")) == {0: 3.0, 1: 1.0, 2: 3.0}


def test_column_without_spread_is_only_shifted(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    for fit in (encoding.fit_robust, encoding.fit_standard, encoding.fit_minmax):
        assert values(fit(df, ["x"]).scale(df), "x") == [(0.0,), (0.0,)]


def test_equal_weights_when_no_model_helps(spark):
    df = spark.createDataFrame([(1.0, 9.0, -9.0), (2.0, 9.0, -9.0)], "y double, a double, b double")
    assert values(evaluate.ensemble_weights(df, "y", ["a", "b"]), "a", "b") == [(0.5, 0.5)]


def test_coerce_drops_what_cannot_be_read(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:15:00", "1.5"), ("soon", "1"), ("2024-01-01", "n/a")], "ts string, v string"
    )
    assert values(files.coerce_valid(df, "ts", "v"), "ts", "v") == [(at("2024-01-01 00:15:00"), 1.5)]


def test_first_alias_wins(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`전력사용량(kWh)` double, power_usage double")
    assert files.normalize_columns(df).columns == ["usage_kwh", "power_usage"]
    assert files.resolve_column(df, ["없음", "power"]) == "power_usage"
    assert files.resolve_column(df, ["없음"]) is None


def test_missing_time_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1,)], "id int").write.csv(f"{tmp_path}/x", header=True)
    with pytest.raises(ValueError):
        files.read_readings(spark, f"{tmp_path}/x", "csv")


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    """Another order, other names, a byte order mark, an empty file, folders that are columns, a blank in a name."""
    for name, text in {
        "month=1/a b.csv": "id,datetime,power_usage\n1,2024-01-01 00:15:00,1.5\n",
        "month=2/b.csv": "\ufeff전력사용량(kWh),id,측정일시\n2.5,2,2024-02-01 00:15:00\n",
        "month=2/c.csv": "id,datetime,cost\n3,2024-02-01 00:30:00,7\n",
        "month=2/d.csv": "",
    }.items():
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text, encoding="utf-8")
    df = files.read_readings(spark, str(tmp_path / "in"), "csv")
    assert values(df, "reading_id", "ts", "usage_kwh", "cost_krw", "month") == [
        (1, at("2024-01-01 00:15:00"), 1.5, None, 1),
        (2, at("2024-02-01 00:15:00"), 2.5, None, 2),
        (3, at("2024-02-01 00:30:00"), None, 7.0, 2),
    ]
