"""Positions of a table that grows by sorted runs, against a sort of all its rows."""

import datetime as dt
import random

import pytest

from gridtally.operators.ordered import Series
from gridtally.operators.runs import SortedRuns
from gridtally.session import folders, scratch_path

SERIES = Series(("meter_id",), ("ts", "id"))
SCHEMA = "id long, meter_id int, ts timestamp_ntz, x double"


def rows(start, count, first_id, seed):
    """Meter 0 owns most rows, some have no meter, many share an instant."""
    draw = random.Random(seed)
    return [
        (first_id + i, draw.choice([0, 0, 0, 1, 2, None]), start + dt.timedelta(hours=draw.randrange(count // 3)), float(i))
        for i in range(count)
    ]


def plain(data):
    low, out, seen = dt.datetime.min, {}, {}
    for i, meter, ts, _ in sorted(data, key=lambda r: (r[2] or low, r[0])):
        out[i] = seen[meter] = seen.get(meter, -1) + 1
    return out


def stored(runs):
    return {r.id: r.position for r in runs.positions().collect()}


def test_parts_in_any_order_are_only_sorted_themselves(spark):
    runs = SortedRuns(spark, scratch_path(spark, "runs"), SERIES, partition_rows=100)
    first = rows(dt.datetime(2024, 1, 1), 300, 0, 1)
    later = rows(dt.datetime(2024, 6, 1), 200, 1000, 2)
    between = rows(dt.datetime(2024, 3, 1), 200, 2000, 3)
    data, names = [], set()
    for part in (first, later, between):
        assert runs.append(spark.createDataFrame(part, SCHEMA)) == []
        data += part
        assert stored(runs) == plain(data)
        (new,) = {p.split("/")[-1] for p in folders(spark, f"{runs.path}/runs/*")} - names
        names.add(new)
        # the new run holds the part and nothing else
        assert spark.read.parquet(f"{runs.path}/runs/{new}").count() == len(part)
    assert len(folders(spark, f"{runs.path}/runs/*/part-*")) >= 3 + 2 + 2


def test_late_rows_sort_only_the_runs_they_reach_into(spark):
    runs = SortedRuns(spark, scratch_path(spark, "runs"), SERIES)
    first, second = rows(dt.datetime(2024, 1, 1), 120, 0, 4), rows(dt.datetime(2024, 6, 1), 120, 1000, 5)
    for part in (first, second):
        runs.append(spark.createDataFrame(part, SCHEMA))
    kept = {p.split("/")[-1] for p in folders(spark, f"{runs.path}/runs/*")}
    late = [(5000, 0, dt.datetime(2024, 6, 1, 10, 30), 1.0), (5001, 9, dt.datetime(2024, 1, 1), 1.0), (5002, 0, None, 2.0)]
    again = runs.append(spark.createDataFrame(late[:2], SCHEMA))
    assert len(again) == 1 and set(again) < kept
    # a row without a time comes first of all and reaches from there to its last row
    assert runs.append(spark.createDataFrame(late[2:], SCHEMA)) == []
    assert stored(runs) == plain(first + second + late)
    assert runs.vacuum() == 1 + 3
    assert stored(runs) == plain(first + second + late)


def test_empty_parts_repeated_rows_and_one_series(spark):
    runs = SortedRuns(spark, scratch_path(spark, "runs"), Series((), ("ts",)))
    with pytest.raises(ValueError):
        runs.positions()
    assert runs.append(spark.createDataFrame([], SCHEMA)) == [] and runs.directory() is None
    part = rows(dt.datetime(2024, 1, 1), 60, 0, 6)
    for _ in range(2):
        runs.append(spark.createDataFrame(part, SCHEMA))
    found = runs.positions().orderBy("position").collect()
    assert [r.position for r in found] == list(range(120))
    assert [r.ts for r in found] == sorted(r[2] for r in part + part)
    with pytest.raises(ValueError):
        runs.append(spark.createDataFrame([(1, 2)], "_place long, ts long"))
