"""Pickup whose state is committed with its rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regiofact.plans.intake import Intake
from regiofact.sources.releases import save_parquet


def listed(spark, **days):
    rows = [(k, dt.datetime(2024, 1, d)) for k, d in days.items()]
    return spark.createDataFrame(rows, "resource_id string, last_modified timestamp_ntz")


def test_a_restart_loads_nothing_twice(spark, tmp_path):
    intake, read = Intake(spark, str(tmp_path / "w"), "t"), []

    def rows_of(n):
        def made(changed):
            read.append(sorted(r.resource_id for r in changed.collect()))
            return changed.select("resource_id", F.explode(F.array(F.lit(n), F.lit(n + 1))).alias("v"))

        return made

    intake.load(listed(spark, a=1, b=1), rows_of(10), "2024-01-02")
    seen = lambda number=None: sorted((r.resource_id, r.v, r.loaded_in) for r in intake.rows(number).collect())
    first = [("a", 10, 1), ("a", 11, 1), ("b", 10, 1), ("b", 11, 1)]
    assert seen() == first
    later = listed(spark, a=1, b=5, c=5)
    for writes in range(3):
        left = [writes]

        def save(writer, path, left=left):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("ended")
            save_parquet(writer, path)

        with pytest.raises(RuntimeError):
            intake.load(later, rows_of(50), "2024-01-06", save)
        assert seen() == first
    assert intake.load(later, rows_of(20), "2024-01-06").number == 2
    after = [("a", 10, 1), ("a", 11, 1), ("b", 20, 2), ("b", 21, 2), ("c", 20, 2), ("c", 21, 2)]
    assert seen() == after and seen(1) == first
    assert intake.load(later, rows_of(30), "2024-01-07").number == 2 and seen() == after
    assert read == [["a", "b"]] + [["b", "c"]] * 4
