"""Publications as one version: readers see the old state until the last write."""

import datetime as dt
from decimal import Decimal

import pytest

from regiofact.plans.mart import decode
from regiofact.plans.warehouse import publish_to, released_warehouse
from regiofact.schemas import INTM_MEASURED, MART
from regiofact.sources.releases import Release, read_release, save_parquet, unused_versions


def facts(spark, rows):
    """(indicator, area, source, group value, number) as measured facts."""
    wide = [
        (
            i, "polg", area, dt.datetime(2021, 1, 1), None, "duedate", "year", None, dt.date(2020, 12, 31), "G" if g else None, g,
            *[None] * 6, Decimal(v), None, source, 1, "zahl",
        )
        for i, area, source, g, v in rows
    ]
    schema = ", ".join(f"{c} {k}" for c, k in INTM_MEASURED.items())
    return spark.createDataFrame(wide, schema)


def seen(spark, root, number=None):
    mart, dims = released_warehouse(spark, root, MART, number)
    rows = decode(mart, dims).select("indicator_id", "geo_value", "source", "group_1_value", "indicator_value_numeric")
    return sorted((r[0], r[1], r[2], r[3], int(r[4])) for r in rows.collect())


FIRST = [(1, 1, "m", "x", 10), (1, 2, "m", None, 20), (2, 1, "n", "y", 30)]
SECOND = [(1, 1, "a", "b", 11), (3, 1, "m", "x", 31)]


class Ended(Exception):
    pass


def ending(writes, how):
    left = [writes]

    def save(writer, path):
        left[0] -= 1
        if left[0] < 0:
            if how == "after":  # the table is there, but nothing that names it
                save_parquet(writer, path)
            raise Ended
        save_parquet(writer, path)

    return save


def test_a_publication_that_ends_early_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "w")
    assert seen(spark, root) == []
    with pytest.raises(Ended):
        publish_to(spark, [facts(spark, FIRST)], root, save=ending(2, "after"))
    assert seen(spark, root) == [] and read_release(spark, root) == Release()
    assert publish_to(spark, [facts(spark, FIRST)], root).number == 1
    assert seen(spark, root) == FIRST
    for writes in range(4):  # two dictionaries, the facts, the record
        for how in ("before", "after") if writes < 3 else ("before",):
            with pytest.raises(Ended):
                publish_to(spark, [facts(spark, SECOND)], root, save=ending(writes, how))
            assert seen(spark, root) == FIRST
    publish_to(spark, [facts(spark, SECOND)], root)
    after = sorted(SECOND + [r for r in FIRST if r[0] == 2])
    assert seen(spark, root) == after
    # the record before still names a state as a whole
    assert seen(spark, root, 1) == FIRST


def test_dictionaries_keep_ids_and_are_written_for_new_texts_only(spark, tmp_path):
    root = str(tmp_path / "w")
    publish_to(spark, [facts(spark, FIRST)], root)
    release = publish_to(spark, [facts(spark, [(5, 1, "m", "x", 1)])], root)
    assert set(release.tables.values()) == {1} and release.indicators == {1: 1, 2: 1, 5: 2}
    release = publish_to(spark, [facts(spark, SECOND)], root)
    assert release.tables == {"dictionaries/source": 3, "dictionaries/group": 1, "dictionaries/group_value": 3}
    _, dims = released_warehouse(spark, root)
    assert sorted(tuple(r) for r in dims.source.collect()) == [(1, "m"), (2, "n"), (3, "a")]


def test_emptied_indicators_and_unused_versions(spark, tmp_path):
    root = str(tmp_path / "w")
    assert unused_versions(spark, root) == {}
    publish_to(spark, [facts(spark, FIRST)], root)
    release = publish_to(spark, [facts(spark, [(1, 1, "a", "x", 5)])], root, indicators=[1, 2])
    assert release.indicators == {1: 2} and seen(spark, root) == [(1, 1, "a", "x", 5)]
    assert unused_versions(spark, root) == {"mart": [1], "dictionaries/source": [1], "dictionaries/group": [2], "dictionaries/group_value": [2]}
    assert unused_versions(spark, root, keep=2) == {"dictionaries/group": [2], "dictionaries/group_value": [2]}
    none = publish_to(spark, [facts(spark, [])], root, indicators=[1])
    assert none.indicators == {} and seen(spark, root) == []
