"""The questions users ask of the mart, each answered by one DataFrame."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.functions.text import indicator_label
from regiofact.operators.filters import expand_groups, known_at, knowledge_label, where_set
from regiofact.operators.numbering import page
from regiofact.operators.reshape import distinct_on
from regiofact.plans.geo_dims import (
    add_geometry,
    geometry_column,
    hierarchy,
    join_geo,
)
from regiofact.plans.mart import CATALOGUE, Dictionaries, decode, join_indicator
from regiofact.schemas import GEO_LEVELS, GROUPS


@dataclass(frozen=True)
class Warehouse:
    """The written tables the queries read; ``areas`` holds the latest rows per level."""

    mart: DataFrame
    dictionaries: Dictionaries
    areas: dict[str, DataFrame]
    catalogue: DataFrame

    def chain(self, level: str) -> DataFrame:
        """The areas of a level with their parents."""
        return hierarchy(level, self.areas)


# Fixed names: the columns of an answer, in order.
ANSWER = [
    "indicator_id", "geo_code", "geo_value", "period_type", "period_code", "period_ref_from",
    "period_ref",
    *[f"group_{n}_{part}" for n in GROUPS for part in ("name", "value")],
    "measure_code", "indicator_value_numeric", "indicator_value_text", "source_id", "source",
]
GEO_COLUMNS = {
    "polg": ["geo_name", "bezirk_bfs_id", "bezirk_name", "kanton_bfs_id", "kanton_name"],
    "bezk": ["geo_name", "kanton_bfs_id", "kanton_name"],
    "kant": ["geo_name"],
}


def _check_level(geo_code: str) -> None:
    if geo_code not in GEO_LEVELS:
        raise ValueError(f"unknown level: {geo_code}")


def _answer(
    w: Warehouse,
    rows: DataFrame,
    geo_code: str,
    *,
    knowledge_date: str | None = None,
    measure: str | None = None,
    geo_value: int | None = None,
    period_ref: str | None = None,
    with_indicator: bool = False,
    with_geo: bool = False,
    geometry_mode: str | None = None,
    skip: int | None = None,
    limit: int | None = None,
    expand_all_groups: bool = False,
    expand: tuple[int, ...] = (),
    today: dt.date | None = None,
) -> DataFrame:
    shape = geometry_column(geometry_mode)
    day = dt.date.fromisoformat(period_ref) if period_ref else None
    rows = rows.filter(F.col("geo_code") == geo_code)
    rows = where_set(rows, measure_code=measure, geo_value=geo_value, period_ref=day)
    rows = expand_groups(known_at(rows, knowledge_date), expand_all_groups, *expand)
    out = join_geo(decode(rows, w.dictionaries), w.chain(geo_code))
    columns = [*ANSWER, "knowledge_date"]
    out = out.withColumn(
        "knowledge_date", knowledge_label(knowledge_date, today or dt.date.today())
    )
    if with_indicator:
        out = join_indicator(out, w.catalogue)
        columns += CATALOGUE
    if with_geo:
        columns += GEO_COLUMNS[geo_code]
    order = [
        F.col(c).asc_nulls_last()
        for c in (
            "indicator_id", "geo_value", "period_ref", "measure_code",
            *[f"group_{n}_value" for n in GROUPS],
            "knowledge_date_from", "period_ref_from", "period_type", "source_id",
            "indicator_value_numeric", "indicator_value_text",
        )
    ]
    cut = page(out, order, skip, limit)
    # borders come last: they are neither sorted nor shuffled with the facts
    shown = add_geometry(cut, w.areas[geo_code], geo_code, shape)
    return shown.select(*columns, "geometry")


def get_indicator(w: Warehouse, geo_code: str, indicator_id: int, **options) -> DataFrame:
    """One indicator over all areas of a level.

    Options: ``knowledge_date``, ``measure``, ``geo_value``, ``period_ref``,
    ``with_indicator``, ``with_geo``, ``geometry_mode``, ``skip``, ``limit``,
    ``expand_all_groups``, ``expand`` (group numbers), ``today``. Only group totals are
    returned where nothing is expanded. An unknown indicator gives no rows.
    """
    _check_level(geo_code)
    rows = w.mart.filter(F.col("indicator_id") == indicator_id)
    return _answer(w, rows, geo_code, **options)


def get_portrait(w: Warehouse, geo_code: str, geo_value: int, **options) -> DataFrame:
    """All indicators of one area; options as for one indicator."""
    _check_level(geo_code)
    rows = w.mart.filter(F.col("geo_value") == geo_value)
    return _answer(w, rows, geo_code, **options)


def get_values(
    w: Warehouse,
    geo_code: str,
    measure: str | None = None,
    knowledge_date: str | None = None,
    skip: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The latest number of every indicator and area, totals only.

    The latest is the one that starts last, due dates before periods, then the one
    that ends last; further columns make the choice unique.
    """
    _check_level(geo_code)
    rows = expand_groups(known_at(w.mart.filter(F.col("geo_code") == geo_code), knowledge_date))
    rows = where_set(rows, measure_code=measure)
    latest = distinct_on(
        rows,
        ["indicator_id", "geo_value"],
        [
            F.col("period_ref_from").desc_nulls_first(),
            F.col("period_ref").desc_nulls_last(),
            F.col("measure_code").asc_nulls_last(),
            F.col("knowledge_date_from").desc_nulls_last(),
            F.col("source_id").asc_nulls_last(),
            F.col("period_type").asc_nulls_last(),
            F.col("indicator_value_numeric").asc_nulls_last(),
        ],
    )
    cut = page(latest, [F.col("indicator_id"), F.col("geo_value")], skip, limit)
    return cut.select(
        "indicator_id", "geo_value", "measure_code", "indicator_value_numeric", "source_id"
    )


def get_indicators(available: DataFrame, geo_code: str) -> DataFrame:
    """The catalogue of one level."""
    _check_level(geo_code)
    return available.filter(F.col("geo_code") == geo_code).select(
        "indicator_id", *CATALOGUE, "measure_codes"
    )


def topic_edges(catalogue: DataFrame) -> DataFrame:
    """The topic tree as (parent, child): topic to subtopic, deepest topic to indicator."""
    deepest = F.coalesce("topic_4", "topic_3", "topic_2", "topic_1")
    label = indicator_label(
        F.col("indicator_id"), F.col("indicator_name"), F.col("indicator_unit"),
        F.col("measure_codes"),
    )
    pairs = [(F.col(f"topic_{i}"), F.col(f"topic_{i + 1}")) for i in (1, 2, 3)]
    edges = F.array(
        *[F.struct(p.alias("parent"), c.alias("child")) for p, c in [*pairs, (deepest, label)]]
    )
    out = catalogue.select(F.explode(edges).alias("e")).select("e.parent", "e.child")
    return out.dropna().distinct().orderBy("parent", "child")
