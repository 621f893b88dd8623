"""Staged tables and histories to the long indicator fact.

All indicators configured over one table come out of a single pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.config import (
    AtlasIndicator,
    CubeIndicator,
    PortraitIndicator,
    WideIndicators,
)
from regiofact.functions.dates import period_bounds, year_end
from regiofact.operators.filters import known_level, publishable
from regiofact.operators.history import VALID_FROM, VALID_TO, backfill_window, current_rows
from regiofact.operators.joins import map_code
from regiofact.operators.reshape import distinct_on, melt
from regiofact.operators.rules import TESTS, Options, any_of, apply_rules, rule_table, tests_hold, tests_of
from regiofact.operators.totals import build_totals, group_columns, map_total
from regiofact.plans.staging import typecast
from regiofact.schemas import GROUPS, INTM, KEY_NOGROUPS, VALUE_TYPE


def _no_groups() -> dict[str, Column]:
    return {
        f"group_{n}_{part}": F.lit(None).cast("string") for n in GROUPS for part in ("name", "value")
    }


def route_value(c: Column, is_numeric: bool) -> dict[str, Column]:
    """A value goes to the number or to the text column, the other is NULL."""
    number = c if is_numeric else F.lit(None)
    text = F.lit(None) if is_numeric else c
    return {
        "indicator_value_numeric": number.cast(VALUE_TYPE),
        "indicator_value_text": text.cast("string"),
    }


def routed_value(c: Column, is_numeric: Column) -> dict[str, Column]:
    """The same where a rule's data says which; only values that go to the number are cast."""
    return {
        "indicator_value_numeric": F.when(is_numeric, c.cast(VALUE_TYPE)),
        "indicator_value_text": F.when(~is_numeric, c.cast("string")),
    }


def build_cube_indicators(
    history: DataFrame,
    indicators: Sequence[CubeIndicator],
    contract: Mapping[str, str] = INTM,
    rows: int | None = None,
) -> DataFrame:
    """Indicators of a cube history, with the configured group totals.

    Indicators that need the same kind of total, or none, share one pass. Their filters are
    resolved on the distinct values of the columns they look at. ``rows`` is about how many the
    history has, if known.
    """
    families: dict[tuple[int, str] | None, list[CubeIndicator]] = {}
    for cfg in indicators:
        kind = (len(cfg.grouping), cfg.build_total_value) if cfg.build_total_value else None
        families.setdefault(kind, []).append(cfg)

    parts = []
    for kind, members in families.items():
        taken = _cube_rows(history, members)
        many = None if rows is None else rows * len(members)
        parts.append(build_totals(taken, *kind, many) if kind else taken)
    out = reduce(DataFrame.unionByName, parts).filter(publishable())
    return typecast(out.withColumn("_etl_version", F.lit(1)), contract)


def _cube_rows(history: DataFrame, cfgs: Sequence[CubeIndicator]) -> DataFrame:
    shapes = Options()
    rules = rule_table(
        history.sparkSession,
        [
            (
                c.indicator_id, c.period_type, c.period_code, c.is_numeric,
                shapes.number((tuple(c.grouping), c.build_total_value)), tests_of(c.filter_and),
            )
            for c in cfgs
        ],
        f"indicator_id int, period_type string, period_code string, is_numeric boolean, shape int, {TESTS}",
    )
    names = sorted({f.column for c in cfgs for f in c.filter_and})
    rows = apply_rules(history, names, rules, lambda r: tests_hold(r["tests"], names))
    rule = F.col("_rule")
    groups = {name: shapes.choose(rule["shape"], lambda s, name=name: group_columns(*s)[name]) for name in _no_groups()}
    period = rule["period_type"]
    bounds = {kind: period_bounds(F.col("year_from"), F.col("year_to"), kind) for kind in sorted({c.period_type for c in cfgs})}
    dates = {
        name: reduce(lambda c, k, name=name: F.when(period == k, bounds[k][name]).otherwise(c), bounds, F.lit(None).cast("date"))
        for name in ("period_ref_from", "period_ref")
    }
    numeric = rule["is_numeric"]
    return rows.select(
        rule["indicator_id"].alias("indicator_id"), "geo_code", "geo_value",
        F.col(VALID_FROM).alias("knowledge_date_from"), F.col(VALID_TO).alias("knowledge_date_to"),
        rule["period_type"].alias("period_type"), rule["period_code"].alias("period_code"),
        *[c.alias(n) for n, c in {**dates, **groups, **routed_value(F.col("indicator_value"), numeric)}.items()],
        "source",
    )


def _dates(options: Options, index: Column, default: Column) -> Column:
    """The date that the expression of a rule makes, or the default where it has none."""
    return options.choose(index, lambda text: (F.expr(text) if text else default).cast("date"))


def _atlas_rows(rows: DataFrame, version: int, **own: Column) -> DataFrame:
    rule = F.col("_rule")
    columns = {
        "indicator_id": rule["indicator_id"],
        "geo_code": own["geo_code"],
        "geo_value": own["geo_value"].cast("int"),
        "knowledge_date_from": F.col(VALID_FROM),
        "knowledge_date_to": own.get("until", F.col(VALID_TO)),
        "period_type": rule["period_type"],
        "period_code": rule["period_code"],
        "period_ref_from": own["period_ref_from"],
        "period_ref": own["period_ref"],
        **{name: own.get(name, c) for name, c in _no_groups().items()},
        "indicator_value_numeric": own["indicator_value_numeric"],
        "indicator_value_text": own["indicator_value_text"],
        "source": F.col("source"),
        "_etl_version": F.lit(version),
    }
    return rows.select(*[c.alias(name) for name, c in columns.items()])


_PERIODS = "indicator_id int, period_type string, period_code string, since int, until int"


def _atlas_v1(v1: DataFrame, v2: DataFrame | None, cfgs: Sequence[AtlasIndicator]) -> DataFrame:
    end, spark = F.col(VALID_TO), v1.sparkSession
    rows = v1.filter(known_level(F.col("geom_code")))
    if v2 is not None:
        begin = v2.agg(F.min(VALID_FROM).alias("begin")).scalar()
        rows = rows.withColumn("_until", F.coalesce(end, begin))
    else:
        rows = rows.withColumn("_until", end)
    since, until, values = Options(), Options(), Options()
    rules = rule_table(
        spark,
        [
            (
                c.indicator_id, c.period_type, c.period_code, since.number(c.v1.period_ref_from), until.number(c.v1.period_ref),
                c.v1.indicator_regex, list(c.v1.path_regex), values.number(c.v1.value_col), not c.v1.value_is_text, c.v2 is not None,
            )
            for c in cfgs
        ],
        f"{_PERIODS}, regex string, paths array<string>, value int, is_numeric boolean, goes_on boolean",
    )
    taken = apply_rules(
        rows, ["variable", "mother_path"], rules,
        lambda r: F.rlike(F.col("variable"), r["regex"]) & any_of(F.col("mother_path"), r["paths"]),
    )
    rule = F.col("_rule")
    # exact duplicates need no extra pass: the final choice per key drops them
    return _atlas_rows(
        taken, 1,
        geo_code=F.col("geom_code"),
        geo_value=F.col("geo_id"),
        # only indicators that go on in the second generation end with the first
        until=F.when(rule["goes_on"], F.col("_until")).otherwise(end),
        period_ref_from=_dates(since, rule["since"], F.lit(None)),
        period_ref=_dates(until, rule["until"], F.col("period_ref")),
        **routed_value(values.choose(rule["value"], lambda name: F.col(name).cast("string")), rule["is_numeric"]),
    )


def _atlas_v2(v2: DataFrame, cfgs: Sequence[AtlasIndicator], n: int | None) -> DataFrame:
    wanted = sorted({c.v2.indicateur_id for c in cfgs})
    rows = v2.filter(
        F.col("bfs_indicateur_id").isin(*wanted) & known_level(F.col("bfs_nivgeo"), prefix=True)
    )
    one = distinct_on(
        rows,
        ["bfs_indicateur_id", "geo_value", "group_name", "period_ref", VALID_FROM],
        [
            F.col("bfs_nivgeo").desc_nulls_first(),
            F.col("map_id").desc_nulls_first(),
            F.col("indicator_value").desc_nulls_last(),
        ],
        n,
    )
    since, until = Options(), Options()
    rules = rule_table(
        v2.sparkSession,
        [
            (
                c.indicator_id, c.period_type, c.period_code, since.number(c.v2.period_ref_from), until.number(c.v2.period_ref),
                c.v2.indicateur_id, c.v2.grouping.name if c.v2.grouping else None,
                (c.v2.grouping.total_value or "totvars") if c.v2.grouping else None,
            )
            for c in cfgs
        ],
        f"{_PERIODS}, id string, group_name string, total string",
    )
    # a source's id is all that a rule looks at
    named = rules.select(F.struct(*rules.columns).alias("_rule"))
    taken = one.join(named, F.col("bfs_indicateur_id") == F.col("_rule.id"))
    rule = F.col("_rule")
    return _atlas_rows(
        taken, 2,
        geo_code=F.left(F.col("bfs_nivgeo"), F.lit(4)),
        geo_value=F.col("geo_value"),
        period_ref_from=_dates(since, rule["since"], F.lit(None)),
        period_ref=_dates(until, rule["until"], F.col("period_ref")),
        group_1_name=rule["group_name"],
        group_1_value=F.when(rule["total"].isNotNull(), map_total(F.col("group_name"), rule["total"])),
        **route_value(F.col("indicator_value"), True),
    )


def build_atlas_indicators(
    v1: DataFrame | None,
    v2: DataFrame | None,
    indicators: Sequence[AtlasIndicator],
    keys: Sequence[str] = tuple(KEY_NOGROUPS),
    contract: Mapping[str, str] = INTM,
    rows: int | None = None,
) -> DataFrame:
    """Indicators over both atlas generations, one row per key.

    Where both generations have a row the second wins. The default key has no
    groups, so groups collapse, the total first; add the group values to ``keys`` to
    keep them. ``rows`` is about how many both histories have, if known.
    """
    first = [c for c in indicators if c.v1 is not None]
    second = [c for c in indicators if c.v2 is not None]
    parts = []
    if first:
        parts.append(_atlas_v1(v1, v2 if second else None, first))
    if second:
        parts.append(_atlas_v2(v2, second, rows))
    out = reduce(DataFrame.unionByName, parts)
    order = [
        F.col("_etl_version").desc(),
        F.when(F.coalesce("group_1_value", F.lit("GROUP TOTAL")) == "GROUP TOTAL", 0).otherwise(1),
        F.col("group_1_value").asc_nulls_first(),
        F.col("knowledge_date_to").desc_nulls_first(),
        F.col("indicator_value_numeric").desc_nulls_last(),
        F.col("indicator_value_text").desc_nulls_last(),
        F.col("source").asc_nulls_last(),
    ]
    return typecast(distinct_on(out, list(keys), order, rows), contract)


def build_portrait_indicators(
    history: DataFrame,
    indicators: Mapping[int, PortraitIndicator],
    source: str = "Gemeindeportrait des Kantons Zürich",
    contract: Mapping[str, str] = INTM,
) -> DataFrame:
    """Portrait indicators from the open rows: source indicator number -> indicator."""

    rules = rule_table(
        history.sparkSession,
        [(n, c.indicator_id, c.period_type, c.period_code) for n, c in indicators.items()],
        "_number int, indicator_id int, period_type string, period_code string",
    )
    rows = current_rows(history).join(rules, F.col("indikator_id") == F.col("_number"))
    columns = {
        "geo_code": F.lit("polg"),
        "geo_value": F.col("bfs_nr"),
        "knowledge_date_from": F.col(VALID_FROM),
        "knowledge_date_to": F.col(VALID_TO),
        "period_ref_from": F.lit(None).cast("date"),
        "period_ref": year_end(F.col("indikator_jahr")),
        **_no_groups(),
        **route_value(F.col("indikator_value"), True),
        "source": F.lit(source),
        "_etl_version": F.lit(1),
    }
    kept = ["indicator_id", "period_type", "period_code"]
    return typecast(rows.select(*kept, *[c.alias(n) for n, c in columns.items()]), contract)


def build_wide_indicators(
    history: DataFrame, cfg: WideIndicators, contract: Mapping[str, str] = INTM
) -> DataFrame:
    """One indicator per measure column of a history; ``period_ref`` is an expression."""
    base = history.select(
        F.lit("polg").alias("geo_code"),
        F.col(cfg.geo_value).alias("geo_value"),
        F.col(VALID_FROM).alias("knowledge_date_from"),
        F.col(VALID_TO).alias("knowledge_date_to"),
        F.lit(cfg.period_type).alias("period_type"),
        F.lit(cfg.period_code).alias("period_code"),
        F.expr(cfg.period_ref).cast("date").alias("period_ref"),
        F.lit(cfg.source).alias("source"),
        *cfg.columns,
    )
    ids = [c for c in base.columns if c not in cfg.columns]
    long = melt(base, ids, cfg.columns).withColumns(
        {
            "period_ref_from": F.lit(None).cast("date"),
            **_no_groups(),
            "indicator_value_text": F.lit(None).cast("string"),
            "_etl_version": F.lit(1),
        }
    )
    return typecast(long, contract)


# Indicator numbers of the tax measures of legal persons.
TAX_LEGAL = {
    "Anzahl": 106,
    "Eigenkapital": 107,
    "Reingewinn": 108,
    "Steuer": 109,
    "DurchschnittProzentAbzugBeteiligung": 110,
}
# Indicator numbers of the tax measures of natural persons.
TAX_NATURAL = {
    "AnzahlSteuerpflichtige": 111,
    "AnzahlSteuerpflichtigeohneSteuer": 112,
    "DurchschnittReineinkommen": 113,
    "DurchschnittReinesAequivalenzeinkommen": 114,
    "DurchschnittSteuerbaresAequivalenzeinkommen": 115,
    "DurchschnittSteuerbaresEinkommen": 116,
    "DurchschnittSteuerbetrag": 117,
    "EinnahmenDBST": 118,
    "GiniReineinkommen": 119,
    "GiniReineinkommenAeq": 120,
    "GiniSteuerbaresAequivalenzeinkommen": 121,
    "GiniSteuerbareseinkommen": 122,
    "GiniSteuerbetrag": 123,
    "MedianReineinkommen": 124,
    "MedianReinesAequivalenzeinkommen": 125,
    "MedianSteuerbaresAequivalenzeinkommen": 126,
    "MedianSteuerbaresEinkommen": 127,
    "MedianSteuerbetrag": 128,
}
# The rows of the natural-person table that are published.
ALL_TAXPAYERS = "Steuerpflichtige mit und ohne einer Belastung durch die direkte Bundessteuer"
ALL_CIVIL_STATES = "T"
# Labels and first load day of the tax source.
TAX_SOURCE = "Eidgenössische Steuerverwaltung ESTV"
TAX_KNOWN_SINCE = "2025-01-23"


def build_tax_indicators(
    staged: DataFrame,
    mapping: Mapping[str, int],
    condition: Column | None = None,
    source: str = TAX_SOURCE,
    known_since: str = TAX_KNOWN_SINCE,
    contract: Mapping[str, str] = INTM,
) -> DataFrame:
    """Tax measures by code, all known since one fixed day."""
    rows = staged if condition is None else staged.filter(condition)
    coded = backfill_window(map_code(rows, "indicator", dict(mapping)), known_since)
    out = coded.withColumns(
        {
            "period_type": F.lit("duedate"),
            "period_code": F.lit("year"),
            "period_ref_from": F.lit(None).cast("date"),
            **_no_groups(),
            "indicator_value_text": F.lit(None).cast("string"),
            "source": F.lit(source),
            "_etl_version": F.lit(1),
        }
    )
    return typecast(out, contract)


def build_tax_legal(staged: DataFrame, contract: Mapping[str, str] = INTM) -> DataFrame:
    """Legal persons over all quartiles."""
    rows = F.col("quartile").isNull()
    return build_tax_indicators(staged, TAX_LEGAL, rows, contract=contract)


def build_tax_natural(staged: DataFrame, contract: Mapping[str, str] = INTM) -> DataFrame:
    """Natural persons of all civil states, with and without federal tax, by municipality."""
    rows = (
        (F.col("zivilstand") == ALL_CIVIL_STATES)
        & (F.col("geo_code") == "polg")
        & (F.col("belastung_dbst") == ALL_TAXPAYERS)
    )
    return build_tax_indicators(staged, TAX_NATURAL, rows, contract=contract)


# Indicator numbers and sources of the two wide tables.
ENERGY_LABEL_INDICATORS = WideIndicators(
    columns={
        "anzahl_minergie": 95,
        "anzahl_minergie_eco": 96,
        "anzahl_minergie_a": 97,
        "anzahl_minergie_a_eco": 98,
        "anzahl_minergie_p": 99,
        "anzahl_minergie_p_eco": 100,
    },
    geo_value="gemeinde_bfs_id",
    period_ref=VALID_FROM,
    source="Bundesamt für Energie BFE",
)
SECOND_HOME_INDICATORS = WideIndicators(
    columns={
        "wohnungen": 101,
        "erstwohnungen": 102,
        "erstwohnung_gleichgestellt": 103,
        "anteil_erstwohnung": 104,
        "anteil_zweitwohnung": 105,
    },
    geo_value="gemeinde_bfs_id",
    period_ref="stichtag",
    source="Wohnungsinventar - Bundesamt für Raumentwicklung",
)
