"""Counts and per-capita ratios of an indicator."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.config import MeasureSpec
from regiofact.operators.joins import join_population
from regiofact.schemas import MEASURE_BASIS, POPULATION_INDICATOR, VALUE_TYPE

# Decimal types for which the products and quotients below keep ten fraction digits or
# more, so that values are rounded once, by the mart's nine. Amounts too large for all 18
# fraction digits (1e14 and more) keep nine.
_AMOUNT, _LARGE = "decimal(32,18)", "decimal(29,9)"
_PERSONS = "decimal(19,9)"
_EXACT = 10**14


def _by_size(amount: Column, calculation: Callable[[Column], Column]) -> Column:
    """A calculation on an amount with all the fraction digits that fit."""
    exact = calculation(amount.cast(_AMOUNT)).cast(VALUE_TYPE)
    large = calculation(amount.cast(_LARGE)).cast(VALUE_TYPE)
    return F.when(F.abs(amount) < _EXACT, exact).otherwise(large)


def _power(basis: int, per: int = 1) -> Column:
    """``basis / per``, a power of ten, as an exact number."""
    return F.lit(Decimal(basis) / Decimal(per))


def _ratio(amount: Column, persons: Column, basis: int) -> Column:
    """``amount * basis / persons``; NULL where there are no persons."""
    # the persons are scaled, which only moves their decimal point
    return _by_size(amount, lambda a: F.try_divide(a, persons * _power(1, basis)))


def population_rows(facts: DataFrame) -> DataFrame:
    """The open population rows of the fact, as used by the measures."""
    return facts.filter(
        (F.col("indicator_id") == POPULATION_INDICATOR) & F.col("knowledge_date_to").isNull()
    ).select("geo_code", "geo_value", "period_ref", "indicator_value_numeric")


def _check(spec: MeasureSpec | None) -> None:
    if spec is None:
        return
    if spec.base != "zahl" and spec.base not in MEASURE_BASIS:
        raise ValueError(f"unknown base measure: {spec.base}")
    unknown = set(spec.calc or ()) - {"zahl", *MEASURE_BASIS}
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")


def _needs_population(spec: MeasureSpec | None) -> bool:
    return spec is not None and (
        spec.base in MEASURE_BASIS or any(m != "zahl" for m in spec.calc or ())
    )


def _measures(spec: MeasureSpec | None) -> Column:
    """The (measure_code, value) pairs of a row, from its value and ``population``."""
    value = F.col("indicator_value_numeric")
    if spec is None:
        out = [(None, value)]
    else:
        per = MEASURE_BASIS.get(spec.base)
        persons = F.col("population").cast(_PERSONS)
        count = value
        if per is not None:
            count = _by_size(value, lambda a: a * (persons * _power(1, per)))
        out = [(spec.base if spec.calc is None else "zahl", count)]
        ratios = [] if spec.calc is None else [m for m in [*spec.calc, spec.base] if m != "zahl"]
        for measure in ratios:
            basis = MEASURE_BASIS[measure]
            if per is None:
                out.append((measure, _ratio(value, persons, basis)))
            else:
                # count * basis / persons with the persons cancelled
                exact = _by_size(value, lambda a: a * _power(basis, per))
                out.append((measure, F.when(persons != 0, exact)))
    return F.array(
        *[
            F.struct(
                F.lit(m).cast("string").alias("measure_code"), v.cast(VALUE_TYPE).alias("value")
            )
            for m, v in out
        ]
    )


def expand_measures(
    facts: DataFrame,
    population: DataFrame,
    spec: MeasureSpec | None | Mapping[int, MeasureSpec | None],
) -> DataFrame:
    """Label or expand the rows by measure.

    Without a spec the measure is NULL (text indicators). With a base only, rows
    are labelled. With ``calc``, every row becomes one ``zahl`` row and one row per
    ratio in ``calc + [base]``. A base given per inhabitants is first turned into
    counts. A mapping from indicator to spec treats many indicators in one pass; those
    not in it have none. The population is joined once, whatever the number of ratios.
    """
    specs = dict(spec) if isinstance(spec, Mapping) else None
    used = list(specs.values()) if specs is not None else [spec]
    for one in used:
        _check(one)
    if specs is None:
        made = _measures(spec)
    else:
        made = _measures(None)
        for one in dict.fromkeys(used):
            members = [i for i, s in specs.items() if s == one]
            made = F.when(F.col("indicator_id").isin(*members), _measures(one)).otherwise(made)
    if any(map(_needs_population, used)):
        rows = join_population(facts, population)
    else:
        rows = facts.withColumn("population", F.lit(None).cast(VALUE_TYPE))
    columns = [c for c in facts.columns if c != "indicator_value_numeric"]
    exploded = rows.select(*columns, F.explode(made).alias("_m"))
    return exploded.withColumns(
        {"indicator_value_numeric": F.col("_m.value"), "measure_code": F.col("_m.measure_code")}
    ).select(*facts.columns, "measure_code")
