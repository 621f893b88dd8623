"""Configuration and tables to the published mart."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.config import AtlasIndicator, CubeFamily, MeasureSpec
from regiofact.operators.dictionaries import extend_dictionary
from regiofact.operators.measures import expand_measures
from regiofact.plans.indicators import build_atlas_indicators, build_cube_indicators
from regiofact.plans.mart import (
    Dictionaries,
    build_mart,
    extend_dictionaries,
    new_dictionaries,
    new_texts,
)
from regiofact.plans.staging import typecast
from regiofact.schemas import GROUPS, INTM, INTM_MEASURED, MART
from regiofact.session import drop_steps, materialize
from regiofact.sources.files import clear_indicators, mart_writer, write_mart
from regiofact.sources.releases import (
    Release,
    Save,
    read_release,
    released_mart,
    released_table,
    save_parquet,
    write_release,
)


def measured(
    facts: DataFrame,
    population: DataFrame,
    spec: MeasureSpec | None | Mapping[int, MeasureSpec | None],
    contract: Mapping[str, str] = INTM_MEASURED,
) -> DataFrame:
    return typecast(expand_measures(facts, population, spec), contract)


def cube_family(
    history: DataFrame,
    family: CubeFamily,
    population: DataFrame,
    contract: Mapping[str, str] = INTM,
    rows: int | None = None,
) -> DataFrame:
    """Cube history to measured indicator rows; ``rows`` is about how many the history has, if known."""
    facts = build_cube_indicators(history, family.indicators, contract, rows)
    return measured(facts, population, family.measure, {**contract, "measure_code": "string"})


def atlas_family(
    v1: DataFrame | None,
    v2: DataFrame | None,
    indicators: Sequence[AtlasIndicator],
    population: DataFrame,
    contract: Mapping[str, str] = INTM,
    rows: int | None = None,
) -> DataFrame:
    """Atlas histories to measured indicator rows, each indicator with its own measures.

    ``rows`` is about how many both histories have, if known.
    """
    facts = build_atlas_indicators(v1, v2, indicators, contract=contract, rows=rows)
    specs = {cfg.indicator_id: cfg.measure for cfg in indicators}
    return measured(facts, population, specs, {**contract, "measure_code": "string"})


def publish(
    parts: Sequence[DataFrame],
    known: Dictionaries,
    path: str,
    contract: Mapping[str, str] = MART,
    indicators: Iterable[int] | None = None,
) -> Dictionaries:
    """Extend the dictionaries by all parts, then write every part to the mart.

    The facts are computed and written once; texts and codes are read from there. With
    ``indicators``, those of the load's configuration, an indicator that has no rows any more
    loses its old ones too.
    """
    facts = materialize(reduce(DataFrame.unionByName, parts))
    held = held_texts(facts)
    dims = extend_dictionaries(known, held)
    by_indicator = rows_by_indicator(held)
    write_mart(build_mart(facts, dims, contract), path, by_indicator)
    if indicators is not None:
        clear_indicators(facts.sparkSession, path, contract, set(indicators) - set(by_indicator))
    drop_steps(facts, held)
    return dims


def held_texts(facts: DataFrame) -> DataFrame:
    """Rows by indicator and texts, written: all that dictionaries and a release ask of the facts."""
    texts = ["source", *[f"group_{n}_{part}" for n in GROUPS for part in ("name", "value")]]
    return materialize(facts.groupBy("indicator_id", *texts).agg(F.count("*").alias("rows")))


def rows_by_indicator(held: DataFrame) -> dict[int, int]:
    """How many rows each indicator has; as many entries as indicators are configured."""
    return dict(held.groupBy("indicator_id").agg(F.sum("rows")).collect())


def released_dictionaries(spark: SparkSession, root: str, release: Release) -> Dictionaries:
    """The dictionaries of a release, or those of an empty warehouse."""
    new = new_dictionaries(spark)
    found = {f.name: released_table(spark, root, release, f"dictionaries/{f.name}") for f in fields(Dictionaries)}
    return Dictionaries(**{n: getattr(new, n) if df is None else df for n, df in found.items()})


def publish_to(
    spark: SparkSession,
    parts: Sequence[DataFrame],
    root: str,
    contract: Mapping[str, str] = MART,
    indicators: Iterable[int] | None = None,
    save: Save = save_parquet,
    written: bool = False,
) -> Release:
    """Publish into a stored warehouse as one release; ids once given are kept over all of them.

    Dictionaries that have new texts, then the facts, are written as new versions, and the record
    that makes them the ones to read is written last. Indicators of other loads stay where
    they are. With ``indicators``, those of the load's configuration, an indicator that has no
    rows any more is in the release no longer. Parts that are ``written``, or plain selections of written
    tables, are read where they are; others are computed and written once. One writer at a time.
    """
    last = read_release(spark, root)
    known = released_dictionaries(spark, root, last)
    facts = reduce(DataFrame.unionByName, parts)
    if not written:
        facts = materialize(facts)
    texts = held_texts(facts)
    fresh = materialize(new_texts(known, texts))
    changed = {r[0] for r in fresh.select("kind").distinct().collect()}  # three kinds
    held = rows_by_indicator(texts)
    tables = dict(last.tables)
    for f in fields(known):
        name = f"dictionaries/{f.name}"
        if f.name in changed or name not in tables:
            dictionary = getattr(known, f.name)
            texts = fresh.filter(F.col("kind") == f.name).select(F.col("text").alias(dictionary.columns[1]))
            save(extend_dictionary(dictionary, texts).write, f"{root}/{name}/version={last.next}")
            tables[name] = last.next
    bound = Release(last.next, tables)
    rows = build_mart(facts, released_dictionaries(spark, root, bound), contract)
    if held:
        save(mart_writer(rows, held), f"{root}/mart/version={last.next}")
    kept = {i: v for i, v in last.indicators.items() if i not in set(indicators or ())}
    release = Release(last.next, tables, kept | dict.fromkeys(held, last.next))
    write_release(spark, root, release, save)
    return release


def released_warehouse(
    spark: SparkSession, root: str, contract: Mapping[str, str] = MART, number: int | None = None
) -> tuple[DataFrame, Dictionaries]:
    """Facts and dictionaries that belong together, of the newest release or an older one."""
    release = read_release(spark, root, number)
    return released_mart(spark, root, release, contract), released_dictionaries(spark, root, release)
