"""The dictionary-encoded star fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.functions.keys import is_total
from regiofact.operators.dictionaries import (
    collect_texts,
    empty_dictionary,
    extend_dictionary,
    group_value_seed,
)
from regiofact.operators.joins import lookup_column, lookup_join
from regiofact.plans.staging import typecast
from regiofact.schemas import GROUPS, MART
from regiofact.session import materialize


@dataclass(frozen=True)
class Dictionaries:
    """(id, source), (group_id, group_name), (group_value_id, group_value_name)."""

    source: DataFrame
    group: DataFrame
    group_value: DataFrame


def new_dictionaries(spark: SparkSession, id_type: str = "smallint") -> Dictionaries:
    return Dictionaries(
        empty_dictionary(spark, "id", "source", id_type),
        empty_dictionary(spark, "group_id", "group_name", id_type),
        group_value_seed(spark, id_type),
    )


def extend_dictionaries(known: Dictionaries, facts: DataFrame) -> Dictionaries:
    """Dictionaries that cover all texts of the facts; written once, then only read."""
    texts = materialize(collect_texts(facts))

    def extended(dictionary: DataFrame, kind: str) -> DataFrame:
        found = texts.filter(F.col("kind") == kind)
        values = found.select(F.col("text").alias(dictionary.columns[1]))
        return materialize(extend_dictionary(dictionary, values))

    return Dictionaries(
        extended(known.source, "source"),
        extended(known.group, "group"),
        extended(known.group_value, "group_value"),
    )


def new_texts(known: Dictionaries, facts: DataFrame) -> DataFrame:
    """(kind, text) of the facts that no dictionary has yet; kinds are named like the dictionaries."""
    texts = [
        getattr(known, f.name).select(F.lit(f.name).alias("kind"), F.col(getattr(known, f.name).columns[1]).alias("text"))
        for f in fields(known)
    ]
    return collect_texts(facts).join(reduce(DataFrame.unionAll, texts), ["kind", "text"], "left_anti")


def encode(facts: DataFrame, dims: Dictionaries) -> DataFrame:
    """Add the ids of source, group names and group values; unknown texts give NULL."""
    out = lookup_column(facts, dims.source, "source", "source", {"id": "source_id"})
    for n in GROUPS:
        out = lookup_column(
            out, dims.group, f"group_{n}_name", "group_name",
            {"group_id": f"group_{n}_id"},
        )
        out = lookup_column(
            out, dims.group_value, f"group_{n}_value", "group_value_name",
            {"group_value_id": f"group_value_{n}_id"},
        )
    return out


def decode(mart: DataFrame, dims: Dictionaries) -> DataFrame:
    """Add the texts back; rows without a known source drop out."""
    out = lookup_column(
        mart, dims.source, "source_id", "id", {"source": "source"}, "inner"
    )
    for n in GROUPS:
        out = lookup_column(
            out, dims.group, f"group_{n}_id", "group_id",
            {"group_name": f"group_{n}_name"},
        )
        out = lookup_column(
            out, dims.group_value, f"group_value_{n}_id", "group_value_id",
            {"group_value_name": f"group_{n}_value"},
        )
    return out


def build_mart(
    facts: DataFrame, dims: Dictionaries, contract: Mapping[str, str] = MART
) -> DataFrame:
    """Measured indicator rows as star fact."""
    coded = encode(facts, dims).withColumns(
        {f"_group_value_{n}_is_total": is_total(F.col(f"group_value_{n}_id")) for n in GROUPS}
    )
    return typecast(coded, contract)


# Fixed names: the catalogue attributes of an indicator.
CATALOGUE = [
    "indicator_name", "topic_1", "topic_2", "topic_3", "topic_4",
    "indicator_unit", "indicator_description",
]


def join_indicator(facts: DataFrame, seed: DataFrame) -> DataFrame:
    """Add the catalogue attributes; indicators outside the catalogue drop out."""
    side = seed.select("indicator_id", *CATALOGUE)
    return lookup_join(facts, side, ["indicator_id"], "inner")


def available_indicators(mart: DataFrame, seed: DataFrame) -> DataFrame:
    """Indicators per level with their measures, sorted, a NULL measure last."""
    held = mart.groupBy("geo_code", "indicator_id").agg(
        F.array_sort(F.collect_set("measure_code")).alias("_named"),
        F.bool_or(F.col("measure_code").isNull()).alias("_unnamed"),
    )
    unnamed = F.when(F.col("_unnamed"), F.array(F.lit(None).cast("string"))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        join_indicator(held, seed)
        .select(
            "geo_code",
            "indicator_id",
            *CATALOGUE,
            F.concat("_named", unnamed).alias("measure_codes"),
        )
        .orderBy("indicator_id", "geo_code")
    )
