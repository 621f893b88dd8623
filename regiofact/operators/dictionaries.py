"""Append-only dictionaries of sources, group names and group values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.operators.numbering import number_rows
from regiofact.schemas import GROUP_TOTAL, GROUP_TOTAL_ID, GROUPS


def collect_values(facts: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct non-NULL values over several columns, in one pass."""
    return (
        facts.select(F.explode(F.array(*columns)).alias(name)).filter(F.col(name).isNotNull())
    ).distinct()


def collect_group_values(facts: DataFrame) -> DataFrame:
    return collect_values(facts, [f"group_{n}_value" for n in GROUPS], "group_value_name")


def collect_texts(facts: DataFrame) -> DataFrame:
    """Distinct sources, group names and group values as (kind, text), in one pass.

    Only the different combinations of texts are taken apart, not every row.
    """
    columns = {"source": ["source"]}
    for kind, part in (("group", "name"), ("group_value", "value")):
        columns[kind] = [f"group_{n}_{part}" for n in GROUPS]
    facts = facts.select(*[c for names in columns.values() for c in names]).distinct()
    pairs = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(c).alias("text"))
            for kind, names in columns.items()
            for c in names
        ]
    )
    return facts.select(F.explode(pairs).alias("p")).select("p.*").dropna().distinct()


def empty_dictionary(
    spark: SparkSession, id_name: str, name: str, id_type: str = "smallint"
) -> DataFrame:
    return spark.createDataFrame([], f"{id_name} {id_type}, {name} string")


def group_value_seed(spark: SparkSession, id_type: str = "smallint") -> DataFrame:
    """The group-value dictionary starts with the reserved total."""
    return spark.createDataFrame(
        [(GROUP_TOTAL_ID, GROUP_TOTAL)], "group_value_id int, group_value_name string"
    ).withColumn("group_value_id", F.col("group_value_id").cast(id_type))


def extend_dictionary(dictionary: DataFrame, values: DataFrame) -> DataFrame:
    """Give new values the next ids; known values keep theirs.

    New ids follow the order of the values, so one and the same input always gives
    the same dictionary. Ids beyond the id type raise. One writer at a time: write
    the result as a new version, then switch to it.
    """
    id_name, name = dictionary.columns
    id_type = dictionary.schema[id_name].dataType
    fresh = values.select(name).filter(F.col(name).isNotNull()).distinct()
    fresh = fresh.join(dictionary.select(name), name, "left_anti")
    numbered = number_rows(fresh, [F.col(name).asc()], "_position")
    last = dictionary.agg(F.coalesce(F.max(id_name).cast("bigint"), F.lit(0)).alias("m")).scalar()
    added = numbered.select((last + F.col("_position")).cast(id_type).alias(id_name), name)
    return dictionary.unionByName(added)
