"""Write, audit, publish: rows that break a table's contract are kept apart, and may stop it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.operators.quality import check_unique
from regiofact.session import materialize
from regiofact.sources.releases import Release, Save, read_release, save_parquet, write_release


@dataclass(frozen=True)
class Contract:
    """What every row of a table must keep to.

    ``unique`` lists keys; a key with a NULL in it is not compared. ``allowed`` is how many rows
    may break the contract before the table is not published; None is any number.
    """

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    between: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    allowed: int | None = 0


class ContractBroken(Exception):
    """More rows break the contract than it allows; they are in the quarantine of this number."""

    def __init__(self, number: int, broken: int):
        super().__init__(f"{broken} rows break the contract, see quarantine {number}")
        self.number, self.broken = number, broken


def audited(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows with ``_broken``, the names of the rules that each one breaks, in order.

    Which of the rows of a repeated key is right is not known, so each of them breaks the rule.
    Repeated keys are written before the rows meet them, so a hot one is split.
    """
    rules = [F.when(F.col(c).isNull(), F.lit(f"not_null {c}")) for c in contract.not_null]
    for c, (low, high) in contract.between.items():
        rules.append(F.when((F.col(c) < low) | (F.col(c) > high), F.lit(f"between {c}")))
    out = df
    for n, key in enumerate(contract.unique):
        repeated = materialize(check_unique(df.dropna(subset=list(key)), list(key)).select(*key))
        out = out.join(repeated.withColumn(f"_repeated_{n}", F.lit(True)), list(key), "left")
        rules.append(F.when(F.col(f"_repeated_{n}"), F.lit(f"unique {','.join(key)}")))
    broken = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], broken.alias("_broken"))


def publish_audited(
    df: DataFrame, contract: Contract, root: str, name: str, save: Save = save_parquet
) -> Release:
    """Write a table once, sound rows and quarantine side by side, and publish it if the contract lets it.

    If it does not, readers keep the table they have, and the rows that are to blame can be read from
    the quarantine. Other tables of the warehouse stay what they are.
    """
    spark, last = df.sparkSession, read_release(df.sparkSession, root)
    path = f"{root}/{name}/version={last.next}"
    checked = audited(df, contract).withColumn("_sound", (F.size("_broken") == 0).cast("int"))
    save(checked.write.partitionBy("_sound"), path)
    broken = spark.read.schema(checked.schema).parquet(path).filter("_sound = 0").count()
    if contract.allowed is not None and broken > contract.allowed:
        raise ContractBroken(last.next, broken)
    release = Release(last.next, {**last.tables, name: last.next}, last.indicators)
    write_release(spark, root, release, save)
    return release


def sound_rows(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """The rows of a published table that keep its contract, as of a release."""
    version = read_release(spark, root, number).tables[name]
    return spark.read.parquet(f"{root}/{name}/version={version}").filter("_sound = 1").drop("_sound", "_broken")


def quarantine(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """The rows of a written version that break the contract, with the rules they break.

    The version need not have been published.
    """
    return spark.read.parquet(f"{root}/{name}/version={version}").filter("_sound = 0").drop("_sound")


def broken_rules(rows: DataFrame) -> DataFrame:
    """How many rows break each rule: rule, n_records."""
    return rows.select(F.explode("_broken").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_records"))


def both_sides(sound: DataFrame, apart: DataFrame) -> DataFrame:
    """Sound rows and quarantined ones in one table; ``_broken`` is empty for sound ones."""
    none = F.array().cast("array<string>").alias("_broken")
    return reduce(DataFrame.unionByName, [sound.select("*", none), apart])
