"""Pickup of changed resources whose state is committed together with the rows it stands for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.session import materialize
from regiofact.sources.pickup import modified_resources
from regiofact.sources.releases import Release, Save, read_release, released_table, save_parquet, write_release


@dataclass(frozen=True)
class Intake:
    """Rows of resources that are loaded again when they change.

    A load writes the rows of the changed resources, then the state (when each resource was last
    loaded, and in which version its rows are), then the release record that names the state. A
    load that ends early has changed nothing: the next one finds the same resources to load, and
    writes over what was left. Rows that a later load replaced are no longer read.
    """

    spark: SparkSession
    root: str
    name: str

    def state(self, number: int | None = None) -> DataFrame:
        """resource_id, last_execution and loaded_in, as of a release."""
        found = released_table(self.spark, self.root, read_release(self.spark, self.root, number), f"{self.name}/state")
        if found is not None:
            return found
        return self.spark.createDataFrame([], "resource_id string, last_execution timestamp_ntz, loaded_in int")

    def load(
        self, resources: DataFrame, read: Callable[[DataFrame], DataFrame], now: str, save: Save = save_parquet
    ) -> Release:
        """Load what changed since it was last loaded; without changes nothing is written.

        ``resources`` has (resource_id, last_modified); ``read`` makes from the changed ones their
        rows, with their resource_id. One writer at a time.
        """
        last, state = read_release(self.spark, self.root), self.state()
        named = resources.withColumn("resource_id", F.col("resource_id").cast("string"))
        changed = materialize(modified_resources(named, state))
        if changed.isEmpty():
            return last
        save(read(changed).write, f"{self.root}/{self.name}/rows/loaded_in={last.next}")
        done = changed.select(
            "resource_id", F.lit(now).cast("timestamp_ntz").alias("last_execution"), F.lit(last.next).alias("loaded_in")
        )
        kept = state.join(done, "resource_id", "left_anti")
        save(kept.unionByName(done).write, f"{self.root}/{self.name}/state/version={last.next}")
        release = Release(last.next, {**last.tables, f"{self.name}/state": last.next}, last.indicators)
        write_release(self.spark, self.root, release, save)
        return release

    def rows(self, number: int | None = None) -> DataFrame:
        """The rows of every resource from the load that last read it, as of a release, with loaded_in."""
        held = self.state(number).select("resource_id", "loaded_in")
        versions = [r[0] for r in held.select("loaded_in").distinct().collect()]  # as many as loads
        folders = [f"{self.root}/{self.name}/rows/loaded_in={v}" for v in versions]
        written = self.spark.read.option("basePath", f"{self.root}/{self.name}/rows").parquet(*folders)
        return written.join(held, ["resource_id", "loaded_in"], "left_semi")
