"""A release binds the tables of one publication: which version of each is to be read.

Tables are written as numbered versions beside the old ones, and a release record naming them is
written last, as one file. Readers start from the newest record, so a publication that ends
early, at whatever point, leaves the state of the record before it; what it wrote has a number that
no record names, and the next publication writes over it. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from regiofact.sources.versions import latest_version

#: How a table is written below a path; a test gives one that fails.
Save = Callable[[DataFrameWriter, str], None]


def save_parquet(writer: DataFrameWriter, path: str) -> None:
    """Write, over what a publication that did not end has left there."""
    writer.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Release:
    """The number of a release, and the version of every table and of every indicator's facts."""

    number: int = 0
    tables: Mapping[str, int] = field(default_factory=dict)
    indicators: Mapping[int, int] = field(default_factory=dict)

    @property
    def next(self) -> int:
        """The number of the release after this one, and of the versions written for it."""
        return self.number + 1


def read_release(spark: SparkSession, root: str, number: int | None = None) -> Release:
    """A release of a warehouse, the newest by default; number 0 before the first."""
    last = latest_version(spark, f"{root}/releases") if number is None else number
    if not last:
        return Release()
    # as many rows as tables and indicators
    rows = spark.read.parquet(f"{root}/releases/version={last}").collect()
    return Release(
        last,
        {r.name: r.held_by for r in rows if r.kind == "table"},
        {int(r.name): r.held_by for r in rows if r.kind == "indicator"},
    )


def write_release(spark: SparkSession, root: str, release: Release, save: Save = save_parquet) -> None:
    """Make a release the newest. Its one file appears as a whole or not at all."""
    rows = [("table", n, v) for n, v in release.tables.items()]
    rows += [("indicator", str(n), v) for n, v in release.indicators.items()]
    record = spark.createDataFrame(rows, "kind string, name string, held_by int").coalesce(1)
    save(record.write, f"{root}/releases/version={release.number}")


def released_table(spark: SparkSession, root: str, release: Release, name: str) -> DataFrame | None:
    """A table as a release has it; None if it has none."""
    version = release.tables.get(name)
    return None if version is None else spark.read.parquet(f"{root}/{name}/version={version}")


def released_mart(
    spark: SparkSession, root: str, release: Release, contract: Mapping[str, str]
) -> DataFrame:
    """The facts of a release. Each indicator is read from the version that last published it."""
    schema = ", ".join(f"{c} {kind}" for c, kind in contract.items())
    kind = contract["indicator_id"]
    by_version: dict[int, list[int]] = {}
    for indicator, version in sorted(release.indicators.items()):
        by_version.setdefault(version, []).append(indicator)
    if not by_version:
        return spark.createDataFrame([], schema)
    folders = [
        f"{root}/mart/version={v}/indicator_id={i}" for v, some in by_version.items() for i in some
    ]
    rest = ", ".join(f"{c} {k}" for c, k in contract.items() if c != "indicator_id")
    reader = spark.read.schema(f"{rest}, version int, indicator_id {kind}")
    return reader.option("basePath", f"{root}/mart").parquet(*folders).select(*contract)


def unused_versions(spark: SparkSession, root: str, keep: int = 1) -> dict[str, list[int]]:
    """Versions by table, the mart among them, that none of the newest ``keep`` releases reads.

    Their folders can be removed once no reader has an older release open.
    """
    last = latest_version(spark, f"{root}/releases") or 0
    releases = [read_release(spark, root, n) for n in range(max(1, last - keep + 1), last + 1)]
    if not releases:
        return {}
    used: dict[str, set[int]] = {"mart": set()}
    for release in releases:
        used["mart"] |= set(release.indicators.values())
        for name, version in release.tables.items():
            used.setdefault(name, set()).add(version)
    unused = {name: sorted(set(range(1, last + 1)) - held) for name, held in used.items()}
    return {name: versions for name, versions in unused.items() if versions}
