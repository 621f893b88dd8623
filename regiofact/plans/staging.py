"""Raw tables to typed staging tables with keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.functions.dates import year_end
from regiofact.functions.keys import surrogate_key
from regiofact.functions.text import (
    GEO_PARSERS,
    GEO_PATTERNS,
    TAX_MISSING,
    clean_numeric,
    joined_sources,
    mother_path,
    year_range,
)
from regiofact.operators.filters import optional_columns
from regiofact.operators.joins import resolve_by_name
from regiofact.operators.quality import detect_format
from regiofact.operators.reshape import distinct_on, unpivot_text


def stage(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rename and cast: new name -> (source column, type)."""
    return df.select(*[F.col(f"`{src}`").cast(kind).alias(c) for c, (src, kind) in spec.items()])


def typecast(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Columns of a contract in its order; a value that does not fit raises."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in contract.items()])


def restructure_cube(
    df: DataFrame,
    year_column: str = "year",
    geo_column: str = "geo_value_unstructured",
    sources: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    drop: Sequence[str] = (),
    fmt: str | None = None,
) -> DataFrame:
    """Split the area and year texts of a cube load.

    The area format is detected unless given; detection raises where no format
    explains the column. ``transform`` runs first and may be any DataFrame function.
    """
    if transform is not None:
        df = transform(df)
    fmt = fmt or detect_format(df, geo_column, GEO_PATTERNS)
    source = joined_sources(F.col(sources)) if sources else F.lit("unknown")
    out = df.withColumns(
        {
            **GEO_PARSERS[fmt](F.col(geo_column)),
            **year_range(F.col(year_column)),
            "source": source,
        }
    )
    return out.drop(*drop, *([sources] if sources else []))


def last_quarter(df: DataFrame, column: str = "year") -> DataFrame:
    """Quarterly loads: the fourth quarter stands for the year."""
    kept = df.filter(F.col(column).endswith("Q4"))
    return kept.withColumn(column, F.regexp_replace(column, "Q4$", ""))


def stage_cube(
    df: DataFrame,
    grouping: Sequence[str],
    municipalities: DataFrame,
    *,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Typed cube rows with key; missing municipality numbers are found by name.

    Rows need an area number or name, and a value. ``extra`` replaces columns at
    the end, e.g. to strip hierarchy marks from a group.
    """
    key = ["year_from", "year_to", *grouping, "geo_code", "geo_value", "geo_value_name"]
    typed = df.select(
        F.col("year_from").cast("int"),
        F.col("year_to").cast("int"),
        *[F.col(c).cast("string") for c in grouping],
        clean_numeric(F.col("indicator_value")).alias("indicator_value"),
        F.nullif(F.col("geo_code"), F.lit("")).alias("geo_code"),
        F.col("geo_value").cast("int"),
        "geo_value_name",
        "source",
        surrogate_key(*[F.col(c) for c in key]).alias("_surr_key"),
    )
    placed = resolve_by_name(typed, municipalities)
    kept = placed.filter(
        (F.col("geo_value").isNotNull() | F.col("geo_value_name").isNotNull())
        & F.col("indicator_value").isNotNull()
    )
    order = [F.col("indicator_value").desc(), F.col("source").asc_nulls_last()]
    unique = distinct_on(kept, ["_surr_key"], order)
    return unique.withColumns(dict(extra)) if extra else unique


# Fixed names: the columns of a first-generation atlas load.
ATLAS_V1 = {
    "geo_id": ("GEO_ID", "string"),
    "geo_name": ("GEO_NAME", "string"),
    "variable": ("VARIABLE", "string"),
    "value": ("VALUE", "string"),
    "unit": ("UNIT", "string"),
    "status": ("STATUS", "string"),
    "status_desc": ("STATUS_DESC", "string"),
    "desc_val": ("DESC_VAL", "string"),
    "period_ref": ("PERIOD_REF", "string"),
    "source": ("SOURCE", "string"),
    "last_update": ("LAST_UPDATE", "date"),
    "geom_code": ("GEOM_CODE", "string"),
    "geom": ("GEOM", "string"),
    "geom_period": ("GEOM_PERIOD", "date"),
    "map_id": ("MAP_ID", "string"),
    "map_url": ("MAP_URL", "string"),
}
ATLAS_V1_KEY = ["map_id", "geo_id", "variable", "period_ref", "geom_code", "mother_path"]
ATLAS_V1_CHECKED = [
    "unit", "value", "status", "status_desc", "desc_val", "source", "last_update", "geom_period",
]

# Fixed names: the columns of a second-generation atlas load.
ATLAS_V2 = {
    "bfs_indicateur_id": "string",
    "geo_value": "int",
    "geo_name": "string",
    "indicator_value": "decimal(38,18)",
    "group_name": "string",
    "indicator_name": "string",
    "indicator_unit": "string",
    "source": "string",
    "map_id": "string",
    "bfs_nivgeo": "string",
    "period_ref": "string",
    "_source_name": "string",
    "_source_time": "string",
}
ATLAS_V2_KEY = [
    "map_id", "group_name", "geo_value", "bfs_nivgeo", "period_ref", "bfs_indicateur_id",
]


def stage_atlas_v1(df: DataFrame) -> DataFrame:
    """Atlas rows with the path of the ancestors this load carries."""
    names = [f"mother_{i}_{part}" for i in range(5) for part in ("id", "name")]
    mothers = optional_columns(df, names)
    ids = optional_columns(df, [f"mother_{i}_id" for i in range(10)])
    staged = df.select(
        *[F.col(src).cast(kind).alias(c) for c, (src, kind) in ATLAS_V1.items()],
        *mothers,
        mother_path(*[F.col(c) for c in ids]).alias("mother_path"),
    )
    return staged.withColumn("_surrogate_key", surrogate_key(*[F.col(c) for c in ATLAS_V1_KEY]))


def stage_atlas_v2(df: DataFrame) -> DataFrame:
    staged = typecast(df, ATLAS_V2).withColumn("period_ref", F.trim("period_ref"))
    return staged.withColumn("_surrogate_key", surrogate_key(*[F.col(c) for c in ATLAS_V2_KEY]))


# Fixed names: the columns of a municipal-portrait load.
PORTRAIT = {
    "bfs_nr": ("BFS_NR", "int"),
    "set_name": ("SET_NAME", "string"),
    "thema_name": ("THEMA_NAME", "string"),
    "gebiet_name": ("GEBIET_NAME", "string"),
    "subset_name": ("SUBSET_NAME", "string"),
    "einheit_kurz": ("EINHEIT_KURZ", "string"),
    "einheit_lang": ("EINHEIT_LANG", "string"),
    "indikator_id": ("INDIKATOR_ID", "int"),
    "indikator_jahr": ("INDIKATOR_JAHR", "int"),
    "indikator_name": ("INDIKATOR_NAME", "string"),
    "indikator_value": ("INDIKATOR_VALUE", "int"),
}


def stage_portrait(df: DataFrame) -> DataFrame:
    """Portrait rows of municipalities; number 0 stands for larger areas."""
    staged = stage(df, PORTRAIT).filter(F.col("bfs_nr") != 0)
    key = [F.col(c) for c in ("bfs_nr", "indikator_jahr", "indikator_id")]
    return staged.withColumn("_surrogate_key", surrogate_key(*key))


# Fixed names: the columns of the energy-label and second-home loads.
ENERGY_LABEL = {
    "gemeinde": ("Municipality", "string"),
    "gemeinde_bfs_id": ("BfsNumber", "int"),
    "anzahl_minergie": ("Minergie", "int"),
    "anzahl_minergie_eco": ("Minergie_Eco", "int"),
    "anzahl_minergie_a": ("Minergie_A", "int"),
    "anzahl_minergie_a_eco": ("Minergie_A_Eco", "int"),
    "anzahl_minergie_p": ("Minergie_P", "int"),
    "anzahl_minergie_p_eco": ("Minergie_P_Eco", "int"),
}
SECOND_HOMES = {
    "stichtag": "duedate",
    "gemeinde_bfs_id": "gem_no",
    "gemeinde_name": "name",
    "wohnungen": "zwg_3150",
    "erstwohnungen": "zwg_3010",
    "erstwohnung_gleichgestellt": "zwg_3100",
    "anteil_erstwohnung": "zwg_3110",
    "anteil_zweitwohnung": "zwg_3120",
    "verfahren_old": "zwg_3200",
    "verfahren_new": "verfahren",
    "status": "status",
    "geometry": "geometry",
}


def stage_energy_label(df: DataFrame) -> DataFrame:
    return stage(df, ENERGY_LABEL)


def stage_second_homes(df: DataFrame) -> DataFrame:
    staged = df.select(*[F.col(src).alias(c) for c, src in SECOND_HOMES.items()])
    key = surrogate_key(F.col("stichtag"), F.col("gemeinde_bfs_id"))
    return staged.withColumn("_surrogate_key", key)


def stage_tax(
    df: DataFrame,
    keep: Sequence[str],
    drop: Sequence[str],
    geo_code: Column,
    *,
    geo_value: str = "GemeindeID",
    year: str = "Steuerperiode",
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """A wide tax export as long rows; ``NA`` is missing.

    ``geo_code`` is an expression over the kept columns; ``extra`` keeps further ones
    under a new name. Area numbers stay text, since larger areas have none.
    """
    return unpivot_text(df, keep, drop).select(
        geo_code.alias("geo_code"),
        F.col(geo_value).cast("string").alias("geo_value"),
        year_end(F.col(year)).alias("period_ref"),
        *[F.col(src).alias(c) for c, src in (extra or {}).items()],
        "indicator",
        clean_numeric(F.col("indicator_value"), TAX_MISSING).alias("indicator_value_numeric"),
    )


def stage_tax_legal(df: DataFrame) -> DataFrame:
    """Legal persons: every column that is not named here is a measure."""
    return stage_tax(
        df,
        keep=["Typ", "GemeindeID", "Steuerperiode", "Quartil"],
        drop=["Kanton", "KantonID", "Gemeinde"],
        geo_code=F.when(F.col("Typ") == "Gemeinde", "polg"),
        extra={"quartile": "Quartil"},
    )


def stage_tax_natural(df: DataFrame) -> DataFrame:
    """Natural persons: rows without a municipality number are cantons."""
    return stage_tax(
        df,
        keep=["BelastungDBST", "GemeindeID", "Steuerperiode", "Zivilstand"],
        drop=["Kanton", "KantonID", "Gemeindename", "ZivilstandBez"],
        geo_code=F.when(F.col("GemeindeID") == "NA", "kant").otherwise("polg"),
        extra={"belastung_dbst": "BelastungDBST", "zivilstand": "Zivilstand"},
    )
