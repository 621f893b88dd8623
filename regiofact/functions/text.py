"""Column functions for loosely typed source text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiofact.schemas import VALUE_TYPE

# How the sources spell a missing number.
CUBE_MISSING = ('"..."', '"...."', '"....."', '"......"', "")
TAX_MISSING = ("NA",)

# Fixed patterns of the geographic labels.
DOT_NOTATION = r"^(?:Schweiz|Ohne Angabe|-|>>|<<|(?:\.\.\.\.\.\.\d*))(?:.*)"
LEADING_NUMBER = r"(?U)^(?:(?:\d+)(?:\s\w+).*|Schweiz)$"
GEO_PATTERNS = {"dot_notation": DOT_NOTATION, "leading_number": LEADING_NUMBER}


def regex_find(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, NULL where there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def matches_at_start(c: Column, pattern: str) -> Column:
    """Regex predicate anchored at the start only."""
    return c.rlike(f"^(?:{pattern})")


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_numeric(
    c: Column, missing: Sequence[str] = CUBE_MISSING, kind: str = VALUE_TYPE
) -> Column:
    """Missing-value marks become NULL; anything else must be a number."""
    return F.when(~c.isin(*missing), c).cast(kind)


def ja_nein(c: Column) -> Column:
    return F.when(c == "Ja", True).when(c == "Nein", False)


def strip_hierarchy(c: Column, *marks: str) -> Column:
    """Drop one leading hierarchy mark, e.g. ``>>`` or ``-``; marks are regexes."""
    return F.regexp_replace(c, f"^({'|'.join(marks)})", "")


def dot_notation(c: Column) -> dict[str, Column]:
    """``- canton``, ``>> district``, ``......0230 municipality``."""
    label = r"^(?:-|>>|(?:\.\.\.\.\.\.\d*))(.*)"
    return {
        "geo_code": F.when(c.startswith("-"), "kant")
        .when(c.startswith(">>"), "bezk")
        .when(c.startswith("......"), "polg")
        .otherwise(""),
        "geo_value": regex_find(c, r"^\.\.\.\.\.\.(\d+)", 1),
        "geo_value_name": strip(regex_find(c, label, 1)),
    }


def leading_number(c: Column) -> dict[str, Column]:
    """``230 municipality``."""
    return {
        "geo_code": F.lit("polg"),
        "geo_value": regex_find(c, r"(?U)^(\d+)(?:\s\w+).*", 1),
        "geo_value_name": regex_find(c, r"(?U)^\d+\s(.*)", 1),
    }


GEO_PARSERS = {"dot_notation": dot_notation, "leading_number": leading_number}


def year_range(c: Column) -> dict[str, Column]:
    """``2024`` -> 2024, 2024; ``2017/18`` -> 2017, 2018; ``1979-1985`` as written."""
    spread = F.regexp_replace(c, r"^(\d{4})$", "$1-$1")
    spread = F.regexp_replace(spread, r"^(\d{2})(\d{2})/(\d{2})$", "$1$2-$1$3")
    parts = F.split(spread, "-", 2)
    return {"year_from": F.get(parts, F.lit(0)), "year_to": F.get(parts, F.lit(1))}


def is_year(c: Column) -> Column:
    """One single year, blanks around it allowed."""
    return c.rlike(r"^\s*\d{4}\s*$")


def joined_sources(c: Column) -> Column:
    """Source list as text; ``unknown`` where the metadata has none."""
    return F.coalesce(F.array_join(c, ", "), F.lit("unknown"))


def group_key(*cols: Column) -> Column:
    return F.concat_ws("---", *[c.cast("string") for c in cols])


def mother_path(*cols: Column) -> Column:
    """``_id`` for every ancestor column, a missing id leaving only its ``_``."""
    if not cols:
        return F.lit("")
    return F.concat(
        *[part for c in cols for part in (F.lit("_"), F.coalesce(c.cast("string"), F.lit("")))]
    )


def indicator_label(
    indicator_id: Column, name: Column, unit: Column, measures: Column
) -> Column:
    """``[#0007] name (unit) ['pro100', 'zahl']``, the leaf text of the topic tree."""
    quoted = F.transform(
        measures,
        lambda m: F.when(m.isNull(), F.lit("None")).otherwise(
            F.concat(F.lit("'"), m, F.lit("'"))
        ),
    )
    number = indicator_id.cast("string")
    width = F.greatest(F.lit(4), F.length(number))
    return F.concat(
        F.lit("[#"), F.lpad(number, width, F.lit("0")), F.lit("] "), name,
        F.lit(" ("), unit, F.lit(") ["), F.array_join(quoted, ", "), F.lit("]"),
    )
