"""Declarative indicator configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class GroupSpec:
    """A grouping column; ``total_value`` is the source's own label for the total."""

    column: str
    name: str = ""
    total_value: str | None = None


@dataclass(frozen=True)
class FilterRule:
    """Keep rows whose column matches a regex (unanchored) and/or equals a value."""

    column: str
    regex: str | None = None
    exact_match: str | None = None


@dataclass(frozen=True)
class MeasureSpec:
    """Base measure of the source value and the measures to derive from it.

    ``calc=None`` only labels the rows with the base; a list, even an empty one,
    emits counts plus every listed ratio.
    """

    base: str | None = None
    calc: Sequence[str] | None = None

    def __post_init__(self) -> None:
        if self.calc is not None:
            object.__setattr__(self, "calc", tuple(self.calc))


@dataclass(frozen=True)
class CubeIndicator:
    indicator_id: int
    is_numeric: bool = False
    period_type: str = "duedate"
    period_code: str = "year"
    build_total_value: str | None = None
    grouping: Sequence[GroupSpec] = ()
    filter_and: Sequence[FilterRule] = ()


@dataclass(frozen=True)
class AtlasV1:
    """First-generation atlas rows: chosen by variable and mother-path patterns.

    ``distinct_rows`` may be set but changes nothing: one row per key is kept anyway.
    """

    indicator_regex: str
    path_regex: Sequence[str] = ()
    period_ref_from: str | None = None
    period_ref: str | None = None
    distinct_rows: bool = False
    value_col: str = "value"
    value_is_text: bool = False


@dataclass(frozen=True)
class AtlasV2:
    """Second-generation atlas rows: chosen by source indicator id."""

    indicateur_id: str
    period_ref_from: str | None = None
    period_ref: str | None = None
    grouping: GroupSpec | None = None


@dataclass(frozen=True)
class AtlasIndicator:
    indicator_id: int
    period_type: str | None = None
    period_code: str | None = None
    v1: AtlasV1 | None = None
    v2: AtlasV2 | None = None
    measure: MeasureSpec | None = None


@dataclass(frozen=True)
class PortraitIndicator:
    indicator_id: int
    period_type: str = "duedate"
    period_code: str = "year"
    measure: MeasureSpec | None = None


@dataclass(frozen=True)
class WideIndicators:
    """A wide table: one indicator per measure column."""

    columns: Mapping[str, int]
    geo_value: str
    period_ref: str
    source: str
    period_type: str = "duedate"
    period_code: str = "day"


@dataclass(frozen=True)
class CubeFamily:
    """Indicators that share one cube and one measure configuration."""

    indicators: Sequence[CubeIndicator]
    measure: MeasureSpec | None = None
    grouping_columns: Sequence[str] = field(default_factory=tuple)


def _build(cls: type, raw: Mapping[str, Any], nested: Mapping[str, Any]) -> Any:
    known = {f.name for f in fields(cls)}
    unknown = set(raw) - known
    if unknown:
        raise KeyError(f"{cls.__name__}: unknown settings {sorted(unknown)}")
    return cls(**{**raw, **nested})


def cube_indicator(raw: Mapping[str, Any]) -> CubeIndicator:
    """A cube indicator from a plain (JSON/YAML-like) mapping."""
    return _build(
        CubeIndicator,
        raw,
        {
            "grouping": tuple(GroupSpec(**g) for g in raw.get("grouping") or ()),
            "filter_and": tuple(FilterRule(**f) for f in raw.get("filter_and") or ()),
        },
    )


def atlas_indicator(raw: Mapping[str, Any]) -> AtlasIndicator:
    """An atlas indicator from a plain mapping."""
    nested: dict[str, Any] = {}
    if raw.get("v1") is not None:
        nested["v1"] = AtlasV1(**raw["v1"])
    if raw.get("v2") is not None:
        v2 = dict(raw["v2"])
        if v2.get("grouping") is not None:
            v2["grouping"] = GroupSpec(**v2["grouping"])
        nested["v2"] = AtlasV2(**v2)
    if raw.get("measure") is not None:
        nested["measure"] = MeasureSpec(**raw["measure"])
    return _build(AtlasIndicator, raw, nested)
