"""Fixed column contracts and reserved values."""

from __future__ import annotations

# Fixed values of the data model.
GROUP_TOTAL = "GROUP TOTAL"
GROUP_TOTAL_ID = 1
GEO_LEVELS = ("polg", "bezk", "kant")  # municipality, district, canton
MEASURE_BASIS = {"pro100": 100, "pro1000": 1000, "pro100000": 100000}
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
POPULATION_INDICATOR = 3
GROUPS = (1, 2, 3, 4)

#: Type of an indicator value before and inside the mart.
VALUE_TYPE = "decimal(38,18)"
MART_VALUE_TYPE = "decimal(32,9)"

#: The long indicator fact, in order.
INTM = {
    "indicator_id": "smallint",
    "geo_code": "string",
    "geo_value": "smallint",
    "knowledge_date_from": "timestamp_ntz",
    "knowledge_date_to": "timestamp_ntz",
    "period_type": "string",
    "period_code": "string",
    "period_ref_from": "date",
    "period_ref": "date",
    **{f"group_{n}_{part}": "string" for n in GROUPS for part in ("name", "value")},
    "indicator_value_numeric": VALUE_TYPE,
    "indicator_value_text": "string",
    "source": "string",
    "_etl_version": "smallint",
}
INTM_MEASURED = {**INTM, "measure_code": "string"}

KEY_NOGROUPS = ["indicator_id", "geo_code", "geo_value", "period_ref", "knowledge_date_from"]
KEY_GROUPS = KEY_NOGROUPS + [f"group_{n}_value" for n in GROUPS]

#: The star-schema fact, in order.
MART = {
    **{c: INTM[c] for c in list(INTM)[:9]},
    **{
        name: kind
        for n in GROUPS
        for name, kind in (
            (f"group_{n}_id", "smallint"),
            (f"group_value_{n}_id", "smallint"),
            (f"_group_value_{n}_is_total", "boolean"),
        )
    },
    "measure_code": "string",
    "indicator_value_numeric": MART_VALUE_TYPE,
    "indicator_value_text": "string",
    "source_id": "smallint",
}


def widened(contract: dict[str, str], **types: str) -> dict[str, str]:
    """The same columns with some types replaced, e.g. for ids beyond SMALLINT."""
    unknown = set(types) - set(contract)
    if unknown:
        raise KeyError(f"not in the contract: {sorted(unknown)}")
    return {**contract, **types}
