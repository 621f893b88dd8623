"""Column functions for keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiofact.schemas import GROUP_TOTAL_ID, SURROGATE_NULL


def surrogate_key(*cols: Column) -> Column:
    """md5 over the texts of the columns, a fixed word standing in for NULL."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL)) for c in cols])
    )


def is_total(group_value_id: Column) -> Column:
    """Unused groups count as totals."""
    return F.coalesce(group_value_id, F.lit(GROUP_TOTAL_ID)) == GROUP_TOTAL_ID
