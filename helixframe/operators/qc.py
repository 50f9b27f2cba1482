"""Quality control: how unique UMIs are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def umi_uniqueness(rows: DataFrame, components: Sequence[str], umi: str = "umi") -> DataFrame:
    """How many different values each UMI has in each component, and how often each such pattern occurs.

    Returns the components' columns, by name, and COUNT.
    """
    names = sorted(components)
    each = rows.groupBy(umi).agg(*(F.countDistinct(c).alias(c) for c in names))
    return each.groupBy(*names).agg(F.count("*").alias("COUNT"))
