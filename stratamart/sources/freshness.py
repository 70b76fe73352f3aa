"""How recent the rows of a source are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sources that declare a load-time column.
LOADED_AT = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


def source_freshness(sources: dict[str, DataFrame]) -> DataFrame:
    """Newest load time per source that declares one; reads one column each."""
    newest = []
    for name, column in LOADED_AT.items():
        loaded = F.max(F.col(column).cast("timestamp_ntz")).alias("max_loaded_at")
        labels = [F.lit(name).alias("source"), F.lit(column).alias("loaded_at_field")]
        newest.append(sources[name].agg(loaded).select(*labels, "max_loaded_at"))
    return reduce(DataFrame.unionByName, newest)
