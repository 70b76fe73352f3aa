"""Reading the source tables."""

from stratamart.sources.csv import read_daily_metrics_csv
from stratamart.sources.freshness import LOADED_AT, source_freshness
from stratamart.sources.tables import SOURCE_COLUMNS, MissingColumns, read_source, read_sources

__all__ = [
    "LOADED_AT",
    "MissingColumns",
    "SOURCE_COLUMNS",
    "read_daily_metrics_csv",
    "read_source",
    "read_sources",
    "source_freshness",
]
