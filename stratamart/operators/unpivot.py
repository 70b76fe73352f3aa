"""Turning one shipment row into its events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event type, its date column, days since the event before it.
EVENTS = [
    ("COMMIT", "commit_date", None),
    ("SHIP", "ship_date", "ship_minus_commit_days"),
    ("RECEIPT", "receipt_date", "receipt_minus_ship_days"),
]


def unpivot_shipments(shipments: DataFrame, carried: list[str]) -> DataFrame:
    """Three event rows per shipment line in one pass over the input."""

    def event(name: str, day: str, lag: str | None) -> Column:
        days = F.lit(None) if lag is None else F.col(lag)
        return F.struct(
            F.lit(name).alias("event_type"),
            F.col(day).alias("event_date"),
            days.cast("int").alias("days_since_prior_event"),
        )

    events = F.explode(F.array(*[event(*e) for e in EVENTS]))
    return shipments.select(*carried, events.alias("event")).select(
        *carried, "event.event_type", "event.event_date", "event.days_since_prior_event"
    )
