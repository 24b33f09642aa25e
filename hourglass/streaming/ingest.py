"""Ingest stream (T5, S11, J3): queue lines -> new-data fact store.

One streaming query decodes each micro-batch once and appends facts and
quarantined messages to one exactly-once Parquet file sink, partitioned by
(dataunit_id, value_id); quarantined rows sit in ``dataunit_id=0``. The
checkpoint holds the source offsets, so a killed query restarts where it
stopped without duplicating or losing a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hourglass import schemas as S
from hourglass.operators import decode


def ingest_frame(lines: DataFrame, coordinate_cols: tuple[str, ...] | None = None,
                 last_property_only: bool = False) -> DataFrame:
    """The decoded rows the ingest sink writes (schema ``NEW_DATA``)."""
    parsed = decode.parse_messages(lines, coordinate_cols=coordinate_cols)
    return decode.to_new_data(parsed, last_property_only)


def start_ingest(lines: DataFrame, new_data_path: str, checkpoint: str,
                 coordinate_cols: tuple[str, ...] | None = None, trigger: dict | None = None,
                 last_property_only: bool = False,
                 query_name: str | None = None, retention: str | None = None) -> StreamingQuery:
    """Start the ingest query; ``trigger`` e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "30 seconds"}``.

    ``retention`` (e.g. ``"30 days"``) lets the sink's log forget files committed longer
    ago: set it well above the time between batch runs, which drop the files they consume.
    """
    w = (ingest_frame(lines, coordinate_cols, last_property_only).writeStream
         .format("parquet")
         .option("path", new_data_path)
         .option("checkpointLocation", checkpoint)
         .partitionBy(*S.PARTITION_COLUMNS)
         .outputMode("append"))
    if retention:
        w = w.option("retention", retention)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()
