"""hourglass — a PySpark lambda-architecture pageview analytics engine.

Layers:
  sources/    message and fact readers/writers (JSON envelopes, partitioned facts)
  functions/  Column -> Column expressions (URL normalization, buckets, keys, ids)
  operators/  DataFrame operators (decode, batch view, storage, realtime, serving)
  streaming/  Structured Streaming jobs (ingest, speed layer)
  plans/      job entry points and plan inspection helpers
"""

__version__ = "0.1.0"
