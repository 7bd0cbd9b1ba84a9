"""Streaming: intentionally empty.

The reference reads and writes only batch tables (no streaming source,
watermark, event-time window or state), so there is nothing to re-express
with Structured Streaming. Every operator in this package is a plain
DataFrame function and would run unchanged inside ``foreachBatch`` if a
caller chose to feed it incrementally.
"""
