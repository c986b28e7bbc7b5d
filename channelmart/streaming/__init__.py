"""Incremental drivers. The source jobs are one-shot daily batches with no
stream state; the only use of Structured Streaming here is to run the event
flattening over newly landed files exactly once (file source + checkpointed
progress log), instead of computing a daily table suffix."""

from channelmart.streaming.events import flatten_new_events  # noqa: F401
