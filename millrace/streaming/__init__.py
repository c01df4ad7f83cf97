"""Running streams."""

from millrace.streaming.append import append_once, start_append, start_batches

__all__ = ["append_once", "start_append", "start_batches"]
