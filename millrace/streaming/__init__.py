from millrace.streaming.cursors import CursorTable
from millrace.streaming.extract import land_records
from millrace.streaming.feeder import Unique, append_unique, feed_files, read_metrics, stream_files

__all__ = ["CursorTable", "Unique", "append_unique", "feed_files", "land_records", "read_metrics", "stream_files"]
