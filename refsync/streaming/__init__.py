from refsync.streaming.changes import read_change_stream, run_change_stream
from refsync.streaming.imports import run_import_stream

__all__ = ["read_change_stream", "run_change_stream", "run_import_stream"]
