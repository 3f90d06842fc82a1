from .ingest import csv_stream, ingest_stream, read_evolved, start_ingest, with_audit
from .upsert import start_stream_upsert, stream_upsert

__all__ = [
    "csv_stream",
    "ingest_stream",
    "read_evolved",
    "start_ingest",
    "start_stream_upsert",
    "stream_upsert",
    "with_audit",
]
