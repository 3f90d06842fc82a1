from .csv_files import read_csv_batch
from .sizes import estimated_bytes, exchanged, fits_broadcast
from .staging import scratch_path, scratch_root, shuffles_dropped, stage, staged_for_load
from .tables import Lakehouse

__all__ = [
    "Lakehouse",
    "estimated_bytes",
    "exchanged",
    "fits_broadcast",
    "read_csv_batch",
    "scratch_path",
    "scratch_root",
    "shuffles_dropped",
    "stage",
    "staged_for_load",
]
