from panelproj.sources.files import (
    checkpoint_dir,
    materialize,
    read_parts,
    read_raw_csv,
    read_sheet,
    write_history,
    write_report,
)
from panelproj.sources.ingest import POSITION, Ingest, ingest

__all__ = [
    "POSITION",
    "Ingest",
    "checkpoint_dir",
    "ingest",
    "materialize",
    "read_parts",
    "read_raw_csv",
    "read_sheet",
    "write_history",
    "write_report",
]
