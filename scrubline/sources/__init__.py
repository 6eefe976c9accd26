from scrubline.sources.csv import (
    CsvDialect,
    header_consistency,
    read_csv_by_name,
    read_csv_dir,
    read_csv_inferred,
    rows_per_file,
)
from scrubline.sources.files import file_inventory, preflight

__all__ = [
    "CsvDialect",
    "file_inventory",
    "header_consistency",
    "preflight",
    "read_csv_by_name",
    "read_csv_dir",
    "read_csv_inferred",
    "rows_per_file",
]
