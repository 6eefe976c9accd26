from scrubline.sinks.files import (
    partition_listing,
    write_csv,
    write_partitioned_parquet,
    write_single_parquet,
)

__all__ = [
    "partition_listing",
    "write_csv",
    "write_partitioned_parquet",
    "write_single_parquet",
]
