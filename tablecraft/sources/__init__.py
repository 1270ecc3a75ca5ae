"""Reading, writing and staging tables."""

from tablecraft.sources.files import from_footers, read_csv, read_parquet, read_statistics, write_csv, write_parquet
from tablecraft.sources.rejects import read_csv_with_rejects
from tablecraft.sources.workspace import release, stage, stage_bucketed, stage_in_parts, working_path

__all__ = ["from_footers", "read_csv", "read_csv_with_rejects", "read_parquet", "read_statistics", "release", "write_csv", "write_parquet", "stage", "stage_bucketed", "stage_in_parts", "working_path"]
