from daystrata.sources.archives import read_archives, unpack_archives
from daystrata.sources.days import read_clean, read_days, read_raw, read_rejects
from daystrata.sources.files import list_files, read_any
from daystrata.sources.footers import day_counts, file_date_counts, layer_max, layer_max_per_day
from daystrata.sources.landing import read_landing_csv, with_file_date

__all__ = [
    "day_counts",
    "file_date_counts",
    "layer_max",
    "layer_max_per_day",
    "list_files",
    "read_any",
    "read_archives",
    "read_clean",
    "read_days",
    "read_landing_csv",
    "read_raw",
    "read_rejects",
    "unpack_archives",
    "with_file_date",
]
