from .cluster import write_clustered
from .lake import drop_table, read_table, with_month, write_table
from .scratch import scratch_dir
from .versions import (
    LakeChanged, Part, Version, commit, read_parts, read_version, remove_old, roll_back, run_path,
)

__all__ = [
    "LakeChanged", "Part", "Version", "commit", "drop_table", "read_parts", "read_table",
    "read_version", "remove_old", "roll_back", "run_path", "scratch_dir", "with_month",
    "write_clustered", "write_table",
]
