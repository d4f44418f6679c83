from .checks import choose_form, input_check, repeated_days, watch
from .landing import land, land_bucketed, land_checked, load_snapshot
from .ledger import LandedFiles
from .readers import read_csv, read_inferred, read_json
from .rejects import Parsed, parse_csv, parse_json

__all__ = [
    "LandedFiles", "Parsed", "choose_form", "input_check", "land", "land_bucketed", "land_checked",
    "load_snapshot", "parse_csv", "parse_json", "read_csv", "read_inferred", "read_json",
    "repeated_days", "watch",
]
