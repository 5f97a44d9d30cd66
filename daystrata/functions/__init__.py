from daystrata.functions.casts import lenient_cast
from daystrata.functions.text import derive_date, name_date, normalise_hour, quoted

__all__ = ["derive_date", "lenient_cast", "name_date", "normalise_hour", "quoted"]
