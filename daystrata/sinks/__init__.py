from daystrata.sinks.days import write_by_day, write_clean, write_raw
from daystrata.sinks.views import drop_view, register_view

__all__ = ["drop_view", "register_view", "write_by_day", "write_clean", "write_raw"]
