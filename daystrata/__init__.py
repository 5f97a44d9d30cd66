"""Day-layered ingestion, cleaning, checking and querying of dated observation files on Spark."""

from daystrata.config import WEATHER, ObservationConfig

__all__ = ["WEATHER", "ObservationConfig"]
