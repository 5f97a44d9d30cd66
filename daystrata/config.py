"""The one place where names of observation columns live."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ObservationConfig:
    """Column roles of an observation table; every operator takes these as plain arguments."""

    types: Mapping[str, tuple[str, ...]]
    day: str
    hour: str
    value: str
    region: str
    overrides: Mapping[str, object] = field(default_factory=dict)


# Target types per column and the default hour.
WEATHER = ObservationConfig(
    types={
        "int": ("WindSpeed", "WindDirection", "WindGust", "Pressure", "SignificantWeatherCode"),
        "bigint": ("ForecastSiteCode", "Visibility"),
        "date": ("ObservationDate",),
        "double": ("ScreenTemperature", "Latitude", "Longitude"),
    },
    day="ObservationDate",
    hour="ObservationTime",
    value="ScreenTemperature",
    region="Region",
    overrides={"ObservationTime": "00:00:00"},
)
