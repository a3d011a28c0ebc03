"""Typed settings of the jobs. Defaults are the published ones."""

from __future__ import annotations

from dataclasses import dataclass, field

HOUR = 3600
DAY = 86400

FILLS = ("time", "carry", "bounded", "none")


@dataclass(frozen=True)
class Grid:
    """A regular time axis.

    A *tick* is the whole number of steps since the epoch. ``label`` says
    whether an observation inside a step belongs to the tick that ends it or
    the one that starts it. Series are cut into blocks of ``block`` ticks, so
    that no task ever holds more than one block of one series.
    """

    step: int = HOUR
    label: str = "end"
    block: int = 4096

    def __post_init__(self):
        if self.label not in ("end", "start"):
            raise ValueError("label must be 'end' or 'start'")
        if self.step <= 0 or self.block <= 0:
            raise ValueError("step and block must be positive")


@dataclass(frozen=True)
class Feature:
    """One column of the regular table and the series it is read from.

    ``site_id`` None means the target's own site.
    """

    name: str
    variable_codes: tuple[str, ...]
    site_id: int | None = None
    allow_negative: bool = False
    fill: str = "time"

    def __post_init__(self):
        if self.fill not in FILLS:
            raise ValueError(f"unsupported fill {self.fill!r}, expected one of {FILLS}")


@dataclass(frozen=True)
class SampleSpec:
    """Shape and quality rules of supervised samples, in ticks."""

    lags: int = 168
    horizons: int = 24
    max_gap: int = 10
    stride: int = 6
    dense_months: frozenset[int] = frozenset({3, 4, 5, 6})
    context_window: int = 24
    rolling_min: int = 18

    def __post_init__(self):
        if min(self.lags, self.horizons, self.max_gap, self.stride) < 1:
            raise ValueError("lags, horizons, max_gap and stride must be at least 1")


@dataclass(frozen=True)
class Target:
    """What is forecast, from which features, at which sites."""

    name: str
    site_ids: tuple[int, ...]
    features: tuple[Feature, ...]
    rolling: dict[str, str] = field(default_factory=dict)

    @property
    def main(self) -> Feature:
        return self.features[0]


@dataclass(frozen=True)
class Clip:
    """Limits on how far consecutive forecast steps may move."""

    enabled: bool = True
    pct: float = 0.05
    multiplier: float = 1.5
    floor: float = 2.0


# Sites, live variable codes, match terms, target names.
DISCHARGE_SITES = (3, 4)
AIR_TEMPERATURE_SITES = (1, 2)
AIR_SITE = 2
PRECIPITATION_SITE = 2
SNOW_SITE = 1
MATCH_TERMS = {
    "discharge": ("discharge", "streamflow", "stream flow"),
    "air_temp": ("airtemp", "air temp", "air temperature"),
    "precipitation": ("precip", "precipitation"),
    "snow_depth": ("snowdepth", "snow depth"),
}
LIVE_TARGETS = {"AirTemp": "air_temperature", "Discharge": "discharge"}
LIVE_SIGNED = ("AirTemp",)

DISCHARGE = Target(
    name="discharge",
    site_ids=DISCHARGE_SITES,
    features=(
        Feature("discharge", ("Discharge",)),
        Feature("air_temp", ("AirTemp",), AIR_SITE, allow_negative=True),
        Feature("snow_depth", ("SnowDepth",), SNOW_SITE, fill="carry"),
        Feature("precipitation", ("Precip",), PRECIPITATION_SITE, fill="bounded"),
    ),
    rolling={"precip_avg_last_24h": "precipitation"},
)

AIR_TEMPERATURE = Target(
    name="air_temperature",
    site_ids=AIR_TEMPERATURE_SITES,
    features=(Feature("air_temp", ("AirTemp",), allow_negative=True),),
)
