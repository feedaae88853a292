"""The one description of a panel passed to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesSpec:
    """Names the key, time and value columns of a long daily panel.

    ``keys`` identify a series (e.g. ``("series_id",)``). An empty tuple means
    one single series; window operators then refuse to run unless
    ``single_series=True`` is passed, because an un-keyed window moves every
    row into one partition.
    """

    keys: tuple[str, ...] = ("series_id",)
    time: str = "date"
    value: str = "y"
    single_series: bool = False
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if isinstance(self.keys, str):
            object.__setattr__(self, "keys", (self.keys,))
        if not self.keys and not self.single_series:
            raise ValueError(
                "SeriesSpec without keys: pass single_series=True to accept "
                "a one-partition window (only sensible at daily grain)")

    @property
    def key_cols(self) -> list[str]:
        return list(self.keys)

    def with_value(self, value: str) -> "SeriesSpec":
        return SeriesSpec(self.keys, self.time, value, self.single_series)
