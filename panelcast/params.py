"""Parameters of the pipeline."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date


@dataclass(frozen=True)
class PanelParams:
    """How occasions are selected, grouped and looked back upon."""

    artistid: int = 1
    no_tour: int = 61  # tourid of occasions that belong to no tour
    max_run_gap: int = 2  # days between two occasions of one run
    inherit: str = "global"  # which run an occasion inside a run takes: see periods.runs
    epoch: date = date(1983, 10, 1)
    previous_year: dict[int, int] = field(default_factory=lambda: {2002: 2000, 2020: 2019})
    trailing_months: int = 12
    trailing_overrides: dict[int, int] = field(
        default_factory=lambda: {2002: 36, 2003: 36, 2021: 24}
    )
    notebook_size: int = 36
    notebook_gap: int = 3
    min_support: int = 4
    source_order: tuple[str, ...] = ("uniqueid",)
    family: str = "Phish"
    aliases: dict[str, str] = field(default_factory=lambda: {a: "Phish" for a in ALIASES})


@dataclass(frozen=True)
class ModelParams:
    """Which rows train the model, and the model."""

    seed: int = 1994
    group: str = "showyear"
    outcome: str = "played"
    start: int = 1986
    cut: int = 2018
    last_groups: int = 7
    cv_type: str = "rolling"
    refit: bool = True
    ids: tuple[str, ...] = ("showid", "songid", "new_tourid")  # no features
    key: tuple[str, ...] = ("showid", "songid")
    model: str = "rf"
    options: dict = field(
        default_factory=lambda: {
            "n_estimators": 555,
            "max_features": 0.2,
            "min_samples_leaf": 20,
            "min_samples_split": 100,
        }
    )
    scaler: str | None = "standard"
    fs: str | None = "variance"
    sampler: str | None = "random"
    threshold: float = 0.5

    @property
    def row(self) -> dict[str, str]:
        """Model and preprocessing as a parameter row: model, params (JSON)."""
        options = {f"{self.model}__{k}": v for k, v in self.options.items()}
        steps = {"scaler": self.scaler, "fs": self.fs, "sampler": self.sampler}
        return {"model": self.model, "params": json.dumps({**options, **steps})}

    def with_row(self, row: Mapping[str, str]) -> ModelParams:
        """These parameters with the model and the preprocessing of a parameter row."""
        from panelcast.models.classifier import parse_params

        model, options, steps = parse_params(row)
        return replace(self, model=model, options=options, **steps)


# Artists whose songs count as the family's own.
ALIASES = (
    "Vida Blue",
    "Trey, Mike and The Duo",
    "Trey Anastasio & Don Hart",
    "Trey Anastasio",
    "The Dude of Life (with Phish)",
    "Page McConnell",
    "Mike Gordon and Leo Kottke",
    "Mike Gordon",
    "Ghosts of the Forest",
    "Amfibian",
    "Bivouac Jaun",
    "Surrender to the Air",
    "SerialPod",
)
