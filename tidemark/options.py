"""Typed options, built from the JSON job configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

# The highest prior that sampling can be asked for.
TOP_PRIOR = 0.99


@dataclass(frozen=True)
class SpineColumns:
    """Column names of the (customer, period) spine; the defaults are fixed values."""

    target: str = "target"
    id: str = "id"
    ident: str = "cliident"
    date: str = "data_date_part"
    ind_split: str = "ind_split"

    @property
    def keys(self) -> list[str]:
        return [self.ident, self.date]

    def all(self) -> list[str]:
        return [self.target, self.id, self.ident, self.date, self.ind_split]


@dataclass(frozen=True)
class Options:
    spine: SpineColumns = field(default_factory=SpineColumns)
    # splitting and sampling
    n_months_val: int = 1
    train_size: float = 0.7
    prior_map: dict[str, float] | None = None
    min_prior: float | None = None
    factor_mult: float = 1.0
    # cleaning
    step_size: int = 200
    null_threshold: float = 0.95
    low_variance: bool = False
    varc_threshold: float | None = 5.0
    bin_input: tuple[str, ...] = ()
    rsd: float = 0.015
    population: bool = False
    fit_on: str = "all"
    max_labels: int = 1000
    # selection
    feat_mode: str = "infogain"
    criterion: str = "percentile"
    top: int = 60
    percentile: float = 0.8
    threshold: float = 0.05
    perc: float = 0.3
    bin_buckets: int = 5
    bin_error: float = 0.0
    num_top_features: int = 100
    # scores and evaluation
    score_col: str = "score"
    buckets_name: str = "deciles"
    eval_error: float = 0.0
    eval_buckets: int = 10
    # tables
    mode: str = "DEV"
    new_part_cols: tuple[str, ...] = ()
    feat_drop: tuple[str, ...] = ()
    n_part: int | None = None

    def __post_init__(self) -> None:
        if not 0 <= self.train_size <= 1:
            raise ValueError("train_size must lie in [0, 1]")
        if self.fit_on not in ("all", "train"):
            raise ValueError("fit_on must be 'all' or 'train'")
        if self.feat_mode not in ("infogain", "chisqrd", "cramer", "mtinfo"):
            raise ValueError(f"unknown feat_mode {self.feat_mode!r}")
        if self.criterion not in ("top", "percentile", "threshold", "perc"):
            raise ValueError(f"unknown criterion {self.criterion!r}")
        for month in self.prior_map or {}:
            date.fromisoformat(month)
        wanted = [*(self.prior_map or {}).values(), *([] if self.min_prior is None else [self.min_prior])]
        if any(not 0 <= prior <= TOP_PRIOR for prior in wanted):
            raise ValueError(f"wanted priors must lie in [0, {TOP_PRIOR}]")

    @classmethod
    def from_config(cls, config: dict) -> Options:
        """Reads the job configuration: top-level keys plus its ``conf`` block."""
        conf = dict(config.get("conf", {}))
        names = conf.pop("spine", {})
        evaluation = conf.pop("eval", {})
        renamed = {
            "target_col": "target",
            "artf_id_col": "id",
            "ident_col": "ident",
            "date_col": "date",
            "ind_split_col": "ind_split",
        }
        spine = SpineColumns(**{renamed[k]: v for k, v in names.items()})
        known = cls.__dataclass_fields__
        values = {k: v for k, v in conf.items() if k in known}
        for key in ("mode", "new_part_cols", "feat_drop"):
            if key in config:
                values[key] = config[key]
        for key in ("bin_input", "new_part_cols", "feat_drop"):
            if key in values:
                values[key] = tuple(values[key])
        if "error" in evaluation:
            values["eval_error"] = evaluation["error"]
        if "buckets" in evaluation:
            values["eval_buckets"] = evaluation["buckets"]
        return cls(spine=spine, **values)

    @classmethod
    def from_json(cls, path: str) -> Options:
        return cls.from_config(json.loads(Path(path).read_text(encoding="utf-8")))
