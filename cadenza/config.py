"""Effective configuration: defaults, a TOML override and its strict checks."""

from __future__ import annotations

import json
import math
import re
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from cadenza.errors import HardError

#: Sections, keys and defaults.
DEFAULTS: dict[str, dict] = {
    "manifest": {"lang": None},
    "quality": {"silence_threshold_dbfs": -40.0, "low_volume_rms_dbfs": -30.0, "duration_min_s": 0.5, "duration_max_s": 20.0},
    "split": {"seed": 0, "train": 0.8, "val": 0.1, "test": 0.1},
}
SPLITS = ("train", "val", "test")
RATIO_TOLERANCE = 1e-9


@dataclass(frozen=True)
class Config:
    values: dict = field(default_factory=lambda: {s: dict(keys) for s, keys in DEFAULTS.items()})

    def __getitem__(self, section: str) -> dict:
        return self.values[section]

    def canonical(self) -> str:
        """Sorted keys, compact, defaults spelled out: the bytes that enter the version id."""
        return json.dumps(self.values, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def _checked(section: str, key: str, value):
    if key == "lang":
        if not isinstance(value, str) or not re.fullmatch("[a-z]{2}", value):
            raise HardError(f"[manifest].lang must be a two-letter ISO 639-1 code, got {value!r}")
        return value
    if key == "seed":
        if type(value) is not int:
            raise HardError(f"[split].seed must be an integer, got {value!r}")
        return value
    if type(value) not in (int, float):
        raise HardError(f"[{section}].{key} must be a number, got {value!r}")
    return float(value)


def load_config(path: str | Path | None = None) -> Config:
    raw: dict = {}
    if path is not None:
        try:
            raw = tomllib.loads(Path(path).read_text(encoding="utf-8"))
        except (tomllib.TOMLDecodeError, UnicodeDecodeError) as error:
            raise HardError(f"--config is not valid TOML: {error}") from error
    for name, body in raw.items():
        if name not in DEFAULTS:
            raise HardError(f"unknown config section [{name}]; only [manifest], [quality], [split] are allowed" if isinstance(body, dict) else f"config key {name!r} does not belong to any section")
    values = {}
    for section, keys in DEFAULTS.items():
        body = raw.get(section, {})
        if not isinstance(body, dict):
            raise HardError(f"config section [{section}] must be a table")
        if extra := sorted(set(body) - set(keys)):
            raise HardError(f"unknown key(s) in [{section}]: {', '.join(extra)}")
        values[section] = {k: _checked(section, k, body[k]) if k in body else default for k, default in keys.items()}
    ratios = {s: values["split"][s] for s in SPLITS}
    for name, ratio in ratios.items():
        if not ratio > 0:
            raise HardError(f"[split].{name} must be > 0, got {ratio}")
    if not math.isclose(sum(ratios.values()), 1.0, rel_tol=0, abs_tol=RATIO_TOLERANCE):
        raise HardError(f"[split] ratios must sum to 1.0, got {sum(ratios.values())} ({', '.join(f'{k}={v}' for k, v in ratios.items())})")
    return Config(values)
