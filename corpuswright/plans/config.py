"""Configuration of cleaning runs and recipes."""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

from corpuswright.functions.quality import Thresholds


@dataclass(frozen=True)
class Cleaning:
    """What a cleaning run does."""

    languages: tuple[str, ...] = ("tr",)
    language_threshold: float = 0.65
    #: Column that tells a document's language, if there is one.
    language_col: str | None = None
    repetition: bool = True
    quality: bool = True
    line_quality: bool = True
    limits: Thresholds = field(default_factory=Thresholds)
    redact: bool = True
    redact_addresses: bool = True
    redact_plates: bool = False
    exact: bool = True
    near: bool = True
    bands: int = 14
    rows: int = 8
    shingle: int = 5
    tokenizer: str | None = None
    token_rate: float = 1.0

    def __post_init__(self) -> None:
        if not 0 <= self.language_threshold <= 1 or not 0 < self.token_rate <= 1:
            raise ValueError("thresholds and rates must be within 0 and 1")
        if min(self.bands, self.rows, self.shingle) < 1:
            raise ValueError("bands, rows and shingles must be at least 1")


KINDS = ("jsonl", "parquet", "wikipedia", "legislation", "pages")


@dataclass(frozen=True)
class Step:
    name: str
    kind: str
    weight: float
    license: str = "unknown"
    register: str = "unknown"
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Recipe:
    output_root: str
    target_tokens: int
    sources: tuple[Step, ...]
    tokenizer: str | None = None
    shuffle_seed: int = 0
    cleaning: Cleaning = field(default_factory=Cleaning)
    #: Whether what is clean is written as JSON lines too.
    export_json: bool = False

    def __post_init__(self) -> None:
        names = [s.name for s in self.sources]
        if not names or len(set(names)) != len(names):
            raise ValueError("a recipe needs sources, and their names must differ")
        if self.target_tokens <= 0:
            raise ValueError("the budget must be above zero")
        for s in self.sources:
            if s.kind not in KINDS:
                raise ValueError(f"{s.name}: unknown kind {s.kind!r}")
            if s.weight <= 0:
                raise ValueError(f"{s.name}: the weight must be above zero")
            if "path" not in s.params:
                raise ValueError(f"{s.name}: a path is needed")


def budget(value: str | float) -> int:
    """A number of tokens: ``20_000``, ``20e9``, 5; whole numbers are read without rounding."""
    if isinstance(value, bool):
        raise ValueError("a budget is a number")
    try:
        out = int(value) if isinstance(value, int) else int(str(value).replace(",", "").strip())
    except ValueError:
        out = int(float(str(value)))
    if out <= 0:
        raise ValueError("a budget must be above zero")
    return out


def _step(found: dict) -> Step:
    known = {f.name for f in fields(Step)} - {"params"}
    more = {k: v for k, v in found.items() if k not in known and k != "params"}
    return Step(**{k: v for k, v in found.items() if k in known}, params={**found.get("params", {}), **more})


def load_recipe(path: str, **overrides: object) -> Recipe:
    """A recipe from JSON or TOML; keys of a source that are no field of it are its parameters."""
    raw = Path(path).read_text(encoding="utf-8")
    found = tomllib.loads(raw) if path.endswith(".toml") else json.loads(raw)
    cleaning = Cleaning(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.get("cleaning", {}).items()})
    recipe = Recipe(found["output_root"], budget(found["target_tokens"]), tuple(map(_step, found.get("sources", []))), found.get("tokenizer"), int(found.get("shuffle_seed", 0)), cleaning, bool(found.get("export_json", False)))
    wanted = {k: v for k, v in overrides.items() if v is not None}
    if "target_tokens" in wanted:
        wanted["target_tokens"] = budget(wanted["target_tokens"])
    return replace(recipe, **wanted)
