"""Settings: dataclasses, files (YAML where PyYAML is there, else JSON) and dotted overrides."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass

TASKS = ("regression", "binary", "multiclass")


class ConfigError(ValueError):
    """A setting that must be made was not, or is unknown."""


@dataclass
class DataConfig:
    train_path: str | None = None
    test_path: str | None = None
    artifacts_dir: str = "artifacts"
    submission_dir: str = "submission"
    logs_dir: str = "logs"


@dataclass
class TaskSpec:
    task_type: str | None = None
    target_column: str | None = None
    id_column: str | None = None
    prediction_column: str = "prediction"
    metric: str | None = None
    direction: str | None = None

    @property
    def direction_safe(self) -> str:
        """The direction, which has no default: to guess it wrong is to optimise the wrong way."""
        if self.direction not in ("minimize", "maximize"):
            raise ConfigError(f"task.direction must be minimize or maximize, not {self.direction!r}")
        return self.direction


@dataclass
class SplitConfig:
    kind: str = "kfold"
    folds: int = 5
    seed: int = 42
    group_column: str | None = None
    time_column: str | None = None
    fraction: float = 0.2


@dataclass
class ModelConfig:
    name: str = "gbt"
    params: dict = field(default_factory=dict)


@dataclass
class Config:
    data: DataConfig = field(default_factory=DataConfig)
    task: TaskSpec = field(default_factory=TaskSpec)
    split: SplitConfig = field(default_factory=SplitConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    features: dict = field(default_factory=dict)


def _apply(target, values: dict, where: str = "") -> None:
    known = {f.name for f in fields(target)}
    for key, value in values.items():
        if key not in known:
            raise ConfigError(f"unknown setting {where}{key}")
        old = getattr(target, key)
        if is_dataclass(old):
            _apply(old, value or {}, f"{where}{key}.")
        else:
            setattr(target, key, value)


def load_config(path: str | None = None, overrides: dict[str, object] | None = None) -> Config:
    """Defaults, then the file, then overrides such as {"task.direction": "minimize"}."""
    config = Config()
    if path:
        with open(path, encoding="utf-8") as file:
            text = file.read()
        if path.endswith((".yaml", ".yml")):
            import yaml

            values = yaml.safe_load(text) or {}
        else:
            values = json.loads(text)
        _apply(config, values)
    for dotted, value in (overrides or {}).items():
        tree = value
        for part in reversed(dotted.split(".")):
            tree = {part: tree}
        _apply(config, tree)
    return config
