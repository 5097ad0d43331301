"""Run parameters, the two presets and the search space."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class Params:
    test_p: float = 0.10
    valid_p: float = 0.20
    optimiser: str = "Adam"
    loss: str = "binary_cross_entropy"
    num_node_features: int = 15
    hidden_dim: int = 20
    num_negative_samples: int = 10
    batch_size: int = 12
    max_steps: int = 200
    lr: float = 0.001
    l2_regularisation: float = 0.0005
    momentum: float = 0.05
    aggregator_type: str = "mean"
    seed: int = 0
    fanout: int = 4
    strict_negatives: bool = False
    exclude_targets: bool = True
    own_split_messages: bool = False

    def __post_init__(self):
        if self.optimiser not in ("Adam", "SGD"):
            raise ValueError(f"unknown optimiser {self.optimiser!r}")
        if self.loss not in ("binary_cross_entropy", "margin"):
            raise ValueError(f"unknown loss {self.loss!r}")
        if self.aggregator_type not in ("mean", "pool"):
            raise ValueError(f"unknown aggregator_type {self.aggregator_type!r}")
        if not 0 <= self.test_p + self.valid_p <= 1:
            raise ValueError("test_p + valid_p must lie in [0, 1]")

    def with_(self, **changes: Any) -> "Params":
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, given: Mapping[str, Any]) -> "Params":
        """Accepts the older names of two settings; ignores host-only settings."""
        names = {f.name: type(f.default) for f in fields(cls)}
        out: dict[str, Any] = {}
        for key, value in given.items():
            key = RENAMED.get(key, key)
            if key in HOST_ONLY:
                continue
            if key not in names:
                raise KeyError(f"unknown parameter {key!r}")
            if names[key] is bool and isinstance(value, str):
                value = value.strip().lower() == "true"
            out[key] = names[key](value)
        return cls(**out)

    @classmethod
    def from_json(cls, path: str) -> "Params":
        with open(path, encoding="utf-8") as f:
            return cls.from_mapping(json.load(f))

    def as_strings(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}


RENAMED = {"num_hidden_graph_layers": "hidden_dim", "num_epochs": "max_steps"}
HOST_ONLY = {"device", "num_workers", "num_classes", "database"}

# The presets and the search space of the published pipeline.
DEFAULT = Params()
TUNED = Params(
    aggregator_type="pool",
    batch_size=32,
    l2_regularisation=0.005,
    loss="margin",
    lr=0.01,
    momentum=0.005,
    max_steps=2000,
    hidden_dim=100,
    num_negative_samples=50,
    num_node_features=50,
    optimiser="SGD",
)
SEARCH_SPACE: dict[str, tuple] = {
    "optimiser": ("Adam", "SGD"),
    "loss": ("binary_cross_entropy", "margin"),
    "num_node_features": (2, 10, 20, 50, 100),
    "hidden_dim": (5, 15, 100),
    "batch_size": (16, 32, 64, 128),
    "num_negative_samples": (3, 10, 50),
    "max_steps": (1000, 2000, 8000),
    "l2_regularisation": (5e-4, 5e-3, 5e-2),
    "momentum": (5e-4, 5e-3, 5e-2),
    "lr": (1e-3, 1e-5, 1e-2),
    "aggregator_type": ("mean", "pool"),
}
SEARCH_TRIALS = 20
SEARCH_PARALLELISM = 8
