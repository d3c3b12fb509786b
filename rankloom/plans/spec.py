"""Model specifications: named stages, a framing of the target, and the search space that goes with them."""

from __future__ import annotations

import threading
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.sql import DataFrame

from rankloom.models.estimators import make_estimator
from rankloom.operators import graph
from rankloom.operators.encoders import factor_encoders, make_encoder
from rankloom.operators.features import FEATURE_PREFIX, AssembleFeatures, KeepColumns, SideTableFeatures

ESTIMATOR = "estimator"
PipelineStage = Estimator | Transformer


@dataclass
class Setting:
    """What a specification is fitted on besides the rows: column roles, the side table and the item graph."""

    factors: list[str]
    item: str
    target: str
    side: DataFrame | None = None
    edges: DataFrame | None = None
    side_key: str = "dataset"
    carry: tuple[str, ...] = ()
    _vectors: dict = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def item_vectors(self, size: int, epochs: int, negative: int, alpha: float) -> DataFrame:
        """The item embedding depends on the graph alone, so it is fitted once and shared by all folds and trials."""
        key = (size, epochs, negative, alpha)
        with self._lock:  # folds run in threads; the first one fits
            if key not in self._vectors:
                if self.edges is None:
                    raise ValueError("this specification needs an item graph")
                self._vectors[key] = graph.poincare_embedding(self.edges, size, epochs, negative, alpha)
        return self._vectors[key]

    @property
    def roles(self) -> list[str]:
        return [*self.factors, self.item, self.target, *self.carry]


@dataclass(frozen=True)
class Stage:
    """A named step: what kind of stage it is and its settings."""

    name: str
    kind: str
    settings: Mapping[str, Any] = field(default_factory=dict)

    def build(self, where: Setting, label: str | None, item_in_rows: bool) -> list[PipelineStage]:
        s = dict(self.settings)
        if self.kind == "keep":
            return [KeepColumns(inputCols=[*s["columns"], *where.roles, "label", "item_a", "item_b", "step"])]
        if self.kind == "item_embedding":
            if not item_in_rows:
                return []
            size = s.get("size", 2)
            vectors = where.item_vectors(size, s.get("epochs", 50), s.get("negative", 2), s.get("alpha", 0.1))
            attach = graph.AttachEmbedding.of(vectors, where.item, size, f"{FEATURE_PREFIX}item_dim")
            return [attach, *make_encoder(s.get("encoder"), where.item, f"{FEATURE_PREFIX}item", label)]
        if self.kind == "side_table":
            if where.side is None:
                raise ValueError("this specification needs a side table")
            side = SideTableFeatures(
                key=where.side_key, threshold=s.get("threshold", 0.4), variance=s.get("variance", 1.0),
                prefix=f"{FEATURE_PREFIX}meta_", handleUnknown="impute",
            ).on(where.side)
            return [side, *make_encoder(s.get("encoder"), where.side_key, f"{FEATURE_PREFIX}key", label)]
        if self.kind == "factor_encoders":
            return factor_encoders({c: k for c, k in s.items()}, label)
        if self.kind == "item_encoder":
            return [e for c in s["columns"] for e in make_encoder(s["encoder"], c, f"{FEATURE_PREFIX}{c}", label)]
        if self.kind == ESTIMATOR:
            kind = s.pop("kind")
            return [AssembleFeatures(), make_estimator(kind, **s)]
        raise ValueError(f"unknown stage kind {self.kind!r}")


FRAMINGS = ("regression", "normalized", "classification", "ordinal", "pairwise", "listwise", "multioutput", "list_network",
            "dimensionwise")


@dataclass(frozen=True)
class ModelSpec:
    """An immutable list of named stages (M1) with its framing. Editing gives a new specification (M2, M3)."""

    name: str
    framing: str
    stages: tuple[Stage, ...]
    space: Mapping[str, Any] | None = None
    strategy: str = "cross_validation"

    def __post_init__(self):
        if self.framing not in FRAMINGS:
            raise ValueError(f"unknown framing {self.framing!r}")

    def stage_names(self) -> list[str]:
        return [s.name for s in self.stages]

    def _index(self, name: str) -> int | None:
        return next((i for i, s in enumerate(self.stages) if s.name == name), None)

    def _replaced(self, i: int, stage: Stage) -> ModelSpec:
        return replace(self, stages=(*self.stages[:i], stage, *self.stages[i + 1:]))

    def with_stage(self, stage: Stage) -> ModelSpec:
        """Replace the stage of that name, else insert before the estimator, else append."""
        i = self._index(stage.name)
        if i is not None:
            return self._replaced(i, stage)
        end = self._index(ESTIMATOR)
        return self.insert(stage, len(self.stages) if end is None else end)

    def insert(self, stage: Stage, position: int) -> ModelSpec:
        """Insert at a position (appended if beyond the end), or replace the stage of that name where it is."""
        i = self._index(stage.name)
        if i is not None:
            return self._replaced(i, stage)
        return replace(self, stages=(*self.stages[:position], stage, *self.stages[position:]))

    def remove(self, name: str) -> ModelSpec:
        return replace(self, stages=tuple(s for s in self.stages if s.name != name))

    def clear(self) -> ModelSpec:
        """Only the estimator stays."""
        return replace(self, stages=tuple(s for s in self.stages if s.name == ESTIMATOR))

    def with_estimator(self, kind: str, **settings) -> ModelSpec:
        return self.with_stage(Stage(ESTIMATOR, ESTIMATOR, {"kind": kind, **settings}))

    def with_params(self, params: Mapping[str, Any]) -> ModelSpec:
        """Set ``stage__setting`` parameters; an unknown stage is an error."""
        spec = self
        for name, value in params.items():
            stage, _, setting = name.partition("__")
            i = spec._index(stage)
            if i is None or not setting:
                raise ValueError(f"no such parameter: {name}")
            old = spec.stages[i]
            spec = spec._replaced(i, replace(old, settings={**old.settings, setting: value}))
        return spec

    def estimator(self) -> Stage:
        i = self._index(ESTIMATOR)
        if i is None:
            raise ValueError(f"{self.name} has no estimator")
        return self.stages[i]

    def build(self, where: Setting, label: str | None = "label", item_in_rows: bool = True,
              with_estimator: bool = True) -> list[PipelineStage]:
        """The pyspark.ml stages; fitting adds nothing to the specification, so trials never share state."""
        chosen = [s for s in self.stages if with_estimator or s.name != ESTIMATOR]
        return [stage for s in chosen for stage in s.build(where, label, item_in_rows)]


def save_fitted(model: PipelineModel, path: str) -> None:
    """Every stage, state tables included, to a folder that all executors can reach."""
    model.write().overwrite().save(path)


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)
