"""A recipe says which data set becomes which training set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Data sets so large that only every k-th row is used.
EVERY_KTH = {
    "20231101.ja": 3,
    "20231101.vi": 3,
    "20231101.es": 3,
    "20231101.it": 3,
    "20231101.de": 5,
    "20231101.fr": 5,
}
# What every recipe is split with, whatever it says itself.
SPLIT_SEED = 42
TEST_SHARE = 0.2


@dataclass(frozen=True)
class EvaluationItem:
    prompt: str
    expected_output: str
    context: str | None = None
    hint: str | None = None


@dataclass(frozen=True)
class Recipe:
    """The part of a recipe that concerns data.

    The attributes are the recipe's own keys without ``dataset_`` in front.
    ``name`` is the path of the recipe: ``model_name`` is not unique.
    """

    name: str
    dataset_id: str
    input_field_name: str
    output_field_name: str | None = None
    context_field_name: str | None = None
    context_hint: str | None = None
    input_hint: str | None = None
    load_config: str | None = None
    filter_field_name: str | None = None
    filter_field_value: Any = None
    output_field_values_to_texts: Mapping[Any, Any] = field(default_factory=dict)
    evaluations: tuple[EvaluationItem, ...] = ()

    @classmethod
    def from_dict(cls, name: str, keys: Mapping[str, Any]) -> Recipe:
        optional = (
            "output_field_name",
            "context_field_name",
            "context_hint",
            "input_hint",
            "load_config",
            "filter_field_name",
            "filter_field_value",
        )
        try:
            dataset_id, input_field = keys["dataset_id"], keys["dataset_input_field_name"]
        except KeyError as missing:
            raise ValueError(f"recipe {name} lacks {missing}") from None
        items = tuple(
            EvaluationItem(
                prompt=str(item["prompt"]),
                expected_output=str(item["expected_output"]),
                context=item.get("context"),
                hint=item.get("hint"),
            )
            for item in keys.get("evaluations") or ()
        )
        return cls(
            name=name,
            dataset_id=dataset_id,
            input_field_name=input_field,
            **{key: keys.get(f"dataset_{key}") for key in optional},
            output_field_values_to_texts=keys.get("dataset_output_field_values_to_texts") or {},
            evaluations=items,
        )

    @classmethod
    def read(cls, path: str | Path) -> Recipe:
        import yaml

        with open(path, encoding="utf8") as file:
            return cls.from_dict(str(path), yaml.safe_load(file))

    @property
    def every_kth(self) -> int:
        return EVERY_KTH.get(self.load_config or "", 1)

    @property
    def source(self) -> tuple[str, str | None]:
        return self.dataset_id, self.load_config

    @property
    def columns(self) -> tuple[str, ...]:
        names = (
            self.input_field_name,
            self.output_field_name,
            self.context_field_name if self.output_field_name else None,
            self.filter_field_name,
        )
        return tuple(n for n in names if n is not None)
