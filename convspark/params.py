"""Options of the three dataset builders and of the evaluation, with their default values."""

from __future__ import annotations

from dataclasses import dataclass, fields

FORMATS = ("tfrecord", "json", "parquet")


def check_positive(**values: int) -> None:
    """Raise unless every value is a positive whole number."""
    for name, value in values.items():
        if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
            raise ValueError(f"{name} must be a positive integer, got {value!r}")


class _Checked:
    def __post_init__(self) -> None:
        numbers = {f.name: getattr(self, f.name) for f in fields(self) if f.type in ("int", "int | None")}
        check_positive(**{name: value for name, value in numbers.items() if value is not None})
        dataset_format = getattr(self, "dataset_format", FORMATS[0])
        if dataset_format not in FORMATS:
            raise ValueError(f"dataset_format must be one of {FORMATS}, got {dataset_format!r}")


@dataclass(frozen=True)
class ThreadOptions(_Checked):
    """Threaded comments: lengths are characters."""

    parent_depth: int = 10
    min_length: int = 9
    max_length: int = 127
    train_split: float = 0.9
    num_shards_train: int = 1000
    num_shards_test: int = 100
    dataset_format: str = "tfrecord"


@dataclass(frozen=True)
class LineOptions(_Checked):
    """Ordered dialogue lines: lengths are characters."""

    num_extra_contexts: int = 10
    min_length: int = 9
    max_length: int = 127
    train_split: float = 0.9
    num_shards_train: int = 1000
    num_shards_test: int = 100
    dataset_format: str = "tfrecord"


@dataclass(frozen=True)
class QaOptions(_Checked):
    """Question/answer records: lengths are words."""

    min_words: int = 4
    max_words: int = 59
    train_split: float = 0.9
    num_shards_train: int = 100
    num_shards_test: int = 10
    dataset_format: str = "tfrecord"


@dataclass(frozen=True)
class EvalOptions(_Checked):
    """1-of-N evaluation; ``n_candidates`` is N. Without sizes, all training rows and all full batches are used."""

    n_candidates: int = 100
    train_size: int | None = None
    eval_num_batches: int | None = None
    deduplicate_eval: bool = False
