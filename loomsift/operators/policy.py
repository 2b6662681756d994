"""Predicates over configurations and paths; each returns what is wrong."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Protected prefixes and the ranges of a training configuration.
PROTECTED = ("core/", "contracts/", "tests/")
LORA_RANK = (8, 256)
LEARNING_RATE_MOST = 1e-2
# End of fixed values.


def protected(path: Column, prefixes: Sequence[str] = PROTECTED) -> Column:
    """Whether a path begins with a protected prefix; prefixes only."""
    return F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.startswith(path, p))


def check_paths(paths: Sequence[str], prefixes: Sequence[str] = PROTECTED) -> None:
    for path in paths:
        if path.startswith(tuple(prefixes)):
            raise PermissionError(f"protected path: {path}")


def config_issues(dataset_exists: Column, lora_r: Column, learning_rate: Column, batch_size: Column) -> Column:
    return F.array_compact(F.array(
        F.when(~dataset_exists, F.lit("dataset not found")),
        F.when(~lora_r.between(*LORA_RANK), F.lit("lora_r out of range")),
        F.when((learning_rate <= 0) | (learning_rate > LEARNING_RATE_MOST), F.lit("learning_rate out of range")),
        F.when(batch_size < 1, F.lit("batch_size below 1")),
    ))


def training_steps(n_rows: Column, epochs: int, batch: int = 32, warm_up: float = 0.05) -> tuple[Column, Column]:
    """Steps (whole batches times epochs) and warm-up steps."""
    steps = F.floor(n_rows / batch) * epochs
    return steps, F.floor(steps * F.lit(warm_up))
