"""Named transforms over DataFrames, the catalogue that holds them, and watched runs.

A transform is a function from named DataFrames to named DataFrames. It declares the
columns that each input must have as DDL; they are checked against the plan's schema,
so a wrong input fails before any job starts. A catalogue is a value: adding to it or
leaving out of it makes another one, which is why threads may share it.

    @step("long_only", docs="doc_id bigint, text string")
    def long_only(docs): ...

    watched(catalogue(long_only)["long_only"], "run-7", print)(docs=df)
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Frames = dict[str, DataFrame]
Observer = Callable[["Event"], None]


@dataclass(frozen=True)
class Folders:
    """Where data is read and results are written, from the environment if not given."""

    data: str = field(default_factory=lambda: os.environ.get("LOOMSIFT_DATA_DIR", "data"))
    output: str = field(default_factory=lambda: os.environ.get("LOOMSIFT_OUTPUT_DIR", "output"))


@dataclass(frozen=True)
class Event:
    """What an observer is told: ``start``, then ``end`` unless the body raised."""

    kind: str
    transform: str
    run: str
    seconds: float


class BadInput(ValueError):
    """Inputs that are missing, or lack columns of the declared types."""


def _differences(name: str, df: DataFrame, wanted: T.StructType) -> list[str]:
    there = {f.name: f.dataType.simpleString() for f in df.schema}
    return [
        f"{name}.{f.name}: {there.get(f.name, 'missing')}, not {f.dataType.simpleString()}"
        for f in wanted if there.get(f.name) != f.dataType.simpleString()
    ]


@dataclass(frozen=True)
class Step:
    """A transform: its name, the columns of its inputs (DDL, empty for any), its body."""

    name: str
    inputs: Mapping[str, str]
    body: Callable[..., Frames]

    def problems(self, frames: Mapping[str, DataFrame]) -> list[str]:
        """Why ``frames`` can't be this step's inputs."""
        out = []
        for name, ddl in sorted(self.inputs.items()):
            if name not in frames:
                out.append(f"{name}: missing")
            elif ddl:
                out += _differences(name, frames[name], T.StructType.fromDDL(ddl))
        return out

    def __call__(self, **frames: DataFrame) -> Frames:
        if found := self.problems(frames):
            raise BadInput(f"{self.name}: {'; '.join(found)}")
        made = self.body(**frames)
        if not isinstance(made, Mapping) or not all(isinstance(df, DataFrame) for df in made.values()):
            raise TypeError(f"{self.name} has to return DataFrames by name")
        return dict(made)


class Catalogue(Mapping[str, Step]):
    """Steps by name, in the order of their names."""

    def __init__(self, steps: Mapping[str, Step] = MappingProxyType({})):
        self._steps = dict(sorted(steps.items()))

    def __getitem__(self, name: str) -> Step:
        if name not in self._steps:
            raise KeyError(f"no transform {name!r} among {', '.join(self._steps) or 'none'}")
        return self._steps[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._steps)

    def __len__(self) -> int:
        return len(self._steps)

    def __or__(self, other: Mapping[str, Step]) -> Catalogue:
        """Both catalogues' steps; a name that both have is an error."""
        if both := self._steps.keys() & other.keys():
            raise ValueError(f"taken: {', '.join(sorted(both))}")
        return Catalogue(self._steps | dict(other))

    def without(self, *names: str) -> Catalogue:
        """The catalogue less these steps, each of which it has to hold."""
        gone = {self[name].name for name in names}
        return Catalogue({name: step for name, step in self._steps.items() if name not in gone})


def step(name: str, **inputs: str) -> Callable[[Callable[..., Frames]], Step]:
    """Declare a function as a step; ``inputs`` gives each parameter's columns."""

    def declare(body: Callable[..., Frames]) -> Step:
        if not callable(body):
            raise TypeError(f"{body!r} can't be called")
        return Step(name, MappingProxyType(dict(inputs)), body)

    return declare


def catalogue(*steps: Step) -> Catalogue:
    out = Catalogue()
    for one in steps:
        out |= {one.name: one}
    return out


@contextmanager
def observed(transform: str, run: str, *observers: Observer) -> Iterator[None]:
    """Tell observers of the start of a block and, if nothing is raised, of its end."""
    began = time.monotonic()
    for tell in observers:
        tell(Event("start", transform, run, 0.0))
    yield
    for tell in observers:
        tell(Event("end", transform, run, time.monotonic() - began))


def watched(one: Step, run: str | None = None, *observers: Observer) -> Callable[..., Frames]:
    """``one`` as a function whose calls observers hear of."""

    def call(**frames: DataFrame) -> Frames:
        with observed(one.name, run or uuid.uuid4().hex, *observers):
            return one(**frames)

    return call
