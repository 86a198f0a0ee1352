"""Transforms and engines by name, and pipelines from configuration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rosterloom.operators import layout, parse

Step = Callable[..., DataFrame]


class Registry:
    """Names to callables; an unknown name is a KeyError that lists the known ones."""

    def __init__(self) -> None:
        self._known: dict[str, Callable] = {}

    def register(self, name: str, what: Callable) -> None:
        self._known[name] = what

    def create(self, name: str, **params):
        if name not in self._known:
            raise KeyError(f"{name} is not registered; known: {', '.join(self.registered())}")
        return self._known[name](**params)

    def registered(self) -> list[str]:
        return sorted(self._known)

    def available(self) -> list[str]:
        """The names whose engine says that it can run."""
        return [n for n in self.registered() if getattr(self._known[n], "is_available", lambda: True)()]


class Pipeline:
    """Steps over DataFrames in order, each with its parameters."""

    STEPS: dict[str, Step] = {
        "page_lines": parse.page_lines, "sanitize": parse.sanitize_lines, "parse": parse.parse_lines, "records": parse.records,
        "rejects": parse.rejects, "quality": parse.page_quality, "word_rows": layout.word_rows, "lines_of_words": layout.lines_of_words,
    }

    def __init__(self) -> None:
        self._steps: list[tuple[str, dict]] = []

    def add(self, name: str, **params) -> Pipeline:
        if name not in self.STEPS:
            raise KeyError(name)
        self._steps.append((name, params))
        return self

    @classmethod
    def from_config(cls, config: list[dict]) -> Pipeline:
        out = cls()
        for c in config:
            out.add(c["name"], **c.get("params", {}))
        return out

    def run(self, df: DataFrame) -> DataFrame:
        for name, params in self._steps:
            df = df.transform(self.STEPS[name], **params)
        return df
