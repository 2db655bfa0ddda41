"""A set of named frames, each built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """Name -> DataFrame, from functions that build them."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replaced(self, **frames: DataFrame) -> LazyTables:
        """The same tables with some frames exchanged or added."""
        return LazyTables(
            {name: (lambda n=name: self[n]) for name in self} | {n: (lambda f=f: f) for n, f in frames.items()}
        )
