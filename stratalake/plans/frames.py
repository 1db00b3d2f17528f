"""Named DataFrames that are planned on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Frames(Mapping[str, DataFrame]):
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


class Star:
    """The star schema: ``star.fct_sales`` and so on over any mapping of tables."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError:
            raise AttributeError(name) from None

    def changed(self, **changes: Callable[[DataFrame], DataFrame]) -> Star:
        """A star with some tables transformed, still planned only when used."""

        def builder(name: str) -> Callable[[], DataFrame]:
            change = changes.get(name)
            return lambda: change(self.tables[name]) if change else self.tables[name]

        return Star(Frames({name: builder(name) for name in self.tables}))
