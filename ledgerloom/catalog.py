"""Logical names for source tables and models."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ledgerloom.config import RunContext


class Catalog:
    """Resolves ``source(name)`` to a raw relation and ``ref(name)`` to a model.

    Both are built on first use and remembered, so two marts that read the same staging model share
    one logical plan, and Spark can reuse its exchanges.
    """

    def __init__(
        self,
        sources: Mapping[str, Callable[[], DataFrame]],
        ctx: RunContext,
        models: Mapping[str, Callable[[Catalog], DataFrame]] | None = None,
    ):
        if models is None:
            from ledgerloom.plans import MODELS as models  # the standard staging models and marts
        self.ctx = ctx
        self._sources = dict(sources)
        self._models = dict(models)
        self._built: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self._resolve("source", name, self._sources, lambda make: make())

    def ref(self, name: str) -> DataFrame:
        return self._resolve("model", name, self._models, lambda make: make(self))

    def relation(self, name: str) -> DataFrame:
        """A model if one has that name, else a source."""
        return self.ref(name) if name in self._models else self.source(name)

    def replace(self, name: str, df: DataFrame) -> None:
        """Use ``df`` for a model from now on, e.g. the table it was just written to."""
        self._built[f"model:{name}"] = df

    @property
    def source_names(self) -> list[str]:
        return list(self._sources)

    def _resolve(self, kind, name, known, build):
        slot = f"{kind}:{name}"
        if slot not in self._built:
            if name not in known:
                raise KeyError(f"no {kind} named {name!r}; known: {', '.join(sorted(known))}")
            self._built[slot] = build(known[name])
        return self._built[slot]
