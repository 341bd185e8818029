"""Models as a graph: each names the models it reads, and the graph says what is built, and when."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

Build = Callable[..., DataFrame]


@dataclass(frozen=True)
class Model:
    """A model, the models and sources it reads, and the function of those that builds it.

    A ``stored`` model is written before the models that read it are built, the others are views.
    """

    name: str
    needs: tuple[str, ...]
    build: Build
    stored: bool = True


@dataclass
class ModelGraph:
    """Declared models; names that no model has are sources."""

    models: dict[str, Model] = field(default_factory=dict)

    def model(self, name: str, *needs: str, stored: bool = True) -> Callable[[Build], Build]:
        """Declare the decorated function as a model; it is called with what the model reads."""

        def declare(build: Build) -> Build:
            self.add(Model(name, needs, build, stored))
            return build

        return declare

    def add(self, model: Model) -> None:
        if model.name in self.models:
            raise ValueError(f"model {model.name} is declared twice")
        self.models[model.name] = model

    def sources(self) -> set[str]:
        return {need for model in self.models.values() for need in model.needs} - set(self.models)

    def order(self, select: Iterable[str] | None = None) -> list[Model]:
        """The selected models (all, if none are) with all they read, every model after its needs.

        A name with a ``+`` behind it also selects the models that read it, and those that read them.
        """
        chosen = self._with_needs(self._selected(select))
        graph = {n: [need for need in self.models[n].needs if need in self.models] for n in self.models if n in chosen}
        try:
            return [self.models[name] for name in TopologicalSorter(graph).static_order()]
        except CycleError as error:
            raise ValueError(f"models read each other: {' -> '.join(reversed(error.args[1]))}") from None

    def _selected(self, select: Iterable[str] | None) -> set[str]:
        if select is None:
            return set(self.models)
        chosen: set[str] = set()
        for name in select:
            plain = name.removesuffix("+")
            if plain not in self.models:
                raise ValueError(f"there is no model {plain}")
            chosen |= self._readers(plain) if name.endswith("+") else {plain}
        return chosen

    def _readers(self, name: str) -> set[str]:
        found, todo = set(), [name]
        while todo:
            one = todo.pop()
            if one not in found:
                found.add(one)
                todo += [m.name for m in self.models.values() if one in m.needs]
        return found

    def _with_needs(self, names: set[str]) -> set[str]:
        found, todo = set(), list(names)
        while todo:
            one = todo.pop()
            if one in self.models and one not in found:
                found.add(one)
                todo += self.models[one].needs
        return found

    def build(
        self,
        sources: Mapping[str, DataFrame],
        store: Callable[[str, DataFrame], DataFrame],
        select: Iterable[str] | None = None,
        after: Callable[[Mapping[str, DataFrame]], None] | None = None,
    ) -> dict[str, DataFrame]:
        """Build the selected models in order; ``store`` writes a stored one and gives it back as read.

        ``after`` is called with all views once these are there, before anything is written.
        """
        order, built = self.order(select), {}
        for views in (True, False):
            for model in order:
                if model.stored == views:
                    continue
                missing = [need for need in model.needs if need not in built and need not in sources]
                if missing:
                    raise ValueError(f"{model.name} reads {', '.join(missing)}, which is not built before it")
                rows = model.build(*[built[n] if n in built else sources[n] for n in model.needs])
                built[model.name] = store(model.name, rows) if model.stored else rows
            if views and after is not None:
                after(dict(built))
        return built
