"""Sources by name: functions from a session and settings to samples (seq, description, code, source, metadata)."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.store import positioned

SAMPLE = ("seq", "description", "code", "source", "metadata")
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Source:
    """A source's name, priority (1 to 5, higher wins a duplicate), expected size, reader and own row rule."""

    name: str
    read: Callable[..., DataFrame]
    priority: int = 1
    estimate: int = 0
    title: str = ""
    default: bool = True  # read unless named ones are asked for
    settings: tuple[str, ...] = field(default=())
    code_only: bool = False  # rows need no description
    transform: Callable[[DataFrame], DataFrame] | None = None  # of the source's samples, before they are numbered


class Registry:
    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}

    def register(self, source: Source, replace: bool = False) -> Source:
        if source.name in self._sources and not replace:
            raise ValueError(f"source {source.name} is registered already")
        self._sources[source.name] = source
        return source

    def source(self, name: str, **about) -> Callable:
        """Decorator that registers a reader."""

        def wrap(read: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.register(Source(name, read, **about))
            return read

        return wrap

    def get(self, name: str) -> Source:
        if name not in self._sources:
            raise KeyError(f"no source {name}; there are {', '.join(sorted(self._sources))}")
        return self._sources[name]

    def names(self) -> list[str]:
        return sorted(self._sources)

    def selected(self, wanted: Iterable[str] | None = None, excluded: Iterable[str] = ()) -> list[str]:
        """The named sources that exist (unknown names are logged), else all default ones; minus the excluded."""
        out = set(excluded)
        if wanted is None:
            return [n for n in self.names() if self._sources[n].default and n not in out]
        wanted = list(wanted)
        for n in wanted:
            if n not in self._sources:
                log.warning("unknown source %s", n)
        return [n for n in wanted if n in self._sources and n not in out]

    def discover(self, package: str = "sievework.sources") -> list[str]:
        """Import a package's modules, whose decorators register their sources; nothing is overwritten."""
        import importlib
        import pkgutil

        found = importlib.import_module(package)
        for m in pkgutil.iter_modules(found.__path__):
            importlib.import_module(f"{package}.{m.name}")
        return self.names()

    def dimension(self, spark: SparkSession) -> DataFrame:
        """(source_id, source_name, priority, estimate)."""
        rows = [(s.name, s.title or s.name, s.priority, s.estimate) for _, s in sorted(self._sources.items())]
        return spark.createDataFrame(rows, "source_id string, source_name string, priority int, estimate long")

    def load(self, spark: SparkSession, settings: dict[str, dict], wanted: Iterable[str] | None = None, excluded: Iterable[str] = ()) -> DataFrame:
        """The selected sources' samples together. A source whose reader fails, now or while it runs, is logged and left out whole.

        seq numbers the rows from 0, by source first and by the source's own order within it (its own `seq`, else
        as its rows come). It is written with the rows, so every later use sees the same numbers.
        """
        out, before = None, 0
        for name in self.selected(wanted, excluded):
            if name not in settings:
                continue
            try:
                source = self.get(name)
                part = conform(source.read(spark, **settings[name]), name)
                part = source.transform(part) if source.transform else part
                order = ["seq"] if "seq" in part.columns else []
                part = positioned(part, order, f"source-{name}", "_at")
                rows = part.count()
            except Exception as e:
                log.warning("source %s failed: %s", name, e)
                continue
            part = part.withColumn("seq", F.col("_at") + before).select(*SAMPLE)
            before += rows
            out = part if out is None else out.unionByName(part)
        return out if out is not None else spark.createDataFrame([], "seq long, description string, code string, source string, metadata string")


REGISTRY = Registry()


def conform(df: DataFrame, source: str) -> DataFrame:
    """The sample columns, seq only where the source has one; metadata as JSON of what else there is."""
    extra = [c for c in df.columns if c not in SAMPLE]
    columns = {"source": F.lit(source)}
    if "metadata" not in df.columns:
        columns["metadata"] = F.to_json(F.struct(*extra)) if extra else F.lit("{}")
    return df.withColumns(columns).select(*(c for c in SAMPLE if c != "seq" or "seq" in df.columns))
