"""What a model is: a keyed table and the DataFrame transformation that fills it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.payload import json_texts, payload
from millrace.operators.dedupe import SOURCE_FILE, latest_per_key
from millrace.operators.increment import of_keys
from millrace.tables.bucketed import BucketedTable
from millrace.tables.table import TableStore, VersionedTable


@dataclass(frozen=True)
class Out:
    """One output column: a landing column, or a path in its JSON payload, and a cast.

    ``raw`` keeps a whole sub-object as compact JSON text.
    """

    source: str
    path: str | None = None
    cast: Callable[[Column], Column] | None = None
    raw: bool = False


def shape(df: DataFrame, outs: Mapping[str, Out | str]) -> DataFrame:
    """Select output columns; every JSON payload is parsed once, for all its paths, and fails
    the job if it is no JSON."""
    specs = {name: Out(out) if isinstance(out, str) else out for name, out in outs.items()}
    wanted: dict[str, list[str]] = {}
    for out in specs.values():
        if out.path is not None:
            wanted.setdefault(out.source, []).append(out.path)
    texts = {source: json_texts(payload(df, source), paths, strict=True) for source, paths in wanted.items()}
    columns = []
    for name, out in specs.items():
        if out.path is None:
            column = F.col(out.source)
        else:
            column = texts[out.source][out.path]
        columns.append((out.cast(column) if out.cast else column).alias(name))
    return df.select(*columns)


@dataclass(frozen=True)
class ProcessedModel:
    """A table kept up to date from the files of one stream."""

    name: str
    stream: tuple[str, str]
    keys: tuple[str, ...]
    version: str
    build: Callable[[DataFrame], DataFrame]
    #: Landing columns with JSON text.
    payloads: tuple[str, ...] = ()
    #: Key of the record that rows of this model are parts of.
    parent: tuple[str, ...] = ()

    def __call__(self, landing: DataFrame) -> DataFrame:
        return self.build(landing)


def latest_and_shape(
    key: str, version: str, outs: Mapping[str, Out | str]
) -> Callable[[DataFrame], DataFrame]:
    """Latest landing row per key, then the output columns: payloads of superseded
    versions are never parsed. A landing column that is missing is an error; only the file's
    path, which a scan adds, may be absent."""

    def build(landing: DataFrame) -> DataFrame:
        wanted = {name: out for name, out in outs.items() if name != SOURCE_FILE or SOURCE_FILE in landing.columns}
        return shape(latest_per_key(landing, [key], version), wanted)

    return build


@dataclass(frozen=True)
class Context:
    """What an enriched model sees: other tables, and its own when it runs on top of it."""

    store: TableStore
    target: VersionedTable | None = None

    @property
    def incremental(self) -> bool:
        return self.target is not None

    def ref(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """Another table, or its rows of the keys in a one-column table. Tables in buckets of that
        column read the keys' buckets only."""
        if keys is None:
            return self.store.read(name)
        table = self.store.table(name)
        return table.read_keys(keys) if isinstance(table, BucketedTable) else of_keys(table.read(), keys.columns[0], keys)


@dataclass(frozen=True)
class EnrichedModel:
    """A table computed from other tables; ``refs`` are the tables it reads."""

    name: str
    refs: tuple[str, ...]
    keys: tuple[str, ...]
    version: str
    build: Callable[[Context], DataFrame]
