"""Running models against a store: per batch of a stream, and onwards to what depends on it."""

from __future__ import annotations

import graphlib
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.enriched import ENRICHED
from millrace.plans.model import Context, EnrichedModel, ProcessedModel
from millrace.plans.processed import PROCESSED, order_tags
from millrace.tables.table import TableStore


def processed_models(
    source: str, stream: str, models: Sequence[ProcessedModel] = tuple(PROCESSED)
) -> list[ProcessedModel]:
    """The models fed by a stream; a stream that feeds none is an error."""
    found = [m for m in models if m.stream == (source, stream)]
    if not found:
        raise LookupError(f"no model reads stream {source}/{stream}")
    return found


def run_processed(
    store: TableStore,
    model: ProcessedModel,
    landing: DataFrame,
    batch_id: str | None = None,
    guard_version: bool = False,
    replace_parent: bool = False,
) -> int:
    """Build one batch of a model and upsert it; returns the table's version.

    By default the last batch wins, whatever version its rows have; ``guard_version`` keeps
    the newest version. ``replace_parent`` (order tags) also removes the tags an order in
    the batch no longer has; guarded, the newest version of an order that has tags decides on all
    of them.
    """
    rows, also_delete = None, None
    if replace_parent and not model.parent:
        raise ValueError(f"{model.name} holds no parts of a parent")
    keys = model.parent if replace_parent and guard_version else model.keys
    if replace_parent and not guard_version:
        rows = order_tags(landing, newest_first=True)
        also_delete = landing.select(F.col("id").alias("order_id")).distinct()
    return store.table(model.name, by=model.parent).upsert(
        model(landing) if rows is None else rows,
        keys,
        batch_id=batch_id,
        guard_version=model.version if guard_version else None,
        also_delete=also_delete,
        ranges=(model.version,),
        grouped=True,
    )


def refresh_fact(store: TableStore, model: EnrichedModel, full: bool = False) -> int:
    """Rebuild a fact (first run, ``full``) or upsert its increment."""
    table = store.table(model.name)
    if full or not table.exists():
        rows = model.build(Context(store))
        return table.overwrite(rows, model.keys, operation="full refresh", ranges=(model.version,), grouped=True)
    return table.upsert(model.build(Context(store, table)), model.keys, ranges=(model.version,), grouped=True)


def in_dependency_order(models: Sequence[EnrichedModel]) -> list[EnrichedModel]:
    """Every model behind those whose tables it reads."""
    named = {m.name: m for m in models}
    needs = {m.name: [r for r in m.refs if r in named] for m in models}
    try:
        return [named[n] for n in graphlib.TopologicalSorter(needs).static_order()]
    except graphlib.CycleError as error:
        raise ValueError(f"models need each other: {' -> '.join(error.args[1])}") from None


def refresh_dependents(
    store: TableStore, changed: Iterable[str], models: Sequence[EnrichedModel] = tuple(ENRICHED)
) -> list[str]:
    """Refresh every enriched model downstream of changed tables, upstream models first.

    ``models`` may come in any order; models that need each other are an error. One whose tables do
    not all exist yet is left for a later change. Returns the names refreshed.
    """
    dirty, done = set(changed), []
    for model in in_dependency_order(models):
        if dirty & set(model.refs) and all(store.exists(r) for r in model.refs):
            refresh_fact(store, model)
            dirty.add(model.name)
            done.append(model.name)
    return done
