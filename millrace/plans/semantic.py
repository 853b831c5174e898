"""The semantic layer: dimensions and measures of a table, compiled to one aggregation."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.tables.bucketed import BucketedTable
from millrace.tables.table import TableStore, VersionedTable

# The words by which a column's name tells its kind.
TIME_WORDS = ("_at", "date", "timestamp")
NUMBER_WORDS = ("count", "amount", "total", "spent", "quantity", "price")
ENRICHED_NUMBER_WORDS = ("revenue", "discount")
PARTITION_NAMES = ("year", "month", "day")
#: Grains whose periods are made up of whole ones of every grain before; weeks are of days.
GRAINS = ("second", "minute", "hour", "day", "month", "quarter", "year")
ROWS, FILLED = "_rows", "_filled_"


def kind_from_name(name: str, enriched: bool = False) -> str:
    """time, number or string, guessed from a column's name."""
    lower = name.lower()
    number_words = NUMBER_WORDS + (ENRICHED_NUMBER_WORDS if enriched else ())
    if any(word in lower for word in TIME_WORDS):
        return "time"
    if any(word in lower for word in number_words):
        return "number"
    if lower == "id" or lower.endswith("_id"):
        return "string"
    return "number" if lower in PARTITION_NAMES else "string"


@dataclass(frozen=True)
class Dimension:
    column: str
    kind: str = "string"
    primary_key: bool = False


@dataclass(frozen=True)
class Measure:
    """``count`` of rows or ``sum`` of a column."""

    kind: str
    column: str | None = None

    def aggregate(self, df: DataFrame) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind != "sum":
            raise ValueError(f"unknown measure kind {self.kind!r}")
        return rounded(F.sum(self.column), df.schema[self.column].dataType)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: DataFrame
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure] = field(default_factory=lambda: {"count": Measure("count")})
    rollups: Sequence[Rollup] = ()
    #: The stored table that ``table`` was read from; rollups are used as long as it stays at their version.
    versioned: VersionedTable | None = None

    @classmethod
    def from_table(
        cls, name: str, table: DataFrame, unique_key: str | Sequence[str] | None = None, enriched: bool = False,
        versioned: VersionedTable | None = None,
    ) -> SemanticModel:
        """Dimensions for all columns, a count, and ``total_<column>`` for columns whose name
        says number. A sum over a column that holds no numbers is left out with a warning."""
        kinds = {c: kind_from_name(c, enriched) for c in table.columns}
        dimensions = {c: Dimension(c, kind, unique_key == c) for c, kind in kinds.items()}
        measures = {"count": Measure("count")}
        for column, kind in kinds.items():
            if kind != "number":
                continue
            if isinstance(table.schema[column].dataType, T.NumericType):
                measures[f"total_{column}"] = Measure("sum", column)
            else:
                warnings.warn(f"{name}: no sum for {column}, it is not numeric", stacklevel=2)
        return cls(name, table, dimensions, measures, versioned=versioned)

    def query(
        self,
        measures: Sequence[str] | None = None,
        dimensions: Sequence[str] = (),
        time_dimension: str | None = None,
        granularity: str = "day",
        filters: Sequence[Filter] = (),
        order: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Measures (all by default) per dimensions and time grain, in one aggregation.

        ``order`` holds output names, ``-name`` for descending. A rollup that has all that is
        asked for, at this grain or a finer one, is read instead of the table; of several the coarsest.
        """
        names = list(measures) if measures is not None else list(self.measures)
        asked = Request(tuple(names), tuple(dimensions), time_dimension, granularity, tuple(filters))
        version = self.current() if self.rollups else None
        able = [r for r in self.rollups if r.version == version and r.covers(asked)]
        result = min(able, key=Rollup.fineness).answer(asked) if able else self._aggregate(asked)
        if order:
            keys = [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]
            result = result.orderBy(*keys)
        return result.limit(limit) if limit is not None else result

    def _aggregate(self, asked: Request) -> DataFrame:
        df = self.table
        for condition in asked.filters:
            df = df.filter(condition.column(self.dimensions[condition.dimension].column))
        groups = [F.col(self.dimensions[d].column).alias(d) for d in asked.dimensions]
        if asked.time_dimension:
            groups.append(time_grain(df, self.dimensions[asked.time_dimension].column, asked.granularity))
        aggregates = [self.measures[m].aggregate(df).alias(m) for m in asked.measures]
        return df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)

    def build_rollup(
        self,
        table: VersionedTable | BucketedTable,
        dimensions: Sequence[str],
        time_dimension: str | None = None,
        granularity: str = "day",
        measures: Sequence[str] | None = None,
    ) -> SemanticModel:
        """Materialise an aggregation as a table and return a model that answers from it."""
        names = tuple(measures) if measures is not None else tuple(self.measures)
        asked = Request(names, tuple(dimensions), time_dimension, granularity, ())
        return replace(self, rollups=[*self.rollups, self._stored(table, asked, self._partial(self.table, asked), self.current())])

    def refreshed(self) -> SemanticModel:
        """The model at its table's current version, with every rollup brought up to it.

        From a bucketed table only the buckets that changed are read, as they were and as they are now;
        the sums of the one go out of the rollup's, those of the other come in, and a group without
        rows left disappears. Sums of floating-point numbers would not come out the same that way, and
        tables by file do not tell what changed: there the rollup is computed anew.
        """
        if self.versioned is None:
            raise ValueError(f"{self.name} is not read from a stored table")
        version = self.current()
        model = replace(self, table=self.versioned.read(version), rollups=())
        rollups = []
        for rollup in self.rollups:
            if rollup.version != version:
                exact = not any(isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)
                                for f in rollup.table.select(*rollup.request.measures).schema.fields)
                if exact and rollup.version is not None and isinstance(self.versioned, BucketedTable):
                    gone, come = self.versioned.changed_rows(rollup.version, version)
                    rows = rollup.merged(model._partial(gone, rollup.request), model._partial(come, rollup.request))
                else:
                    rows = model._partial(model.table, rollup.request)
                rollup = model._stored(rollup.stored, rollup.request, rows, version)
            rollups.append(rollup)
        return replace(model, rollups=rollups)

    def _partial(self, df: DataFrame, asked: Request) -> DataFrame:
        """Sums that can be added to others: not rounded, with the numbers of rows and of values behind them."""
        groups = [F.col(self.dimensions[d].column).alias(d) for d in asked.dimensions]
        if asked.time_dimension:
            groups.append(time_grain(df, self.dimensions[asked.time_dimension].column, asked.granularity))
        aggregates = [F.count(F.lit(1)).alias(ROWS)]
        for name in asked.measures:
            measure = self.measures[name]
            if measure.kind == "sum":
                aggregates += [F.sum(measure.column).alias(name), F.count(measure.column).alias(FILLED + name)]
            else:
                aggregates.append(measure.aggregate(df).alias(name))
        return df.groupBy(*groups).agg(*aggregates)

    def _stored(self, table: VersionedTable | BucketedTable, asked: Request, rows: DataFrame, version: int | None) -> Rollup:
        table.overwrite(rows, asked.groups or (ROWS,), operation="rollup")
        counts = frozenset(n for n in asked.measures if self.measures[n].kind == "count")
        return Rollup(table.read(), asked, counts, version, table)

    def current(self) -> int | None:
        """Version of the table that is asked, where the model knows it."""
        return self.versioned.current_version() if self.versioned is not None else None


def models_of(store: TableStore, keys: Mapping[str, str] | None = None) -> dict[str, SemanticModel]:
    """A model for every processed (``int_``) and enriched (``fct_``) table of a store."""
    return {
        name: SemanticModel.from_table(name, store.read(name), (keys or {}).get(name), name.startswith("fct_"), store.table(name))
        for name in store.names()
        if name.startswith(("int_", "fct_"))
    }


def grain_name(time_dimension: str, granularity: str) -> str:
    return f"{time_dimension}_{granularity}"


def rounded(total: Column, kind: T.DataType) -> Column:
    """Sums of decimals have two places."""
    return total.cast("decimal(38,2)") if isinstance(kind, T.DecimalType) else total


def adds_up(granularity: str, finer: str) -> bool:
    """Whether periods of one grain are made up of whole ones of another."""
    if granularity == finer:
        return True
    if granularity == "week":
        return finer in GRAINS[: GRAINS.index("day") + 1]
    return {granularity, finer} <= set(GRAINS) and GRAINS.index(granularity) > GRAINS.index(finer)


def time_grain(df: DataFrame, column: str, granularity: str) -> Column:
    kind = df.schema[column].dataType
    kept = "timestamp" if isinstance(kind, T.TimestampType) else "timestamp_ntz"
    return F.date_trunc(granularity, F.col(column)).cast(kept).alias(grain_name(column, granularity))


@dataclass(frozen=True)
class Filter:
    """A condition on a dimension: equals, in, gt, gte, lt, lte, set or not_set."""

    dimension: str
    operator: str
    value: object = None

    def column(self, name: str) -> Column:
        column = F.col(name)
        if self.operator == "in":
            return column.isin(list(self.value))
        if self.operator == "set":
            return column.isNotNull()
        if self.operator == "not_set":
            return column.isNull()
        compare = {"equals": "__eq__", "gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__"}
        return getattr(column, compare[self.operator])(F.lit(self.value))


@dataclass(frozen=True)
class Request:
    measures: tuple[str, ...]
    dimensions: tuple[str, ...]
    time_dimension: str | None
    granularity: str
    filters: tuple[Filter, ...]

    @property
    def groups(self) -> tuple[str, ...]:
        time = (grain_name(self.time_dimension, self.granularity),) if self.time_dimension else ()
        return self.dimensions + time


@dataclass(frozen=True)
class Rollup:
    """A stored aggregation; counts and sums add up to those of any coarser question."""

    table: DataFrame
    request: Request
    #: Measures that count, which are 0 over no rows and not NULL.
    counts: frozenset[str] = frozenset()
    #: Version of the source table; after a later one the rollup is not used until it is refreshed.
    version: int | None = None
    #: Where it is stored.
    stored: VersionedTable | BucketedTable | None = None

    def covers(self, asked: Request) -> bool:
        same_time = asked.time_dimension is None or (
            asked.time_dimension == self.request.time_dimension and adds_up(asked.granularity, self.request.granularity)
        )
        return (
            same_time
            and set(asked.measures) <= set(self.request.measures)
            and set(asked.dimensions) <= set(self.request.dimensions)
            and {f.dimension for f in asked.filters} <= set(self.request.dimensions)
        )

    def fineness(self) -> tuple[int, int]:
        """Smaller for rollups that have fewer rows by their grain and dimensions."""
        grain = self.request.granularity
        place = GRAINS.index("day") + 0.5 if grain == "week" else GRAINS.index(grain) if grain in GRAINS else 0
        return (-place if self.request.time_dimension else -len(GRAINS), len(self.request.dimensions))

    def answer(self, asked: Request) -> DataFrame:
        df = self.table
        for condition in asked.filters:
            df = df.filter(condition.column(condition.dimension))
        groups = [F.col(d) for d in asked.dimensions]
        if asked.time_dimension:
            stored = grain_name(asked.time_dimension, self.request.granularity)
            groups.append(time_grain(df, stored, asked.granularity).alias(grain_name(asked.time_dimension, asked.granularity)))
        aggregates = []
        for measure in asked.measures:
            kind = df.schema[measure].dataType
            total = rounded(F.sum(measure), kind)
            if measure in self.counts:
                total = F.coalesce(total, F.lit(0).cast(kind))
            aggregates.append(total.alias(measure))
        return df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)

    def merged(self, gone: DataFrame, come: DataFrame) -> DataFrame:
        """The rollup without some partial sums and with others: one aggregation of as many rows as it and they have."""
        kinds = {f.name: f.dataType for f in self.table.schema.fields}
        numbers = [n for n in self.table.columns if n not in self.request.groups]
        less = gone.select(*self.request.groups, *[(-F.col(n)).cast(kinds[n]).alias(n) for n in numbers])
        every = self.table.unionByName(less).unionByName(come.select(*self.table.columns))
        sums = every.groupBy(*self.request.groups).agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in numbers]).filter(F.col(ROWS) > 0)
        # a sum over no values is NULL again
        emptied = {n: F.when(F.col(FILLED + n) > 0, F.col(n)) for n in numbers if FILLED + n in kinds}
        return sums.withColumns(emptied).select(*self.table.columns)
