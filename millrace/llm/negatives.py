"""Hard negatives by vertical scans: dimensions in an anchor's order of weight, bounds on what is left.

A block of rows is held by dimension. For an anchor the dimensions are read from its largest
component down; after each few, the least and the most that the unread ones can still add to any
row of the block bound every score, and rows that cannot enter the answer leave the bitmap. What
is left at the last dimension has its exact score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import save
from millrace.session import work_dir

#: Bytes of anchors that are searched for in one pass over the rows, and sent to every task.
WAVE_BYTES = 8 << 20
#: Bytes of a block of rows, 8 a component.
BLOCK_BYTES = 4 << 20
#: Dimensions read before the first, second, ... look at the bounds; then twice as many each time.
FIRST_DIMENSIONS = 8
#: Integers up to here are exact as doubles.
_EXACT = 1 << 53
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    """An anchor's best ``positives`` rows of its label, and for each the best ``negatives`` rows of
    other labels that score from ``low`` to ``high`` per cent of it. Components are multiplied by
    ``scale`` and rounded down."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256

    def window(self, positive: int) -> tuple[int, int]:
        """The least and the largest score a negative of this positive may have (none: least above largest)."""
        return -(-self.low * positive // 100), self.high * positive // 100


class Block:
    """Rows of one dimensionality, by dimension, with the range of each. Ids that are null sort last."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.known, self.labels = np.where(known, ids, _NO_ID), known, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.least = self.columns.min(axis=1).astype(np.float64)
        self.most = self.columns.max(axis=1).astype(np.float64)
        self.doubles = self.columns.astype(np.float64)


Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def narrow(block: Block, anchor: np.ndarray, alive: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``alive`` that ``keep(least, most)`` never ruled out, with their exact scores."""
    weights = anchor.astype(np.float64)
    ends = np.stack([weights * block.least, weights * block.most])
    if np.abs(ends).max(axis=0, initial=0).sum() >= _EXACT:  # beyond doubles: whole numbers, without bounds
        scores = anchor.astype(object) @ block.columns[:, alive].astype(object)
        if any(abs(s) > np.iinfo(np.int64).max for s in scores):
            raise ArithmeticError("a score does not fit 64 bits")
        return alive, scores.astype(np.int64)
    order = np.argsort(-np.abs(weights), kind="stable")
    # What all dimensions from one on, in this order, add at least and at most.
    left = np.concatenate([np.cumsum(np.sort(ends, axis=0)[:, order[::-1]], axis=1)[:, ::-1], np.zeros((2, 1))], axis=1)
    scores, at, step = np.zeros(len(alive)), 0, FIRST_DIMENSIONS
    while at < len(order) and len(alive):
        some = order[at : at + step]
        values = block.doubles[some]
        scores += weights[some] @ (values if len(alive) == len(block.ids) else values[:, alive])
        at, step = at + len(some), step * (1 if at == 0 else 2)
        kept = keep(scores + left[0, at], scores + left[1, at])
        if not kept.all():
            alive, scores = alive[kept], scores[kept]
    return alive, scores.astype(np.int64)


def _largest(values: np.ndarray, nth: int) -> float:
    return np.partition(values, len(values) - nth)[len(values) - nth] if len(values) >= nth else -np.inf


@dataclass
class Best:
    """The best rows so far of one list, (-score, id, place of the row in the task), best first."""

    size: int
    rows: list[tuple[int, int, int]] = field(default_factory=list)

    @property
    def bar(self) -> float:
        """Rows that score less cannot enter."""
        return -self.rows[-1][0] if len(self.rows) == self.size else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        first = np.lexsort((ids, -scores))[: self.size]
        new = zip((-scores[first]).tolist(), ids[first].tolist(), places[first].tolist())
        self.rows = sorted([*self.rows, *new])[: self.size]


@dataclass
class Wave:
    """Some anchors: their numbers, ids, labels, vectors and, for negatives, the score windows."""

    numbers: list[int]
    ids: list[int]
    labels: list[int]
    vectors: list[np.ndarray]
    windows: dict[int, list[tuple[int, int]]] = field(default_factory=dict)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray]]:
    """Blocks of rows (id, label, vector) with the rows' places in the task."""
    seen = 0
    for batch in batches:
        ids, labels, lists = (batch.column(n) for n in range(3))
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        numbers, tags = ids.fill_null(0).to_numpy(zero_copy_only=False), labels.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        for size in np.unique(sizes):
            rows = np.nonzero(sizes == size)[0]
            most = max(1, BLOCK_BYTES // (8 * max(1, int(size))))
            for start in range(0, len(rows), most):
                part = rows[start : start + most]
                vectors = values[offsets[part][:, None] + np.arange(size)]
                yield Block(numbers[part], known[part], tags[part], vectors), seen + part
        seen += len(sizes)


def _positives(wave: Wave, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(size) for _ in wave.numbers]
        for block, places in _blocks(batches):
            for mine, own, label, anchor in zip(best, wave.ids, wave.labels, wave.vectors):
                if len(anchor) != len(block.columns):
                    continue

                def keep(least: np.ndarray, most: np.ndarray, mine: Best = mine) -> np.ndarray:
                    return most >= max(mine.bar, _largest(least, size))

                alive = np.nonzero((block.labels == label) & ~((block.ids == own) & block.known))[0]
                alive, scores = narrow(block, anchor, alive, keep)
                mine.add(scores, block.ids[alive], places[alive])
        yield from _found(wave, [mine.rows for mine in best])

    return run


def _negatives(wave: Wave, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = [wave.windows.get(n, []) for n in wave.numbers]
        best = [[Best(size) for _ in w] for w in windows]
        for block, places in _blocks(batches):
            for mine, ranges, label, anchor in zip(best, windows, wave.labels, wave.vectors):
                if len(anchor) != len(block.columns) or not ranges:
                    continue

                def keep(least: np.ndarray, most: np.ndarray, mine: list[Best] = mine, ranges=ranges) -> np.ndarray:
                    kept = np.zeros(len(least), bool)
                    for found, (low, high) in zip(mine, ranges):
                        # Rows surely not above the window: if enough of them score at least so much, less is out.
                        bar = max(low, found.bar, _largest(least[most <= high], size))
                        kept |= (most >= bar) & (least <= high)
                    return kept

                alive, scores = narrow(block, anchor, np.nonzero(block.labels != label)[0], keep)
                for found, (low, high) in zip(mine, ranges):
                    inside = (scores >= low) & (scores <= high)
                    found.add(scores[inside], block.ids[alive[inside]], places[alive[inside]])
        # Windows of one anchor overlap: a row that several of them want is given once.
        yield from _found(wave, [sorted({row for found in mine for row in found.rows}) for mine in best])

    return run


_FOUND = "number long, anchor long, id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _found(wave: Wave, best: list[list[tuple[int, int, int]]]) -> Iterator[pa.RecordBatch]:
    """What a task has found: (number and id of the anchor, id and score of the row)."""
    flat = [(n, own, None if i == _NO_ID else i, -s) for n, own, mine in zip(wave.numbers, wave.ids, best) for s, i, _ in mine]
    for start in range(0, len(flat), 50_000):
        columns = zip(*flat[start : start + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["number", "anchor", "id", "score"])


def _waves(anchors: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of numbers whose anchors take at most so many bytes, or are one anchor."""
    size = F.lit(64) + 8 * F.size("vector")
    largest = anchors.agg(F.max(size)).first()[0]
    if largest is None:
        return []
    number, per = F.col("number"), max(1, most // largest)
    # A number is the place in its partition, with the partition from bit 33 on.
    block = F.floor(number.bitwiseAND((1 << 33) - 1) / per)
    blocks = anchors.groupBy(F.shiftright(number, 33), block).agg(F.min(number), F.max(number), F.sum(size)).collect()
    out, held = [], most + 1
    for _, _, low, high, size in sorted(blocks, key=lambda b: b[2]):
        if held + size <= most:
            out[-1], held = (out[-1][0], high), held + size
        else:
            out, held = [*out, (low, high)], size
    return out


def _ranked(found: DataFrame, by: list[str], most: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)


def mine_negatives(
    rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", spec: Mining = Mining()
) -> DataFrame:
    """Per anchor, positive and negative: ids, ``rank`` of the negative and both scores.

    ``anchor`` says which rows are anchors; rows without an id are none. Scores are inner products
    of whole numbers, floor(scale * component), exact in 64 bits (a larger one fails the job). Equal
    scores go by the smaller id, null ids last; an anchor's own id is no other row's. Rows without
    label or vector, or with a null or non-finite component, take no part; vectors of different
    lengths do not meet. Repeated rows count as often as they stand there. Other columns are left
    out, so their names cannot clash; no rows or no anchors give no rows.

    Every row meets every anchor in blocks, without a shuffle of rows: anchors are taken in waves of
    at most ``WAVE_BYTES``, each sent to all tasks. A first pass keeps each task's best positives of
    an anchor, a second the best rows of its score windows, known from the first; what tasks have
    found, a few rows an anchor, is ranked by shuffle. Each wave's answer is written, so a lost
    executor costs tasks of one pass.
    """
    x, spark = F.col(vector), rows.sparkSession
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * float(spec.scale)))
    taking = rows.where(F.col(label).isNotNull() & x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), whole.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    written = save(taking, "vectors")
    anchors = written.where("anchor and id is not null").select(F.monotonically_increasing_id().alias("number"), "id", "label", "vector")
    anchors, others = save(anchors, "anchors"), written.select("id", "label", "vector")
    out = work_dir(spark, "negatives")
    spark.createDataFrame([], RESULT).write.parquet(out)
    for low, high in _waves(anchors, WAVE_BYTES):
        held = anchors.where(F.col("number").between(low, high)).toArrow()
        vectors = [np.array(v.values, np.int64) for v in held["vector"]]
        wave = Wave(held["number"].to_pylist(), held["id"].to_pylist(), held["label"].to_pylist(), vectors)
        found = others.mapInArrow(_positives(wave, spec.positives), _FOUND)
        positives = save(_ranked(found, ["number"], spec.positives).withColumnRenamed("rank", "nth"), "positives")
        for number, score in positives.select("number", "score").distinct().collect():
            low_score, high_score = spec.window(score)
            if low_score <= high_score:
                wave.windows.setdefault(number, []).append((low_score, high_score))
        candidates = others.mapInArrow(_negatives(wave, spec.negatives), _FOUND).drop("anchor")
        pairs = candidates.join(positives.select("number", "nth", "anchor", F.col("id").alias("positive"), F.col("score").alias("best")), "number")
        best, score = (F.col(c).cast("decimal(19,0)") for c in ("best", "score"))  # a hundredfold may not fit a long
        fits = (spec.low * best <= 100 * score) & (100 * score <= spec.high * best)
        _ranked(pairs.where(fits), ["number", "nth"], spec.negatives).select(
            F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
            F.col("best").alias("positive_score"), F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
    return spark.read.schema(RESULT).parquet(out)
