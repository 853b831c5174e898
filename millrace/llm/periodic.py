"""Periodic runs of words by a dictionary of basic factors: names of all factors of power-of-two lengths."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose factors are named together; one longer text is named alone.
BATCH_WORDS = 1 << 17
_EMPTY = np.empty(0, np.int64)


def _successors(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the keys, the distance of each place to the next one of its name (0: none), and
    whether the name occurs again at all."""
    order = np.argsort(key, kind="stable")
    ordered, places = key[order], at[order]
    same = ordered[1:] == ordered[:-1]
    names, distance, again = (np.zeros(len(at), t) for t in (np.int64, np.int64, bool))
    names[order[1:]] = np.cumsum(~same)
    distance[order[:-1][same]] = (places[1:] - places[:-1])[same]
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return names, distance, again


def _progressions(at: np.ndarray, distance: np.ndarray, length: int) -> np.ndarray:
    """Rows (start, length, period) of the stretches of places whose successor is equally far.

    The occurrences of a factor inside a window of twice its length are one arithmetic progression;
    its difference is the proposed period. Neighbouring places with equal differences extend each
    other: their factors and successors cover one stretch that has the period, and the stretch ends
    where the next word breaks it. Differences up to half the length have been proposed, and the
    same stretches found, by a shorter factor: they are duplicates.
    """
    near = np.nonzero((distance <= length) & (2 * distance > length))[0]
    if not len(near):
        return np.empty((0, 3), np.int64)
    place, period = at[near], distance[near]
    first = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(period) != 0)])
    last = np.concatenate([first[1:], [True]])
    return np.stack([place[first], place[last] - place[first] + period[first] + length, period[first]], axis=1)


def runs_of(codes: np.ndarray, doc: np.ndarray, shortest: int = 6, exponent: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs in concatenated texts, by start and period.

    ``codes`` are the words as numbers below 2^32 and ``doc`` the ascending numbers of their texts.
    A run has its smallest period ``q`` and at least ``max(shortest, exponent * q)`` words. Factors
    of twice the length are named by the pair of names of their halves. A factor that occurs once
    in its text is part of no longer one that occurs twice, so it is named no further.
    """
    at, key = np.arange(len(codes)), (doc.astype(np.int64) << 32) | codes
    name_at = np.full(len(codes), -1, np.int64)
    found, length = [np.empty((0, 3), np.int64)], 1
    while len(at):
        names, distance, again = _successors(at, key)
        runs = _progressions(at, distance, length)
        found.append(runs[runs[:, 1] >= np.maximum(shortest, exponent * runs[:, 2])])
        at, names = at[again], names[again]
        name_at[at] = names
        fits = np.nonzero(at + length < len(codes))[0]
        right = name_at[at[fits] + length]
        whole = (right >= 0) & (doc[at[fits]] == doc[np.minimum(at[fits] + length, len(codes) - 1)])
        name_at[at] = -1
        key = names[fits][whole] * len(codes) + right[whole]
        at, length = at[fits][whole], 2 * length
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of some texts): so many texts that their words are few, or one text."""
    first, held, count = 0, [], 0
    for row, text in enumerate(texts):
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
        if held and count + len(words) > BATCH_WORDS:
            yield first, held
            first, held, count = row, [], 0
        held.append(words)
        count += len(words)
    if held:
        yield first, held


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _search(texts: list[list[bytes]], shortest: int, exponent: int) -> list[pa.Array]:
    """Word counts, runs and collapsed texts of some texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    numbers = _Numbers()
    codes = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    runs = runs_of(codes, np.repeat(np.arange(len(texts)), sizes), shortest, exponent)
    start, length, period = runs.T
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    collapsed = [
        b" ".join(words if part.all() else compress(words, part.tolist()))
        for words, part in ((w, kept[b : b + len(w)]) for w, b in zip(texts, begins))
    ]
    bounds = np.searchsorted(start, [*begins, len(codes)]) if len(texts) else _EMPTY
    # Texts without words begin where the next one does; they hold no run.
    of = np.searchsorted(begins, start, side="right") - 1
    columns = [pa.array(c) for c in (start - begins[of], length, period)]
    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
    return [pa.array(sizes), listed, pa.array(collapsed, pa.binary()).cast(pa.string())]


def _find(shortest: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batches(batch.column(1)):
                keys = batch.column(0).slice(first, len(texts))
                columns = _search(texts, shortest, exponent)
                yield pa.RecordBatch.from_arrays([keys, *columns], ["key", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, exponent: int = 4) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``runs`` and ``collapsed``.

    Words are cut at ASCII white space and compared byte by byte. ``runs`` holds (start, length,
    period) of every maximal stretch of words, numbered from 0, whose smallest period is ``period``
    and whose length is at least ``shortest`` and ``exponent`` periods, by start and period.
    ``exponent`` is 3 or more: that long, a run holds a factor of the least power of two that is
    not below its period, and the next place of that factor is one period on, never nearer.
    ``collapsed`` is the text without the words that any run repeats, those after its first period,
    joined by single spaces.

    One pass without a shuffle: every text is searched where it is read, a bounded number of words
    at a time, or one whole text, in O(n log n) at worst. Null texts are empty; texts without words
    have no runs and collapse to nothing. Repeated rows, and rows of one key or none, give a row
    each. Other columns are left out, so their names cannot clash.
    """
    if exponent < 3:
        raise ValueError("exponent must be at least 3")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_find(shortest, exponent), schema).withColumnRenamed("key", key)
