"""Benchmark decontamination: every shard of documents is an FM-index in which test phrases are searched."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import release_memory
from millrace.llm.fm_index import FMIndex

#: Words of a window, and words of documents that make up one index.
WINDOW = 10
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text that are searched, and broadcast, at a time; more is done in blocks.
BLOCK_BYTES = 4 << 20

#: ASCII bytes that are not word characters become spaces; upper case is lowered before.
_CUT = bytes(c if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else 0x20 for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_CUT).split()


class Phrases:
    """The windows of a block of benchmark items as numbers: what a task needs to search them."""

    def __init__(self, items: list[Row] | list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for start in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[start : start + window]), set()).add("null" if item is None else str(item))
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.windows = np.zeros((len(owners), window), np.int32)
        for row, codes in zip(self.windows, owners):
            row[window - len(codes) :] = codes
        self.owners = [sorted(o) for o in owners.values()]
        self.least = int(self.lengths.min(initial=window))


def occurrences(codes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of every window in a shard's word codes; code 0 is a word of no window or an end.

    Only runs of known words that could hold a window are indexed: no window spans any other word.
    """
    known = codes > 0
    edges = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    long = ends - starts >= phrases.least
    if not long.any() or not len(phrases.owners):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marks = np.zeros(len(codes) + 2, np.int64)
    marks[starts[long]] += 1
    marks[ends[long] + 1] -= 1  # with the code after the run, which is 0
    origin = np.nonzero(np.cumsum(marks[:-2]))[0]
    index = FMIndex(codes[origin].astype(np.int64))
    low, high = index.search(phrases.windows.astype(np.int64), phrases.lengths)
    counts = high - low
    window = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return window, origin[index.locate(rows)]


def search_shard(texts: list[list[int]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Of every document, given as word codes, the merged (from, until) word spans and the items hit."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    codes = np.zeros(int(lengths.sum()) + len(texts), np.int32)
    for begin, text in zip(begins, texts):
        codes[begin : begin + len(text)] = text
    window, place = occurrences(codes, phrases)
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
    if not len(window):
        return out
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + phrases.lengths[window], -1)
    edges = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
    for start, end in zip(np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]):
        doc = int(np.searchsorted(begins, start, side="right")) - 1
        out[doc][0].append((int(start - begins[doc]), int(end - begins[doc])))
    owner = np.searchsorted(begins, place, side="right") - 1
    for doc, number in set(zip(owner.tolist(), window.tolist())):
        out[doc][1].update(phrases.owners[number])
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def search_texts(texts: pa.Array, phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """Word counts, word spans and items of a batch of texts, one index for each shard of them."""
    counts, spans, items = [], [], []
    shard: list[list[int]] = []
    held, code = 0, phrases.vocabulary.get

    def close() -> None:
        for found, owners in search_shard(shard, phrases):
            spans.append(found)
            items.append(owners)
        shard.clear()

    for text in texts:
        words = words_of(text.as_py())
        counts.append(len(words))
        shard.append(list(map(code, words, repeat(0))))
        held += len(words)
        if held >= SHARD_WORDS:
            close()
            held = 0
    if shard:
        close()
    return counts, spans, items


def removal_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as code point spans."""
    if not spans:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("until", pa.int64())]))
_FOUND = [("n_words", pa.int64()), ("spans", _SPANS), ("chars", _SPANS), ("items", pa.list_(pa.string()))]
_DDL = "n_words long, spans array<struct<from:long,until:long>>, chars array<struct<from:long,until:long>>, items array<string>"


def _pairs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"from": a, "until": b} for a, b in spans]


def _report(shared, last: bool):
    """Adds one block's findings to those of the blocks before; the last block drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            texts = batch.column(1)
            counts, spans, items = search_texts(texts, phrases)
            if batch.num_columns > 2:
                for i, (old, owned) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())):
                    spans[i] = merged(spans[i] + [(s["from"], s["until"]) for s in old])
                    items[i].update(owned)
            chars = [removal_spans(texts[i].as_py(), s) if last and s else [] for i, s in enumerate(spans)]
            columns = [
                pa.array(counts, pa.int64()), pa.array([_pairs(s) for s in spans], _SPANS), pa.array([_pairs(s) for s in chars], _SPANS),
                pa.array([sorted(i) for i in items], pa.list_(pa.string())),
            ]
            kept = [0] if last else [0, 1]
            fields = [batch.schema.field(k) for k in kept] + [pa.field(n, t) for n, t in _FOUND]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *columns], schema=pa.schema(fields))

    return run


def _drop(shared, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            _, spans, _ = search_texts(batch.column(column), phrases)
            yield batch.filter(pa.array([not s for s in spans], pa.bool_()))
        release_memory()

    return run


def _blocks(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[tuple[object, bool]]:
    """The benchmark as broadcast phrases, a block of bounded size at a time, and whether it is the last."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(text, F.lit("")).alias("body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = int(size // BLOCK_BYTES) + 1
    context = benchmark.sparkSession.sparkContext
    for number in range(count):
        block = rows.where(F.pmod(F.xxhash64("body"), F.lit(count)) == number).collect()
        yield context.broadcast(Phrases(block, window)), number == count - 1


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``spans`` (merged, in words), ``chars`` (the same in code
    points), ``items`` (ids of benchmark items with an occurring window, as strings).

    Words are runs of digits, a-z (A-Z lower-cased) and all beyond ASCII. An item's windows are
    ``window`` consecutive words, or all of a shorter item. Each task indexes its documents in
    shards of about a million words and searches all windows backwards at once; nothing is
    shuffled. A benchmark above ``BLOCK_BYTES`` is searched in blocks, one pass each.

    Null and empty texts have no words; null and empty items have no windows; equal windows count
    for all items that have them; a null item id reads "null". Repeated rows are reported alike,
    one row each. Other columns are left out. Empty tables give no rows, or rows without hits.
    """
    found = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("body"))
    kind = found.schema["key"].dataType.simpleString()
    for shared, last in _blocks(benchmark, item, item_text, window):
        found = found.mapInArrow(_report(shared, last), f"key {kind}, " + ("" if last else "body string, ") + _DDL)
    return found.withColumnRenamed("key", key)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no window of the benchmark."""
    schema: StructType = docs.schema
    for shared, _ in _blocks(benchmark, item, item_text, window):
        docs = docs.mapInArrow(_drop(shared, docs.columns.index(text)), schema)
    return docs


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without its removal spans, which are merged and in order."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])
