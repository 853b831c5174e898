"""Counts of word n-grams in files by ranges of a 64-bit key, and what blocks of texts ask of them.

An n-gram's key is made from its last word on: the key of its last words, mixed with the digest of the word
before them. N-grams with the same last two words lie in one part, so all orders are counted there, and what
follows the same two words is counted beside them. Rows of the shuffles are whole arrays, not n-grams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext

from millrace.llm.token_files import filesystem

#: Marks before and after every word; control characters that white-space splitting leaves no word with.
BEGIN, END = "\x02", "\x03"
#: Bytes of texts that are looked at at once, words of texts that ask at once, and different words a task remembers.
SLICE_BYTES, BLOCK_WORDS, _MEMO = 2_000_000, 500_000, 1_000_000
_ODD, _MIX, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)

MESSAGE = pa.schema([("to", pa.int64()), ("block", pa.int64()), ("body", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("to", pa.int64()), ("body", pa.binary())])
#: ``kind`` 0: of a word its count, and as a context the sum of the counts that follow and how many are 1, 2 and
#: more. Others: of the n-grams of an order how many have counts 1 to 4.
TALLY = pa.schema([(c, pa.int64()) for c in ("kind", "key", "n", "total", "one", "two", "more")])
WORD = pa.schema([("key", pa.int64()), ("log", pa.float64())])
SCORE = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("log", pa.float64()), ("symbols", pa.int64()), ("last", pa.float64()), ("back", pa.float64())])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def words_of(text: str | None) -> list[str]:
    return (text or "").replace(BEGIN, " ").replace(END, " ").split()


# -- words and their digests ------------------------------------------------------------------------

#: Bytes that cut words as :func:`words_of` does, first bytes of longer white space, and that white space.
_CUTS, _BLANK, _FIRST = (np.zeros(256, bool) for _ in range(3))
_CUTS[[2, 3, *(i for i in range(128) if chr(i).isspace())]] = True
_BLANK[32] = True
_WIDE = [chr(i).encode() for i in range(128, 0x110000) if chr(i).isspace()]
_FIRST[[w[0] for w in _WIDE]] = True
#: Words of more bytes are digested one by one.
_LONG = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x ^= x >> _HALF
        x *= _MIX
    x ^= x >> _HALF
    x[x == 0] = 1
    return x


def _digests(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit digests, never 0, of the stretches of some bytes: eight bytes at a time are mixed in."""
    eights = np.concatenate([data, np.zeros(16 - len(data) % 8, np.uint8)]).view(np.uint64)
    sizes = stops - starts
    out = sizes.astype(np.uint64) * _ODD
    at, step = np.arange(len(starts)), 0
    while len(at):
        place = starts[at] + step
        shift = ((place & 7) << 3).astype(np.uint64)
        first = place >> 3
        x = (eights[first] >> shift) | np.where(shift > 0, eights[first + 1] << (np.uint64(64) - shift & np.uint64(63)), np.uint64(0))
        rest = np.maximum(8 - (sizes[at] - step), 0).astype(np.uint64) << np.uint64(3)
        x = np.where(rest < 64, x << (rest & np.uint64(63)), np.uint64(0))
        out[at] = _mixed(out[at] * _ODD + x)
        step += 8
        at = at[sizes[at] > step] if step < _LONG else at[:0]
    raw = data.data
    for i in np.flatnonzero(sizes > _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : stops[i]]) or 1
    return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, none for nulls, and where each begins and the last ends."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def _found_words(data: np.ndarray, ends: np.ndarray, marked: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and stop, how many each text has, and how many code points are in them. ``marked``: cut at
    white space, else at blanks."""
    inside = ~(_CUTS if marked else _BLANK)[data]
    if marked:
        wide = np.flatnonzero(_FIRST[data])
        for space in _WIDE if len(wide) else ():
            at = wide[wide <= len(data) - len(space)]
            for n, byte in enumerate(space):
                at = at[data[at + n] == byte]
            for n in range(len(space)):
                inside[at + n] = False
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    firsts = np.searchsorted(starts, ends)
    sizes = np.concatenate([[0], np.cumsum(stops - starts)])
    later = np.flatnonzero(inside & ((data & 0xC0) == 0x80))  # bytes of a code point after its first
    return starts, stops, np.diff(firsts), np.diff(sizes[firsts]) - np.diff(np.searchsorted(later, ends))


def digests(words: pa.Array) -> np.ndarray:
    data, ends = _bytes_of(words)
    return _digests(data, ends[:-1], ends[1:])


# -- keys -------------------------------------------------------------------------------------------


def longer(keys: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Keys of n-grams with a word more, from those of their last words and the digests of the first; never 0."""
    return _mixed(keys * _ODD + before)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> _HALF) * np.uint64(parts) >> _HALF).astype(np.int64)


def _longer(pairs: np.ndarray, words: np.ndarray, place: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """By order from 2 up the keys of the n-grams that end at some words, whose keys of order 2 are given; 0 where
    the text has fewer words before."""
    keys = [pairs]
    for k in range(2, order):
        key, own = np.zeros(len(at), np.uint64), np.flatnonzero(place[at] >= k)
        key[own] = longer(keys[-1][own], words[at[own] - k])
        keys.append(key)
    return keys


# -- arrays as bytes --------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, or of floats, each by its bytes' places and compressed."""
    head, bodies = [len(arrays)], []
    for a in arrays:
        if a.dtype.kind != "f":
            a = a.astype(np.min_scalar_type(int(a.max())) if a.size else np.uint8)
        bodies.append(pa.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), "zstd", asbytes=True) if a.size else b"")
        head += [-a.itemsize if a.dtype.kind == "f" else a.itemsize, a.size, len(bodies[-1])]
    return b"".join([np.array(head, np.int64).tobytes(), *bodies])


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 3 * n, 8).reshape(-1, 3).tolist()
    out, start = [], 8 + 24 * n
    for width, size, length in head:
        kind = np.dtype(f"{'f' if width < 0 else 'u'}{abs(width)}")
        raw = pa.decompress(data[start : start + length], size * abs(width), "zstd", asbytes=True) if size else b""
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(abs(width), size).T).view(kind).ravel())
        start += length
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _write(folder: str, part: int, data: bytes) -> None:
    fs, base = filesystem(folder)
    hidden = f"{base}/.{part}.{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(hidden) as out:
        out.write(data)
    fs.move(hidden, f"{base}/{part}")  # a repeated task writes the same bytes under the same name


def _read(folder: str, part: int) -> list[np.ndarray] | None:
    """The arrays of a part; nothing if no n-gram fell into it."""
    fs, base = filesystem(folder)
    if fs.get_file_info(f"{base}/{part}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(f"{base}/{part}") as source:
        return unpack(source.read())


# -- texts ------------------------------------------------------------------------------------------


@dataclass
class _Block:
    """Some texts: digests, symbols and numbers of words of each, and the digests of all words."""

    d1: np.ndarray
    d2: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    words: np.ndarray

    @property
    def place(self) -> np.ndarray:
        """Of every word in its text."""
        return np.arange(len(self.words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, a text, has some bytes together."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        which = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        starts = np.append(np.flatnonzero(np.diff(which, prepend=-1)), batch.num_rows).tolist()
        for start, end in zip(starts, starts[1:]):
            yield batch.slice(start, end - start)


def _blocks(batches: Iterator[pa.RecordBatch], marked: bool) -> Iterator[_Block]:
    """Blocks of rows of two digests and a text. ``marked``: texts are cut at white space and begin with
    a mark; else they are n-grams, cut at blanks."""
    begin, held, n = digests(pa.array([BEGIN])), [], 0

    def block() -> _Block:
        return _Block(*(np.concatenate(c) for c in zip(*held)))

    for batch in _slices(batches):
        data, ends = _bytes_of(batch.column(2))
        starts, stops, lengths, points = _found_words(data, ends, marked)
        words = _digests(data, starts, stops)
        if marked:
            words = np.insert(words, np.cumsum(lengths) - lengths, begin[0])
        d1, d2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        held.append((d1, d2, points + lengths, lengths + marked, words))
        n += len(words)
        if n >= BLOCK_WORDS:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def different_words(marked: bool = True):
    """The different words of a task's texts; beyond so many that are remembered some come again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, np.uint64)
        for batch in _slices(batches):
            data, ends = _bytes_of(batch.column(0))
            starts, stops, _, _ = _found_words(data, ends, marked)
            codes, keys = pd.factorize(_digests(data, starts, stops))
            order = np.argsort(keys)
            keys, first = keys[order], _firsts(codes)[order]
            at = np.searchsorted(known, keys)
            new = np.ones(len(keys), bool)
            new[at < len(known)] = known[at[at < len(known)]] != keys[at < len(known)]
            keys, first, at = keys[new], first[new], at[new]
            known = keys if len(known) >= _MEMO else np.insert(known, at, keys)
            raw = data.tobytes()
            words = [raw[s:e] for s, e in zip(starts[first].tolist(), stops[first].tolist())]
            own = pa.array(words, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([own if marked else own.filter(pc.not_equal(own, BEGIN))], names=["word"])

    return run


def _dealt(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, and where, in order."""
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    ends = np.append(np.flatnonzero(np.diff(part[order])) + 1, len(part))
    start = 0
    for end in ends.tolist() if len(part) else ():
        yield int(part[order[start]]), order[start:end]
        start = end


def _messages(rows: Sequence[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MESSAGE)], schema=MESSAGE)


# -- counting ---------------------------------------------------------------------------------------


def send(order: int, parts: int, share: int, shares: int):
    """All n-grams of those parts that are ``share`` modulo ``shares``. Block 0: words before the last, last words and the
    keys of orders from 3 on; block 1: for two words in a row and more the keys as contexts, and those with what follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, True):
            words, place, rows = block.words, block.place, []
            ends = np.flatnonzero(place >= 1)
            lead = longer(words[ends], words[ends - 1]) if order > 1 else words[ends]
            part = part_of(lead, parts)
            mine = np.flatnonzero(part % shares == share)
            at = ends[mine]
            kinds = [(0, part[mine], [words[at - 1], words[at], *_longer(lead[mine], words, place, at, order)[1:]])]
            if order > 2:
                mine = mine[(mine + 1 < len(ends))]
                mine = mine[ends[np.minimum(mine + 1, len(ends) - 1)] == ends[mine] + 1]  # a word follows in the same text
                at = ends[mine]
                follow = _longer(lead[mine + 1], words, place, at + 1, order)[1:]
                kinds.append((1, part[mine], [*_longer(lead[mine], words, place, at, order - 1), *follow]))
            for kind, to_part, arrays in kinds:
                for to, own in _dealt(to_part, parts):
                    raw = b"".join(a[own].tobytes() for a in arrays)
                    rows.append((to, kind, len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)))
            yield _messages(rows)

    return run


def _gathered(table: pa.Table, kind: int, width: int) -> list[np.ndarray]:
    found = []
    for which, body in zip(table["block"].to_pylist(), table["body"]):
        if which == kind:
            body = body.as_py()
            raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), "zstd", asbytes=True)
            found.append(np.frombuffer(raw, np.uint64).reshape(width, -1))
    return list(np.concatenate(found, axis=1)) if found else [np.zeros(0, np.uint64)] * width


def _firsts(codes: np.ndarray) -> np.ndarray:
    """Where each of the codes that :func:`pandas.factorize` gives occurs first."""
    return np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, where each occurs first and how often."""
    codes, different = pd.factorize(keys)
    order = np.argsort(different)
    return different[order], _firsts(codes)[order], np.bincount(codes, minlength=len(order))[order]


def _counted(keys: np.ndarray, wider: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, where each occurs first and their counts: of the highest order raw; below, of the different
    words before, or raw where a text begins (``wider``, the key with a word more, is 0). Keys of 0 are left out."""
    at = np.flatnonzero(keys)
    if wider is not None:
        begins = wider[at] == 0
        at = np.concatenate([at[~begins][_firsts(pd.factorize(wider[at[~begins]])[0])], at[begins]])
    different, first, counts = _distinct(keys[at])
    return different, at[first], counts


def _tallied(contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different contexts, and for each the sum of the counts and how many are 1, 2 and more."""
    codes, different = pd.factorize(contexts)
    order = np.argsort(different)
    sums = [np.bincount(codes, counts, len(order)), *(np.bincount(codes[own], minlength=len(order)) for own in (counts == 1, counts == 2, counts > 2))]
    return different[order], [a.astype(np.int64)[order] for a in sums]


def count(order: int, folder: str):
    """Writes the counts of a part to its file; of single words and of the counts of counts to rows."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        before, last, *keys = _gathered(table, 0, max(order, 2))
        rows: list[list[np.ndarray]] = []

        def tell(kind: int, *columns) -> None:
            size = len(columns[0])
            filled = [np.asarray(c).astype(np.uint64).view(np.int64) for c in columns]
            rows.append([np.full(size, kind, np.int64), *filled, *[np.zeros(size, np.int64)] * (len(TALLY) - 1 - len(columns))])

        if order == 1:
            tell(0, *_distinct(last)[::2])
        else:
            keys = [longer(last, before), *keys]
            levels = [_counted(k, wider) for k, wider in zip(keys, [*keys[1:], None])]
            follow = _gathered(table, 1, 2 * (order - 2)) if order > 2 else []
            contexts, after = follow[: order - 2], follow[order - 2 :]
            arrays: list[np.ndarray] = []
            for n, (known, _, counts) in enumerate(levels):  # of order n + 2
                arrays += [_steps(known), counts]
                tell(n + 2, [0], *([np.count_nonzero(counts == c)] for c in (1, 2, 3, 4)))
                if n < order - 2:
                    _, first, times = _counted(after[n], after[n + 1] if n + 1 < len(after) else None)
                    own, sums = _tallied(contexts[n][first], times)
                    where = np.searchsorted(known, own)
                    for a in sums:
                        arrays.append(np.zeros(len(known), np.int64))
                        arrays[-1][where] = a
            _write(folder, key[0].as_py(), pack(*arrays))
            _, first, counts = levels[0]
            own, sums = _tallied(before[first], counts)
            words, _, times = _distinct(last[first])
            both = np.sort(np.concatenate([own, words]))
            every = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
            columns = [np.zeros(len(every), np.int64) for _ in range(5)]
            columns[0][np.searchsorted(every, words)] = times
            for column, values in zip(columns[1:], sums):
                column[np.searchsorted(every, own)] = values
            tell(0, every, *columns)
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], schema=TALLY)

    return run


# -- asking -----------------------------------------------------------------------------------------


def with_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(digests(batch.column(0)).view(np.int64)), batch.column(1)], schema=WORD)


def lay(folder: str):
    """Writes the words of a part to its file: digests, logarithms by code points and counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        given = table["key"].to_numpy().view(np.uint64)
        known, which = np.unique(given, return_inverse=True)
        arrays = [_steps(known), np.zeros(len(known))]
        logs = table["log"].to_numpy()
        has = ~np.isnan(logs)
        arrays[1][which[has]] = logs[has]
        for name in ("n", "total", "one", "two", "more"):
            arrays.append(np.zeros(len(known), np.int64))
            np.maximum.at(arrays[-1], which, table[name].to_numpy())
        _write(folder, key[0].as_py(), pack(*arrays))
        return pa.table({"part": [key[0].as_py()]})

    return run


def ask(order: int, grams: int, words: int, marked: bool):
    """What blocks of texts ask of the parts of n-grams, and of those of words, numbered after them; and each block itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches, marked)):
            place = block.place
            codes, different = pd.factorize(block.words)
            rank = np.argsort(different)
            which = np.empty(len(rank), np.int64)
            which[rank] = np.arange(len(rank))
            different, which = different[rank], which[codes]
            own = pack(*(a.view(np.uint64) for a in (block.d1, block.d2, block.symbols, block.lengths)), _steps(different), which)
            name = xxhash.xxh64_intdigest(own, seed=task << 24 | number) >> 2
            rows = [(-1 - name, name, own)]
            for to, at in _dealt(part_of(different, words), words):
                rows.append((grams + to, name, different[at].tobytes()))
            if order > 1:
                at = np.flatnonzero(place >= 1)
                keys = _longer(longer(block.words[at], block.words[at - 1]), block.words, place, at, order)
                for to, spots in _dealt(part_of(keys[0], grams), grams):
                    rows.append((to, name, b"".join(k[spots].tobytes() for k in keys)))
            yield _messages(rows)

    return run


def _found(known: np.ndarray, asked: np.ndarray, arrays: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Values of the asked keys; 0 for unknown ones."""
    if not len(known):
        return [np.zeros(len(asked), a.dtype) for a in arrays]
    # Keys are even in their range, so their first bits tell where to look.
    shift = np.uint64(max(0, int(known[-1] - known[0]).bit_length() - len(known).bit_length() - 1))
    slots = (known - known[0]) >> shift
    starts = np.concatenate([[0], np.cumsum(np.bincount(slots.view(np.int64)))])
    inside = np.flatnonzero((asked >= known[0]) & (asked <= known[-1]))
    key = asked[inside]
    slot = ((key - known[0]) >> shift).view(np.int64)
    at, ends = starts[slot], starts[slot + 1]
    where = np.full(len(asked), -1, np.int64)
    while len(at):
        left = at < ends
        at, ends, key, inside = at[left], ends[left], key[left], inside[left]
        right = known[at] == key
        where[inside[right]] = at[right]
        left = ~right
        at, ends, key, inside = at[left] + 1, ends[left], key[left], inside[left]
    has = where >= 0
    at = where[has]
    out = [np.zeros(len(asked), a.dtype) for a in arrays]
    for to, a in zip(out, arrays):
        to[has] = a[at]
    return out


def answer(order: int, grams: int, gram_folder: str, word_folder: str):
    """Answers of one part to all blocks, in the order they asked."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        to = key[0].as_py()
        if to < 0:
            return table.select(ANSWER.names)
        width = 1 if to >= grams else order - 1
        asked = [np.frombuffer(b.as_py(), np.uint64).reshape(width, -1) for b in table["body"]]
        every = np.concatenate(asked, axis=1)
        if to >= grams:
            arrays = _read(word_folder, to - grams)
            answers = _found(_sums(arrays[0]), every[0], arrays[1:])
        else:
            arrays, answers = _read(gram_folder, to) or [np.zeros(0, np.uint8)] * (2 + 6 * (order - 2)), []
            for n in range(order - 1):
                own = arrays[6 * n : 6 * n + 6]
                answers += _found(_sums(own[0]), every[n], own[1:])
        ends = np.cumsum([a.shape[1] for a in asked])
        bodies = [pack(*parts) for parts in zip(*(np.split(a, ends[:-1]) for a in answers))]
        return pa.Table.from_arrays([table["block"].combine_chunks(), pa.array([to] * len(bodies), pa.int64()), pa.array(bodies, pa.binary())], schema=ANSWER)

    return run


@dataclass(frozen=True)
class Weights:
    """``discounts`` of counts 1, 2 and more by order; of all words together the sum of their counts, and the
    weight of their spelling."""

    discounts: list[list[float]]
    total: int
    back: float

    def backs(self, order: int, context: Sequence[np.ndarray]) -> np.ndarray:
        """What the lower orders get after contexts; all of it after unknown ones."""
        total, *kinds = (a.astype(np.float64) for a in context)
        kept = sum(d * n for d, n in zip(self.discounts[order - 1], kinds))
        return np.where(total > 0, kept / np.maximum(total, 1), 1.0)

    def logs(self, order: int, counts: np.ndarray, totals: np.ndarray, backs: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Logarithms of one order's probabilities from those of the order below."""
        out, seen = below + np.log(backs), counts > 0
        n = counts[seen].astype(np.int64)
        own = (n - np.array(self.discounts[order - 1])[np.minimum(n, 3) - 1]) / totals[seen]
        out[seen] = np.log(own + backs[seen] * np.exp(below[seen]))
        return out


def combine(order: int, grams: int, weights: Weights) -> Callable[[tuple, pa.Table], pa.Table]:
    """From all answers to a block :data:`SCORE` of its texts: the logarithm of all words but the mark at the
    begin, that of the last word, and the weight that the whole text has as a context (null if unknown)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        to = np.array(table["to"].to_pylist(), np.int64)
        bodies = [table["body"][int(i)].as_py() for i in np.argsort(to)]
        to = np.sort(to)
        if np.count_nonzero(to < 0) != 1:
            raise RuntimeError("a block of texts was not read alike twice")
        *heads, steps, which = unpack(bodies[0])
        d1, d2, symbols, lengths = (a.astype(np.uint64).view(np.int64) for a in heads)
        words = _sums(steps)
        block = _Block(d1, d2, symbols, lengths, words[which])
        place = block.place

        def gathered(own: np.ndarray, size: int) -> list[np.ndarray]:
            arrays = [np.concatenate(a) for a in zip(*(unpack(bodies[i]) for i in np.flatnonzero(own)))]
            if arrays and len(arrays[0]) != size:
                raise RuntimeError("a block of texts was not read alike twice")
            return arrays

        log, counts, *context = gathered(to >= grams, len(words))
        total, back = np.full(len(words), weights.total), np.full(len(words), weights.back)
        logs = weights.logs(1, counts, total, back, log)[which]
        contexts = [[a[which] for a in context]]
        at = np.flatnonzero(place >= 1)
        if order > 1 and len(at):
            pair = longer(block.words[at], block.words[at - 1])
            spots = at[np.argsort(part_of(pair, grams).astype(np.min_scalar_type(grams)), kind="stable")]
            arrays = []
            for a in gathered((to >= 0) & (to < grams), len(at)):
                arrays.append(np.zeros(len(place), a.dtype))
                arrays[-1][spots] = a
            for k in range(2, order + 1):
                counts, *context = arrays[5 * (k - 2) : 5 * (k - 2) + 5]
                before = at - 1
                backs = weights.backs(k, [a[before] for a in contexts[-1]])
                logs[at] = weights.logs(k, counts[at], contexts[-1][0][before].astype(np.float64), backs, logs[at])
                contexts.append(context)
                at = at[place[at] >= k]
        ends = np.cumsum(block.lengths)
        whole = np.full(len(ends), np.nan)
        for k, context in enumerate(contexts[: order - 1], 1):
            own = np.flatnonzero(block.lengths == k)
            of = [a[ends[own] - 1] for a in context]
            whole[own] = np.where(of[0] > 0, weights.backs(k + 1, of), np.nan)
        last = logs[ends - 1]
        logs[place == 0] = 0.0
        sums = np.add.reduceat(logs, ends - block.lengths)
        return pa.Table.from_arrays([*map(pa.array, (d1, d2, sums, symbols, last)), pa.array(whole, from_pandas=True)], schema=SCORE)

    return run
