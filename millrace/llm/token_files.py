"""Token ids as binary files: independent zstandard frames, an index of documents, and a seek table.

A file is a row of zstandard frames whose contents, joined, are the ids of all its documents as
little-endian unsigned 32-bit integers; then a skippable frame with the documents' keys and
lengths; then the seek table of the public seekable format: sizes and checksum of every frame,
read from the end of the file. A reader fetches the table and the index, and after that only the
frames that hold the documents it wants.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import release_memory, save
from millrace.session import work_dir

#: Bytes of ids after which a frame ends with its document, and after which it is cut within one.
FRAME_BYTES = 1 << 16
LARGEST_FRAME = 1 << 22
#: Words encoded whole, and pieces of words, whose ids a process remembers, and marks for words met once.
MEMO_WORDS = 200_000
MEMO_PIECES = 300_000
MEMO_MARKS = 1 << 23
#: Bytes of texts that are encoded at a time.
TEXT_BYTES = 1 << 22
#: By what these are divided where an executor's memory holds other stages' leavings too.
LEAN = 4

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
HEADER = struct.Struct("<II")
#: Another skippable frame, for the index of documents.
INDEX = 0x184D2A5D


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """Writes one file; memory holds a frame and 16 bytes a document."""

    def __init__(self, out):
        self.out, self.pending, self.frames = out, bytearray(), []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        for start in range(0, len(ids), LARGEST_FRAME):
            self.pending += ids[start : start + LARGEST_FRAME]
            if len(self.pending) >= LARGEST_FRAME:
                self._close_frame()
        if len(self.pending) >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        raw = bytes(self.pending)
        self.pending.clear()
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), checksum(raw)))

    def finish(self) -> int:
        """Write what is pending, the index and the seek table; the number of ids in the file."""
        if self.pending:
            self._close_frame()
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        raw = struct.pack("<Q", len(keys)) + known.tobytes() + keys.tobytes() + np.array(self.lengths, "<i8").tobytes()
        packed = self.compressor.compress(raw)
        self.out.write(HEADER.pack(INDEX, len(packed)) + packed)
        self.frames.append((len(packed) + HEADER.size, 0, checksum(b"")))
        table = b"".join(ENTRY.pack(*f) for f in self.frames) + FOOTER.pack(len(self.frames), CHECKSUMS, SEEK_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE, len(table)) + table)
        return sum(self.lengths)


class FileReader:
    """Reads one file from its end; frames are fetched, decompressed and verified when wanted."""

    def __init__(self, file, size: int):
        self.file = file
        count, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table")
        table = size - FOOTER.size - count * ENTRY.size
        entries = list(ENTRY.iter_unpack(self._at(table, count * ENTRY.size)))
        self.sizes, self.raw_sizes, self.sums = (np.array(c, np.int64) for c in zip(*entries))
        self.places = np.cumsum(self.sizes) - self.sizes
        self.raw_places = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.decompressor = zstandard.ZstdDecompressor()
        packed = self._at(int(self.places[-1]), int(self.sizes[-1]))
        if HEADER.unpack_from(packed)[0] != INDEX:
            raise ValueError("no index of documents")
        raw = self.decompressor.decompress(packed[HEADER.size :])
        (docs,) = struct.unpack_from("<Q", raw)
        known = np.frombuffer(raw, np.uint8, docs, 8)
        keys = np.frombuffer(raw, "<i8", docs, 8 + docs)
        self.keys = [int(k) if there else None for k, there in zip(keys, known)]
        self.lengths = np.frombuffer(raw, "<i8", docs, 8 + 9 * docs)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.last: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def frame(self, number: int) -> bytes:
        if self.last[0] != number:
            packed = self._at(int(self.places[number]), int(self.sizes[number]))
            raw = self.decompressor.decompress(packed)
            if len(raw) != self.raw_sizes[number] or checksum(raw) != self.sums[number]:
                raise ValueError(f"frame {number} is damaged")
            self.last = (number, raw)
        return self.last[1]

    def ids(self, number: int) -> bytes:
        """The ids of the document at a place in the file, from the frames that hold them."""
        start, length = int(self.starts[number]) * 4, int(self.lengths[number]) * 4
        out, frame = [], int(np.searchsorted(self.raw_places, start, side="right")) - 1
        while length > 0:
            raw, inside = self.frame(frame), start - int(self.raw_places[frame])
            part = raw[inside : inside + length]
            out.append(part)
            start, length, frame = start + len(part), length - len(part), frame + 1
        return b"".join(out)


#: Latin letters, composed, whose lower case is one letter whatever the Unicode version.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: Words of these and of printable ASCII but for the apostrophe, of which contractions are made.
_PLAIN = f"[!-&(-~{_LATIN}]*"
#: What the tokenizer's pattern cuts such a word into.
_PIECES = re.compile(f"[{_LATIN}]+|[0-9]|\n|[^{_LATIN}0-9\n]+")
#: Stands between the ids of two words; no vocabulary has as many.
_BETWEEN = 0xFFFFFFFF
#: A byte-level vocabulary's letter for each byte: printable Latin-1 stands for itself, the others,
#: in order, for the letters from 256 on.
_ITSELF = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = dict(zip((b for b in range(256) if b not in _ITSELF), range(256, 512)))


class _Words(dict):
    """The ids of words that the whole tokenizer encodes, as bytes, and those of pieces of other words. A
    word that is met twice is remembered, by all tasks of a process, so that the many words of one place
    do not push the others out; a mark for its hash tells that it was met. Pieces are remembered as long
    as there is room. ``share``: what the room is divided by."""

    def __init__(self, tokenizer, share: int = 1):
        super().__init__()
        self.tokenizer, self.pieces, self.most = tokenizer, _Pieces(tokenizer.model, MEMO_PIECES // share), MEMO_WORDS // share
        self.met = bytearray(MEMO_MARKS // share)

    def __missing__(self, word: bytes) -> bytes:
        ids = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        place = hash(word) % len(self.met)
        if self.met[place]:
            if len(self) >= self.most:
                self.clear()
                self.met = bytearray(len(self.met))
            self[word] = ids
        self.met[place] = 1
        return ids

    def look_up(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different words, one word after the other, where each word's begin, and how many it has."""
        cut = pc.and_(pc.match_substring_regex(words, f"^(?:{_PLAIN})$"), pc.invert(pc.match_substring(words, "<|")))
        whole = [self[w.encode()] for w in _lines(words.filter(pc.invert(cut)))]
        marked = "".join([w + "\n" for w in _lines(words.filter(cut))]).lower()
        ids = np.frombuffer(b"".join(map(self.pieces.__getitem__, _PIECES.findall(marked))), "<u4")
        marks = np.flatnonzero(ids == _BETWEEN)
        lengths = np.concatenate([np.diff(marks, prepend=-1) - 1, np.fromiter((len(w) // 4 for w in whole), np.int64, len(whole))])
        ids = np.concatenate([ids[ids != _BETWEEN], np.frombuffer(b"".join(whole), "<u4")])
        cut = cut.to_numpy(zero_copy_only=False)
        order = np.where(cut, np.cumsum(cut), np.count_nonzero(cut) + np.cumsum(~cut)) - 1
        return ids, (np.cumsum(lengths) - lengths)[order], lengths[order]


class _Pieces(dict):
    """The ids of pieces of words as bytes, and a mark for the end of a line."""

    def __init__(self, model, most: int):
        super().__init__()
        self.tokenize, self.most = model.tokenize, most

    def __missing__(self, piece: str) -> bytes:
        if piece == "\n":
            ids = struct.pack("<I", _BETWEEN)
        else:
            letters = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            tokens = self.tokenize(letters)
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(self) >= self.most:
            self.clear()
        self[piece] = ids
        return ids


def _lines(words: pa.StringArray) -> list[str]:
    """Words without line breaks; by way of one text, which is faster than one by one."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py().split("\n")


@lru_cache(maxsize=1)
def _tokenizer(path: str, plain: bool = False, share: int = 1):
    """The tokenizer, and the ids of words that this process has met."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    return tokenizer, _Words(tokenizer, share)


def _forget_words() -> None:
    """Give back what a worker process remembers of words, which stays in memory for as long as Spark keeps the process."""
    _tokenizer.cache_clear()
    release_memory()


class Encoder:
    """Ids of whole texts as bytes, for byte-level tokenizers that drop white space, never join across
    it, and cut texts, in lower case, into runs of letters, digits and other characters.

    A text is the sequence of its words between ASCII white space, and so are its ids. A word of
    Latin letters, digits and punctuation is cut into pieces, whose ids are the model's; other words,
    and those with an apostrophe or a sign of special tokens, are encoded by the whole tokenizer.
    Tests hold this against encoding whole texts. Special tokens in a text become their ids, as by
    the tokenizer's own call; with ``plain`` they are encoded as the text they are. ``share``: what
    the room for words and pieces is divided by.
    """

    def __init__(self, path: str, end_id: int, plain: bool = False, share: int = 1):
        self.words = _tokenizer(path, plain, share)[1]
        self.end = struct.pack("<I", end_id)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; all texts are held at once, and each of their different words is looked up once."""
        whole = pa.array([(t or "").encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(whole)
        words = split.flatten().dictionary_encode()
        ids, starts, lengths = self.words.look_up(words.dictionary)
        places = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[places])])
        for first, last in itertools.pairwise(split.offsets.to_pylist()):
            own = places[first:last]
            each = lengths[own]
            # the ids of word after word: from its own first id on, as many as it has
            steps = np.arange(ends[last] - ends[first]) - np.repeat(ends[first:last] - ends[first], each)
            yield ids[np.repeat(starts[own], each) + steps].tobytes() + self.end


def _slices(batch: pa.RecordBatch, share: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows whose texts (second column) take about as many bytes as are encoded at a time, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, done + TEXT_BYTES // share, side="right")))
        yield batch.slice(start, end - start)
        start, done = end, int(ends[end - 1])


_WRITTEN = pa.schema([("file", pa.string()), ("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())])


def _write(folder: str, tokenizer: str, end_id: int, plain: bool, last: bool = False):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if last:  # also what the stages before have left
            _forget_words()
        task = TaskContext.get()
        fs, base = filesystem(folder)
        name = f"part-{task.partitionId():06d}.zst"
        hidden = f"{base}/.{name}.{task.taskAttemptId()}"
        share = LEAN if last else 1
        encoder, writer, docs = Encoder(tokenizer, end_id, plain, share), None, 0
        with fs.open_output_stream(hidden) as out:
            writer = FileWriter(out)
            for batch in batches:
                for rows in _slices(batch, share):
                    for key, ids in zip(rows.column(0).to_pylist(), encoder.encode(rows.column(1).to_pylist())):
                        writer.add(key, ids)
                        docs += 1
                if last:
                    release_memory()
            tokens = writer.finish()
        if last:  # Spark hands the next task to the process that has waited longest, and each would hold its words
            del encoder, writer.compressor
            _forget_words()
        if not docs:
            fs.delete_file(hidden)
            return
        fs.move(hidden, f"{base}/{name}")  # a repeated task writes the same bytes under the same name
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((name, task.partitionId(), docs, tokens), _WRITTEN.types)], schema=_WRITTEN)

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, plain: bool = False,
    last: bool = False,
) -> DataFrame:
    """Write the ids of all documents in ascending order of key; the files as a written table.

    Documents are range-partitioned by key, so files are in order and every task writes one; a file
    appears by a rename when it is complete. Equal keys are ordered by text, null keys come first. A
    null text is empty: only the end id. ``plain``: special tokens in a text are encoded as text (see
    :class:`Encoder`). ``last``: processes that have run other stages forget their words after each file, which
    costs a new start for each and holds them for running tasks only, and remember and encode less at a time (``LEAN``). The table has ``file``, ``part``, ``docs``, ``tokens`` and
    ``base``, the number of ids in all files before (one row a file).
    """
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("body"))
    order = [F.col("key").asc_nulls_first(), F.col("body")]
    rows = rows.repartitionByRange(order[0], F.xxhash64("body")).sortWithinPartitions(*order)
    written = save(rows.mapInArrow(_write(folder, tokenizer, end_id, plain, last), "file string, part int, docs long, tokens long"), "files")
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    return save(written.withColumn("base", before), "manifest")


_READ = pa.schema([
    ("file", pa.string()), ("number", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
])


def _read(folder: str, wanted: frozenset[int] | None, last: bool = False):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if last:
            _forget_words()
        fs, base = filesystem(folder)
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{base}/{file}"
                with fs.open_input_file(path) as source:
                    reader = FileReader(source, source.size())
                    rows, held = [], 0
                    for number, key in enumerate(reader.keys):
                        if wanted is None or key in wanted:
                            ids = reader.ids(number)
                            rows.append((file, number, key, first + int(reader.starts[number]), int(reader.lengths[number]), ids))
                            held += len(ids)
                        if held >= LARGEST_FRAME:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)

    return run


def read_token_files(files: DataFrame, folder: str, keys: Iterable[int] | None = None, last: bool = False) -> DataFrame:
    """``file``, ``number`` in it, ``key``, ``start`` over all files, ``n_tokens`` and ``ids`` (little-endian
    unsigned 32-bit integers) of all documents, or of those with the given keys; a task reads a file at a time.
    ``last``: nothing is written after this, so the processes forget the words they have met."""
    count = max(1, files.count())
    rows = files.select("file", "base").repartition(count)
    wanted = None if keys is None else frozenset(keys)
    return rows.mapInArrow(_read(folder, wanted, last), "file string, number long, key long, start long, n_tokens long, ids binary")


def token_table(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, plain: bool = False, last: bool = False
) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    folder = work_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, key, text, end_id, plain, last), folder, last=last)

