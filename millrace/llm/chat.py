"""Chat formatting on token level: segments are encoded apart, reserved ids spliced in, masks summed up."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings in the order of their reserved ids (fixed values of the template).
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")
#: Opening and closing control of the roles that have their own; others are named in the text.
ROLES = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<|role|>", "<|text|>", "<|end|>")

_AHEAD = r"(?=\\*(?:%s))"
_ANGLE = _AHEAD % r"/?s>|</?SYS>>|\|(?:role|text|end)\|>"
_SQUARE = _AHEAD % r"/?INST\]"
_OPENING = re.compile(rf"<{_ANGLE}|\[{_SQUARE}")
_ESCAPED = re.compile(rf"<\\{_ANGLE}|\[\\{_SQUARE}")

#: Ids of a piece of a conversation; a piece ends with the turn that reaches it.
PIECE = 1 << 16


def escape(text: str) -> str:
    """No control string is left: a backslash follows the first character of each, and of each
    that has been escaped before, so that :func:`unescape` gives back any text."""
    return _OPENING.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0], text)


@dataclass(frozen=True)
class Vocabulary:
    """A rank file of a byte-level BPE; control strings get the ids from ``reserved`` on."""

    path: str
    pattern: str
    reserved: int

    def id_of(self, control: str) -> int:
        return self.reserved + CONTROLS.index(control)

    def encoding(self):
        return _encoding(self.path, self.pattern)


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_turn(role: str, text: str, vocabulary: Vocabulary) -> tuple[list[int], int, int]:
    """The ids of a turn, and where its loss starts and ends among them; only an assistant's text has any."""
    encode, at = vocabulary.encoding().encode_ordinary, vocabulary.id_of
    content = encode(escape(text))
    if role in ROLES:
        opening, closing = ROLES[role]
        head, tail = [at(opening)], [at(closing)]
    else:
        head, tail = [at(OTHER[0]), *encode(escape(role)), at(OTHER[1])], [at(OTHER[2])]
    ids = head + content + tail
    return (ids, len(head), len(head) + len(content)) if role == "assistant" else (ids, 0, 0)


def _encode(vocabulary: Vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = batch.slice(start, 512)
                turns = [encode_turn(r, t, vocabulary) for r, t in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())]
                ids, opens, closes = zip(*turns)
                columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(opens, pa.int32()), pa.array(closes, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), *columns], names=["conv", "turn", "role", "ids", "opens", "closes"]
                )

    return run


_PIECE = pa.schema([("conv", pa.int64()), ("piece", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.int8()))])
_PIECE_DDL = "conv long, piece long, ids array<int>, loss array<tinyint>"


def assemble(turns: list[tuple[np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of consecutive turns, and their loss mask: a prefix sum of +1 where a loss span opens and -1 where it closes."""
    ids = np.concatenate([t[0] for t in turns])
    steps = np.zeros(len(ids) + 1, np.int64)
    at = 0
    for own, opens, closes in turns:
        steps[at + opens] += 1
        steps[at + closes] -= 1
        at += len(own)
    return ids, np.cumsum(steps[:-1]).astype(np.int8)


def _assemble(limit: int):
    """Rows come by conversation and turn; only the open piece is held."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []
        conv, piece, size, begun = None, 0, 0, False

        def close() -> pa.RecordBatch:
            ids, loss = assemble(held)
            held.clear()
            columns = [[conv], [piece], [ids], [loss]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE.types)], schema=_PIECE)

        for batch in batches:
            values, ends = batch.column(3), batch.column(3).offsets.to_numpy()
            flat = values.values.to_numpy(zero_copy_only=False)
            convs, opens, closes = (batch.column(i).to_pylist() for i in (0, 4, 5))
            for i in range(batch.num_rows):
                if begun and (convs[i] != conv or size >= limit):
                    yield close()
                    piece, size = (piece + 1 if convs[i] == conv else 0), 0
                conv, begun = convs[i], True
                held.append((flat[ends[i] : ends[i + 1]], opens[i], closes[i]))
                size += len(held[-1][0])
        if held:
            yield close()

    return run


def format_chat(
    turns: DataFrame, vocabulary: Vocabulary, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", limit: int = PIECE
) -> DataFrame:
    """``conv``, ``piece``, ``ids``, ``loss``: every conversation's tokens and loss mask, in pieces.

    Turns are encoded where they are read, each segment alone; control ids come from the template
    only, since texts are encoded as ordinary text with their control strings escaped. Then turns
    meet by conversation, in order of turn (equal ones by role, then ids), and are joined as a
    stream: a task holds one piece, of whole turns, however long a conversation is.

    Null texts and roles are empty; null turns come first; rows with a null conversation make up
    one; repeated rows are repeated turns. Other columns are left out. Empty tables give no rows.
    """
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("body"),
    )
    encoded = rows.mapInArrow(_encode(vocabulary), "conv long, turn long, role string, ids array<int>, opens int, closes int")
    ordered = encoded.repartition("conv").sortWithinPartitions("conv", "turn", "role", "ids")
    return ordered.mapInArrow(_assemble(limit), _PIECE_DDL)


class Reader:
    """Reads a conversation back from its pieces and digests what it finds."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.decode = vocabulary, vocabulary.encoding().decode_bytes
        self.names = {vocabulary.id_of(c): c for c in CONTROLS}
        self.roles = {opening: role for role, (opening, _) in ROLES.items()}
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def _text(self, ids: np.ndarray) -> str:
        return self.decode(ids.tolist()).decode("utf-8")

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        """A piece: whole turns."""
        marks = np.nonzero(ids >= self.vocabulary.reserved)[0]
        role = ""
        for begin, end in zip(marks, np.append(marks[1:], len(ids))):
            control = self.names[int(ids[begin])]
            body = self._text(ids[begin + 1 : end])
            self.chars += len(control) + len(body)
            if control == OTHER[0]:
                role = unescape(body)
            elif control in self.roles or control == OTHER[1]:
                role = self.roles.get(control, role)
                self.turns += 1
                self.all.update(f"{role}\n{unescape(body)}\n".encode())
        edges = np.diff(np.concatenate([[0], loss, [0]]))
        for begin, end in zip(np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]):
            text = unescape(self._text(ids[begin:end]))
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self, conv: int | None) -> tuple:
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST = pa.schema([
    ("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
])


def _read(vocabulary: Vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, conv, rows = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST.types)], schema=_DIGEST)

        for batch in batches:
            convs, places = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                if reader is None or places[i] == 0:
                    if reader:
                        rows.append(reader.row(conv))
                    reader, conv = Reader(vocabulary), convs[i]
                reader.add(batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy())
            if len(rows) > 1000:
                yield out()
                rows = []
        if reader:
            rows.append(reader.row(conv))
        if rows:
            yield out()

    return run


def read_chat(pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Of each formatted conversation the turns, the text under the mask, and the length of the
    formatted text, all read from ids and mask."""
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "piece")
    ddl = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(_read(vocabulary), ddl)
