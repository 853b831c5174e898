"""Near-duplicate documents by b-bit MinHash: bands find candidates, low bits sort them out, sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ID_ROWS, release_memory, save, small
from millrace.llm.components import components
from millrace.llm.forest import spanning

#: Words whose hashes a task remembers.
_MEMO = 1 << 17
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Signature:
    """Documents are similar from ``percent`` per cent of their joint 5-word shingles on.

    ``bands`` of ``rows`` minima each: two documents at the threshold of 75 % share no band once
    in 190,000 times with the defaults. Of every minimum ``bits`` low bits stay; unrelated minima
    agree in them by chance, which the estimate corrects. A candidate goes on to the exact test
    unless its estimate lies ``deviations`` standard errors below the threshold. Groups are compared
    in blocks of ``block`` signatures, a quarter of that for whole sets.
    """

    percent: int = 75
    shingle: int = 5
    bands: int = 32
    rows: int = 4
    bits: int = 2
    deviations: float = 5.0
    seed: int = 7
    block: int = 1024

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def seeds(self) -> np.ndarray:
        dice = np.random.default_rng(self.seed)
        return dice.integers(1, 1 << 32, (2, self.size, 1), dtype=np.uint32) | np.uint32(1)

    def most_differing(self) -> int:
        """Minima whose low bits may differ in a pair that is still tested exactly."""
        chance = 2.0**-self.bits
        same = self.percent / 100 + (1 - self.percent / 100) * chance
        error = (same * (1 - same) / self.size) ** 0.5
        return int(np.floor(self.size * (1 - same + self.deviations * error)))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _forget_words() -> None:
    """At the end of a task, whose process lives on for other work."""
    _hashes.clear()
    release_memory()


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space (space and the five controls from tab to return)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different word shingles; a short text is one shingle."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(codes))
    mixed = np.full(len(codes) - width + 1, np.uint64(width))
    for i in range(width):
        mixed = _mixed(mixed * _PRIME + codes[i : len(codes) - width + 1 + i])
    return np.unique(mixed)


def _minima(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set of shingle hashes, in 32 bits."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(seeds.shape[1], np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(short), 2048):  # bounded work memory, however long the text
        part = short[None, start : start + 2048] * seeds[0]
        part ^= part >> np.uint32(15)
        part *= seeds[1]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def sign(text: str | None, spec: Signature, seeds: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """Set size, a key for each band, and the packed low bits of the minima; empty without words."""
    values = shingles(text, spec.shingle)
    if not len(values):
        return 0, np.empty(0, np.int64), b""
    minima = _minima(values, seeds)
    powers = _PRIME ** np.arange(1, spec.rows + 1, dtype=np.uint64)[None, :]
    rows = (minima.astype(np.uint64).reshape(spec.bands, spec.rows) * powers).sum(axis=1)
    keys = _mixed(rows + np.arange(spec.bands, dtype=np.uint64) * _PRIME)
    low = minima[:, None] >> np.arange(spec.bits, dtype=np.uint32)[None, :] & np.uint32(1)
    return len(values), keys.view(np.int64), np.packbits(low.astype(np.uint8).ravel()).tobytes()


_SIGNED = "id long, key long, words binary, n_shingles long, bands array<long>, low binary"
_SCHEMA = pa.schema([
    ("id", pa.int64()), ("key", pa.int64()), ("words", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64())), ("low", pa.binary()),
])


def _sign(spec: Signature):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, known = spec.seeds(), {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                digests, signed = [], []
                for text in rows.column(2):
                    text = text.as_py()
                    digest = xxhash.xxh3_128_digest(b" ".join(words_of(text or "")))
                    if digest not in known:
                        if len(known) >= 4096:
                            known.clear()
                        known[digest] = sign(text, spec, seeds)
                    digests.append(digest)
                    signed.append(known[digest])
                counts, bands, low = zip(*signed)
                columns = [pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *columns], schema=_SCHEMA)
        known.clear()
        _forget_words()

    return run


def differing(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Of how many minima the low bits differ; rows of packed signatures against each other."""
    x = a ^ b
    for shift in range(1, bits):
        x = x | ((a ^ b) << np.uint8(shift))
    mask = np.uint8(sum(1 << (7 - i) for i in range(0, 8, bits)))
    return np.bitwise_count(x & mask).sum(axis=-1, dtype=np.int64)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _estimate(spec: Signature):
    """Keeps the candidate pairs whose low bits leave them a chance."""
    most, width = spec.most_differing(), spec.size * spec.bits // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _rows(batch.column(2), width), _rows(batch.column(3), width)
            yield batch.select([0, 1]).filter(pa.array(differing(a, b, spec.bits) <= most))

    return run


def _pairs_of_blocks(table: pa.Table, key: str) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray]:
    sides = [table.filter(pc.equal(table["side"], side)) for side in (0, 1)]
    return *sides, *(side[key].to_numpy() for side in sides)


def _forest(edges: list[np.ndarray]) -> pa.Table:
    ends = spanning(np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64))
    return pa.table({"a": pa.array(ends[1], pa.int64()), "b": pa.array(ends[0], pa.int64())})


def _alike(spec: Signature, step: int = 128):
    """Of a pair of a bucket's blocks: a forest over the families in it that hold two members whose
    low bits leave them a chance."""
    most, width = spec.most_differing(), spec.size * spec.bits // 8

    def run(table: pa.Table) -> pa.Table:
        left, right, of_a, of_b = _pairs_of_blocks(table, "family")
        a, b = _rows(left["low"], width), _rows(right["low"], width)
        edges = []
        for start in range(0, len(a), step):
            part = slice(start, start + step)
            far = differing(a[part, None, :], b[None, :, :], spec.bits)
            x, y = np.nonzero((far <= most) & (of_a[part, None] != of_b[None, :]))
            edges.append(spanning(np.stack([of_a[part][x], of_b[y]])))
        return _forest(edges)

    return run


def shared_shingles(a: list[np.ndarray], b: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many shingles each set of one block has in common with each of the other.

    Shingles that both blocks have are columns of two 0/1 matrices; their product, taken some
    columns at a time, holds the counts.
    """
    columns = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    counts = np.zeros((len(a), len(b)), np.float32)
    entries = []
    for sets in (a, b):
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        place = np.searchsorted(columns, flat)
        known = place < len(columns)
        known[known] = columns[place[known]] == flat[known]
        place, owner = place[known], owner[known]
        order = np.argsort(place)
        entries.append((place[order], owner[order], len(sets)))
    for start in range(0, len(columns), width):
        part = []
        for place, owner, rows in entries:
            low, high = np.searchsorted(place, [start, start + width])
            ones = np.zeros((rows, width), np.float32)
            ones[owner[low:high], place[low:high] - start] = 1
            part.append(ones)
        counts += part[0] @ part[1].T
    return counts.astype(np.int64)


def _linked(spec: Signature):
    """Of a pair of a family's blocks: a forest over the components that a link by whole sets joins."""

    def run(table: pa.Table) -> pa.Table:
        left, right, of_a, of_b = _pairs_of_blocks(table, "component")
        if not left.num_rows or not right.num_rows:
            return _forest([])
        a, b = ([np.frombuffer(s, np.uint64) for s in side["shingles"].to_pylist()] for side in (left, right))
        shared = shared_shingles(a, b)
        sizes = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :]
        x, y = np.nonzero((shared > 0) & (100 * shared >= spec.percent * (sizes - shared)) & (of_a[:, None] != of_b[None, :]))
        return _forest([np.stack([of_a[x], of_b[y]])])

    return run


def _sets(spec: Signature):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                values = [shingles(t.as_py(), spec.shingle).tobytes() for t in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(values, pa.binary())], names=["node", "shingles"])
        _forget_words()

    return run


def _confirm(spec: Signature):
    """Keeps the pairs of texts that are similar by their whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.empty(0, np.uint64)
        for batch in batches:
            verdicts = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, kept = a, shingles(text_a.as_py(), spec.shingle)
                other = shingles(text_b.as_py(), spec.shingle)
                shared = len(np.intersect1d(kept, other, assume_unique=True))
                verdicts.append(bool(shared) and 100 * shared >= spec.percent * (len(kept) + len(other) - shared))
            yield batch.select([0, 1]).filter(pa.array(verdicts, pa.bool_()))
        _forget_words()

    return run


_PAIR = "a long, b long"


def _confirmed(pairs: DataFrame, texts: DataFrame, spec: Signature) -> DataFrame:
    """The pairs of representatives whose texts pass the exact test, as a written table.

    Only the texts of documents in a pair are shuffled; all others are dropped where they are read.
    """
    ends = small(save(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ends"), ID_ROWS)
    own = texts.join(ends, "id", "left_semi")
    both = pairs.join(own.select(F.col("id").alias("b"), F.col("body").alias("text_b")), "b")
    both = both.join(own.select(F.col("id").alias("a"), F.col("body").alias("text_a")), "a").select("a", "b", "text_a", "text_b")
    return save(both.mapInArrow(_confirm(spec), _PAIR), "links")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", spec: Signature = Signature()) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_shingles``, ``component_id``, ``kept``.

    A component holds the documents that links of similarity join, directly or through others; it
    is named by its smallest key, and that document is kept. The steps:

    1. Every text is signed; from then on rows hold no text. Copies are signed once a task.
    2. Documents of the same words are one class, found by a partially aggregated group-by; the
       one with the smallest key represents it.
    3. Every bucket's members are candidates with the bucket's smallest and largest member; who is
       in a bucket with nobody is dropped there. Corrected bit counts sort candidates out. Buckets
       that candidates do not connect are compared by bit counts as a whole, in blocks. That gives
       families: within a bucket, all that bit counts leave a chance is in one family.
    4. Whole shingle sets decide on the candidates, and components join what is linked. A family
       that is one component is done; in the others all members outside the largest component
       are compared with all members by their sets, in blocks. So no link that a bucket shows is
       lost, and nothing returns more rows than a few for each member.

    Nulls and texts without words have no shingles and no links. Rows that share a key and their
    words are copies like any others. A key names one document: of rows that share a key but not
    their words, one text's signature stands for the links of the key. A null key takes part as
    the smallest number of its type. Other columns are left out. Empty tables give no rows.
    """
    identity = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(identity.alias("id"), F.col(key).cast("long").alias("key"), F.col(text).alias("body"))
    texts = rows.select("id", "body")
    every = save(rows.mapInArrow(_sign(spec), _SIGNED), "signatures")
    reps = save(every.groupBy("words").agg(F.min("id").alias("id")), "reps")
    signed = every.join(reps, ["id", "words"], "left_semi").select(F.col("id").alias("rep"), "n_shingles", "bands", "low")
    signed = save(signed.dropDuplicates(["rep"]), "signed")

    members = signed.where("n_shingles > 0").select("rep", F.posexplode("bands").alias("band", "bucket"))
    ends = members.groupBy("band", "bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    ends = save(ends, "buckets")
    met = save(members.join(ends, ["band", "bucket"]), "members")
    stars = met.select(F.col("least").alias("a"), F.col("rep").alias("b")).union(met.select("rep", "most")).where("a < b").distinct()
    lows = signed.select("rep", "low")
    a, b = (lows.select(F.col("rep").alias(n), F.col("low").alias(f"low_{n}")) for n in "ab")
    both = stars.join(a, "a").join(b, "b").select("a", "b", "low_a", "low_b")
    tried = save(both.mapInArrow(_estimate(spec), _PAIR), "candidates")
    families = _families(met, tried, lows, spec)
    links = _confirmed(tried, texts, spec)
    links = save(links.union(_across(families, save(components(links), "joined"), texts, spec)), "all-links")

    named = components(links).withColumnsRenamed({"node": "id", "component": "named"})
    of_class = save(reps.join(named, "id", "left").select("words", F.coalesce("named", "id").alias("named")), "named")
    component = F.when(F.col("n_shingles") > 0, F.col("named")).otherwise(F.col("id"))
    whole = every.select("id", "key", "words", "n_shingles").join(of_class, "words")
    return whole.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept"))


def _families(met: DataFrame, tried: DataFrame, lows: DataFrame, spec: Signature) -> DataFrame:
    """``(node, component)``: families of members that low bits connect, within their buckets.

    Buckets that candidates with their ends connect are done. In the others all members of
    different families are compared by bit counts, in pairs of blocks that return forests.
    """
    first = save(components(tried), "families").withColumnsRenamed({"node": "rep", "component": "family"})
    held = met.select("band", "bucket", "rep").join(first, "rep", "left")
    held = save(held.select("band", "bucket", "rep", F.coalesce("family", "rep").alias("family")), "open")
    bucket = ["band", "bucket"]
    several = held.groupBy(*bucket).agg(F.min("family").alias("x"), F.max("family").alias("y"), F.count("*").alias("n")).where("x < y")
    open_ = held.join(several.select(*bucket, "n"), bucket).join(lows, "rep").select(*bucket, "n", F.col("rep").alias("node"), "family", "low")
    sides = _block_pairs(open_, bucket, "n", "n", F.lit(True), spec.block)
    more = save(sides.groupBy(*bucket, "i", "j").applyInArrow(_alike(spec), _PAIR).distinct(), "alike")
    return save(components(tried.union(more)), "families")


def _across(families: DataFrame, joined: DataFrame, texts: DataFrame, spec: Signature) -> DataFrame:
    """Links between components of one family, by whole sets.

    A family that is one component is done. In the others every member outside the largest
    component is compared with all members, in pairs of blocks that return forests.
    """
    component = F.coalesce("joined", "node").alias("component")
    held = families.withColumnRenamed("component", "family").join(joined.withColumnRenamed("component", "joined"), "node", "left")
    held = save(held.select("node", "family", component), "family-members")
    sizes = held.groupBy("family", "component").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "component")).alias("largest")
    several = sizes.groupBy("family").agg(largest, F.sum("n").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    open_ = save(held.join(several.select("family", "all", "largest"), "family"), "open-families")
    ids = small(open_.select(F.col("node").alias("id")), ID_ROWS)
    own = texts.join(ids, "id", "left_semi").dropDuplicates(["id"])
    sets = save(own.mapInArrow(_sets(spec), "node long, shingles binary"), "sets")
    rows = open_.withColumn("rest", F.col("all") - F.col("largest.n")).join(sets, "node")
    sides = _block_pairs(rows, ["family"], "all", "rest", F.col("component") != F.col("largest.component"), spec.block // 4)
    sides = sides.select("family", "i", "j", "side", "component", "shingles")
    return sides.groupBy("family", "i", "j").applyInArrow(_linked(spec), _PAIR)


def _block_pairs(rows: DataFrame, group: list[str], n: str, m: str, second: Column, block: int) -> DataFrame:
    """Rows of a group (``n`` of them, and ``m`` for which ``second`` holds) dealt into blocks of about
    ``block``, and repeated for every block they meet: each (i, j) of a group holds block i of all
    rows as side 0 and block j of the second ones as side 1, however large the group is."""
    blocks = [F.ceil(F.col(c) / block).cast("int") for c in (n, m)]
    own = [F.pmod(F.xxhash64("node"), b).cast("int") for b in blocks]
    every = [F.explode(F.sequence(F.lit(0), b - 1)) for b in blocks]
    names = [c for c in rows.columns if c not in group]
    first = rows.select(*group, own[0].alias("i"), every[1].alias("j"), F.lit(0).alias("side"), *names)
    return first.union(rows.where(second).select(*group, every[0].alias("i"), own[1].alias("j"), F.lit(1).alias("side"), *names))
