"""Quality by perplexity: an interpolated modified Kneser-Ney model of the words of trusted text, which backs
off to one of their code points, cut at quantiles by language."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import files
from millrace.llm import word_counts as wc
from millrace.llm.common import ID_ROWS, discard, save, shuffles_dropped, small
from millrace.llm.token_files import filesystem
from millrace.llm.toxicity import held_out
from millrace.llm.word_counts import BEGIN, END, words_of
from millrace.session import work_dir

_MEMO = 200_000
#: Bytes of training texts whose n-grams are one part, and of words; different words that are spelled together.
PART_BYTES, WORDS_BYTES, SPELLED = 3_000_000, 8_000_000, 50_000
#: Parts are counted in so many turns, and texts scored in so many, of no fewer bytes: what is shuffled in one
#: turn is deleted before the next.
COUNT_TURNS, SCORE_TURNS, TURN_BYTES = 4, 16, 4_000_000


@dataclass(frozen=True)
class Model:
    """``words``: words of an n-gram, whatever lies between them. ``order``: symbols of an n-gram of the
    model that words back off to (code points of words, with their marks). ``quantile``: of the
    perplexities of trusted documents that the model has not seen, by language, above which a
    document is rejected. ``broadcast``: an option of :func:`score`: code-point n-grams up to which
    that model is sent to every task; :func:`judge_quality` leaves all models sharded by n-gram."""

    words: int = 3
    order: int = 4
    quantile: float = 0.99
    slack: float = 1.05
    broadcast: int = 0


def _count(order: int):
    """Counts of all n-grams up to the order, from each task's different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, grams = Counter(), Counter()
            for text in batch.column(0):
                words.update(words_of(text.as_py()))
            for word, n in words.items():
                marked = BEGIN + word + END
                own = [marked[start:end] for end in range(2, len(marked) + 1) for start in range(max(0, end - order), end)]
                if n == 1:
                    grams.update(own)
                else:
                    for gram in own:
                        grams[gram] += n
            yield pa.RecordBatch.from_pydict({"gram": pa.array(grams.keys(), pa.string()), "n": pa.array(grams.values(), pa.int64())})

    return run


def _discounted(counts: DataFrame, discounts: list[float]) -> Column:
    return F.col("n") - F.when(F.col("n") >= 3, discounts[2]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[0])


def train(texts: DataFrame, spec: Model = Model()) -> DataFrame:
    """``(gram, p, back)``: the probability of an n-gram's last symbol after the others, lower orders
    interpolated, and the weight that its lower orders get where it is a context.

    Raw counts are summed by n-gram over all texts (first in each task). Below the highest order an
    n-gram counts by the different symbols before it, or raw if it begins a word. Discounts come
    from the counts of counts of each order. Every step is a group-by or an equi-join whose keys
    are n-grams, so counts and model stay sharded. One column of text; nulls are empty texts.
    """
    counted = texts.mapInArrow(_count(spec.order), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counted, model = save(counted, "ngrams"), None
    for level, sums, unseen in _levels(counted, spec.order):
        backs = sums.select(F.col("context").alias("gram"), "back")
        if model is None:
            model = backs.select("gram", F.lit(unseen).alias("p"), "back")  # the empty context
        else:
            model = model.join(backs.withColumnRenamed("back", "wider"), "gram", "full").select(
                "gram", "p", F.coalesce("wider", "back").alias("back")
            )
        before, model = model, save(model.union(level.select("gram", "p", F.lit(None).cast("double"))), "model")
        discard(before)  # the model so far and the contexts joined to it
    return model


def _discounts(counts: dict[int, int]) -> list[float]:
    """What is taken from counts of 1, 2 and more, by how many n-grams have counts of 1 to 4."""
    one, two, three, four = (max(counts.get(i, 0), 1) for i in (1, 2, 3, 4))
    rate = one / (one + 2 * two)
    return [min(max(d, 0.1), top) for d, top in ((1 - 2 * rate * two / one, 0.9), (2 - 3 * rate * three / two, 1.9), (3 - 4 * rate * four / three, 2.9))]


def _levels(raw: DataFrame, order: int) -> Iterator[tuple[DataFrame, DataFrame, float]]:
    """For each order from 1 up ``(gram, p)``, ``(context, total, back)`` and the uniform probability below.

    ``raw``: a saved table of n-grams and their counts, which is deleted when it has been read.
    """
    size = F.char_length("gram")
    counts = {order: save(raw.where(size == order), "counts")}
    for k in range(order - 1, 0, -1):  # a table of counts holds every n-gram of its order once
        longer = counts[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
        own = longer.where(~F.startswith("gram", F.lit(BEGIN))).union(raw.where((size == k) & F.startswith("gram", F.lit(BEGIN))))
        counts[k] = save(own.where(F.col("gram") != BEGIN), "counts")
    discard(raw)
    lower, uniform = None, 1.0
    for k in range(1, order + 1):
        discounts = _discounts({r["n"]: r["m"] for r in counts[k].where("n <= 4").groupBy("n").agg(F.count("*").alias("m")).collect()})
        context = (F.lit("") if k == 1 else F.expr(f"substring(gram, 1, {k - 1})")).alias("context")
        kept = counts[k].select("gram", "n", context, _discounted(counts[k], discounts).alias("kept"))
        sums = kept.groupBy("context").agg(F.sum("n").alias("total"), F.sum("kept").alias("sum_kept"))
        sums = save(sums.select("context", "total", (1 - F.col("sum_kept") / F.col("total")).alias("back")), "contexts")
        own = kept.join(sums, "context").select("gram", "back", (F.col("kept") / F.col("total")).alias("own"))
        if lower is None:
            uniform = 1.0 / (counts[k].count() + 1)  # and one for those not seen
            own = own.withColumn("p_short", F.lit(uniform))
        else:
            below = lower.select(F.col("gram").alias("short"), F.col("p").alias("p_short"))
            own = own.withColumn("short", F.expr("substring(gram, 2)")).join(below, "short")
        lower = save(own.select("gram", (F.col("own") + F.col("back") * F.col("p_short")).alias("p")), "level")
        discard(counts.pop(k))
        yield lower, sums, uniform


def _turns(most: int, size: int) -> int:
    return max(1, min(most, size // TURN_BYTES))


@dataclass(frozen=True)
class WordModel:
    """Counts of word n-grams of all orders and of what follows them, in ``parts`` files of ``folder``
    (:mod:`millrace.llm.word_counts`), those of single words in a table, and the code-point model of words.

    Probabilities are made from the counts when they are asked for: ``levels`` and ``contexts`` read ``texts`` again.
    """

    texts: DataFrame
    folder: str
    parts: int
    unigrams: DataFrame
    weights: wc.Weights
    points: DataFrame
    spec: Model

    def spelled(self, words: DataFrame) -> DataFrame:
        """``(gram, log)`` of different words by their code points."""
        logs = _word_logs(words.withColumnRenamed("gram", "word"), self.points, self.spec, every=True)
        return logs.select(F.col("word").alias("gram"), "log")

    def laid(self, rows: DataFrame, size: int, marked: bool = True) -> tuple[str, int]:
        """A folder of files with all that is known of the different words of the texts in ``body``, and their number."""
        spark, parts = rows.sparkSession, max(1, size // WORDS_BYTES)
        folder = work_dir(spark, "word-files")
        filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
        words = save(_different(rows.select("body"), marked), "words")
        logs = self.spelled(words.withColumnRenamed("word", "gram")).mapInArrow(wc.with_digests, wc.ddl(wc.WORD))
        counts = [F.lit(0).cast("long").alias(c) for c in ("n", "total", "one", "two", "more")]
        every = logs.select("key", "log", *counts).union(self.unigrams.select("key", F.lit(float("nan")).alias("log"), "n", "total", "one", "two", "more"))
        part = F.shiftright(F.shiftrightunsigned("key", 32) * parts, 32)  # as of word_counts.part_of
        save(every.withColumn("part", part).groupBy("part").applyInArrow(wc.lay(folder), "part long"), "word-parts")
        discard(words)
        return folder, parts

    def scored(self, rows: DataFrame, words: tuple[str, int], marked: bool = True) -> DataFrame:
        """:data:`millrace.llm.word_counts.SCORE` of rows of two digests and a text ``body`` whose words are laid."""
        order = self.spec.words
        asked = rows.mapInArrow(wc.ask(order, self.parts, words[1], marked), wc.ddl(wc.MESSAGE))
        answers = asked.groupBy("to").applyInArrow(wc.answer(order, self.parts, self.folder, words[0]), wc.ddl(wc.ANSWER))
        return answers.groupBy("block").applyInArrow(wc.combine(order, self.parts, self.weights), wc.ddl(wc.SCORE))

    def _asked(self, grams: DataFrame) -> DataFrame:
        """``(gram, log, back)`` of different n-grams: of the last word after the others, and the weight as a context."""
        rows = save(grams.select("gram", *_digests("gram"), F.col("gram").alias("body")), "grams")
        words = self.laid(rows, rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0, False)
        known = save(self.scored(rows.select("d1", "d2", "body"), words, False), "sums")
        files.delete(rows.sparkSession, words[0])
        return rows.join(known, ["d1", "d2"]).select("gram", F.col("last").alias("log"), "back")

    def logs(self, grams: DataFrame, k: int) -> DataFrame:
        """``(gram, log)`` of different n-grams of at most ``k`` words, those with fewer at the begin of a text only:
        of the last word after the others, by the longest known end and the weights of longer contexts."""
        return self._asked(grams.where(F.expr(_SIZE) <= k)).select("gram", "log")

    def _windows(self, k: int, last: bool) -> DataFrame:
        return self.texts.mapInArrow(_windows_of(k, last), "gram string").distinct()

    @property
    def levels(self) -> list[DataFrame]:
        """By order ``(gram, p)`` of all n-grams of the texts."""
        return [self.logs(self._windows(k, True), k).select("gram", F.exp("log").alias("p")) for k in range(1, self.spec.words + 1)]

    @property
    def contexts(self) -> list[DataFrame]:
        """By order ``(context, back)`` of all contexts of the texts."""
        empty = self.texts.sparkSession.createDataFrame([("", self.weights.back)] if self.weights.total else [], "context string, back double")
        own = [self._asked(self._windows(k, False)) for k in range(1, self.spec.words)]
        return [empty, *(c.where("back is not null").select(F.col("gram").alias("context"), "back") for c in own)]

    def discard(self) -> None:
        files.delete(self.points.sparkSession, self.folder)
        discard(self.unigrams, self.points)


_SIZE = "char_length(gram) - char_length(replace(gram, ' ', '')) + 1"


def _digests(column: str) -> list[Column]:
    return [F.xxhash64(F.lit(n), column).alias(f"d{n}") for n in (1, 2)]


def _different(texts: DataFrame, marked: bool = True) -> DataFrame:
    return texts.mapInArrow(wc.different_words(marked), "word string").distinct()


def _windows_of(k: int, last: bool):
    """The different n-grams of ``k`` words of each batch, begin marks included; ``last``: those that end with a word,
    else those with a word after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams: set[str] = set()
            for text in batch.column(0):
                words = [BEGIN, *words_of(text.as_py())]
                ends = range(max(2, k), len(words) + 1) if last else range(k, len(words))
                grams.update(" ".join(words[end - k : end]) for end in ends)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(list(grams), pa.string())})

    return run


def train_words(texts: DataFrame, spec: Model = Model()) -> WordModel:
    """A model of word n-grams over whole texts, interpolated down to the single word and below it, for
    rare and unseen words, to the code points of the different words of the texts (:func:`train`).

    N-grams are counted in turns, each for its parts of the keys, so that only these are shuffled at a time. One
    column of text; nulls are empty texts.
    """
    spark, order = texts.sparkSession, spec.words
    texts = texts.select(F.col(texts.columns[0]).alias("body"))
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts, turns = max(1, size // PART_BYTES), _turns(COUNT_TURNS, size)
    folder = work_dir(spark, "gram-files")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    rows = texts.select(*(F.lit(0).cast("long").alias(d) for d in ("d1", "d2")), "body")
    tallies = []
    for turn in range(turns):
        sent = rows.mapInArrow(wc.send(order, parts, turn, turns), wc.ddl(wc.MESSAGE))
        tallies.append(save(sent.groupBy("to").applyInArrow(wc.count(order, folder), wc.ddl(wc.TALLY)), "counts"))
    every = reduce(DataFrame.union, tallies)
    sums = [F.sum(c).alias(c) for c in ("n", "total", "one", "two", "more")]
    unigrams = save(every.where("kind = 0").groupBy("key").agg(*sums), "word-ngrams")
    of = {r["kind"]: r for r in every.where("kind > 0").groupBy("kind").agg(*sums).collect()}
    all_words = unigrams.agg(F.sum("n").alias("total"), *(F.count_if(F.col("n") == n).alias(f"c{n}") for n in (1, 2, 3, 4)), F.count_if(F.col("n") > 2).alias("more")).first()
    discounts = [_discounts({n: all_words[f"c{n}"] for n in (1, 2, 3, 4)})]
    discounts += [_discounts(dict(zip((1, 2, 3, 4), of[k][1:5])) if k in of else {}) for k in range(2, order + 1)]
    total = all_words["total"] or 0
    back = sum(d * all_words[c] for d, c in zip(discounts[0], ("c1", "c2", "more"))) / total if total else 1.0
    discard(*tallies)
    seen = save(_different(texts), "words")
    points = train(seen, spec)
    discard(seen)
    return WordModel(texts, folder, parts, unigrams, wc.Weights(discounts, total, back), points, spec)


def score_words(rows: DataFrame, model: WordModel) -> DataFrame:
    """Rows without their last column, the text ``body``, with ``log`` and ``symbols`` (code points, and one a word).

    Blocks of texts ask the files of the model for the counts of their n-grams, by shuffle, and make the
    probabilities from the answers; texts are scored in turns by their digest. Rows are known by two digests of
    their text; copies of a text get their mean, which is the value of each.
    """
    slim = save(rows.select(*rows.columns[:-1], *_digests("body"), F.octet_length("body").alias("bytes")), "slim")
    size = slim.agg(F.sum("bytes")).first()[0] or 0
    asked = rows.select(*_digests("body"), "body")
    words, turns = model.laid(asked, size), _turns(SCORE_TURNS, size)
    parts = [save(model.scored(asked.where(F.pmod("d1", F.lit(turns)) == turn), words), "sums") for turn in range(turns)]
    files.delete(rows.sparkSession, words[0])
    each = reduce(DataFrame.union, parts).groupBy("d1", "d2").agg(F.avg("log").alias("log"), F.max("symbols").alias("symbols"))
    whole = slim.drop("bytes").join(each, ["d1", "d2"], "left").drop("d1", "d2")
    return whole.withColumns({"log": F.coalesce("log", F.lit(0.0)), "symbols": F.coalesce("symbols", F.lit(0))})


class Scorer:
    """Logarithms of words by a model that a task holds whole."""

    def __init__(self, grams: list[str], p: np.ndarray, back: np.ndarray, order: int):
        self.p = dict(zip(grams, p.tolist()))
        self.back = {g: b for g, b in zip(grams, back.tolist()) if b == b}
        self.order, self.known = order, {}

    def symbol(self, gram: str) -> float:
        """The probability of the last symbol of an n-gram, by its longest known end."""
        weight = 1.0
        while gram:
            if (p := self.p.get(gram)) is not None:
                return weight * p
            weight *= self.back.get(gram[:-1], 1.0)
            gram = gram[1:]
        return weight * self.p.get("", 1e-9)

    def word(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= _MEMO:
                self.known.clear()
            marked = BEGIN + word + END
            value = math.fsum(math.log(self.symbol(marked[max(0, e - self.order) : e])) for e in range(2, len(marked) + 1))
            self.known[word] = value
        return value


def _score(shared, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value, order)
        for batch in batches:
            logs, symbols = [], []
            for text in batch.column("body"):
                words = words_of(text.as_py())
                logs.append(math.fsum(map(scorer.word, words)))
                symbols.append(sum(map(len, words)) + len(words))
            kept = [batch.column(c) for c in range(batch.num_columns - 1)]
            names = [f.name for f in batch.schema][:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(logs, pa.float64()), pa.array(symbols, pa.int64())], names=[*names, "log", "symbols"])

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("body")):
            words = Counter(words_of(text.as_py()))
            yield pa.RecordBatch.from_pydict({
                "row": pa.array([row] * len(words), pa.int64()), "word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64()),
            })


def _by_joins(rows: DataFrame, model: DataFrame, spec: Model) -> DataFrame:
    """The scores of rows by joins with the sharded model: for each different word every symbol's
    longest known n-gram, then every document's words with their logarithms."""
    numbered = save(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    counts = save(numbered.select("row", "body").mapInArrow(_words, "row long, word string, n long"), "words")
    logs = _word_logs(counts.select("word").distinct(), model, spec)
    sums = counts.join(logs, "word").groupBy("row").agg(
        F.sum(F.col("n") * F.col("log")).alias("log"), F.sum(F.col("n") * F.col("symbols")).alias("symbols")
    )
    whole = numbered.drop("body").join(sums, "row", "left").drop("row")
    return whole.withColumns({"log": F.coalesce("log", F.lit(0.0)), "symbols": F.coalesce("symbols", F.lit(0))})


def _spots_of(marked: str, order: int) -> list[str]:
    """For every symbol of a word but the first the n-gram that ends with it."""
    return [marked[max(0, end - order) : end] for end in range(2, len(marked) + 1)]


def _spots(order: int):
    """The different n-grams of a piece of the words."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        spots: set[str] = set()
        for word in table["word"].to_pylist():
            spots.update(_spots_of(BEGIN + word + END, order))
        return pa.table({"piece": pa.array([key[0].as_py()] * len(spots), pa.int64()), "spot": pa.array(list(spots), pa.string())})

    return run


def _spelt(order: int, every: bool):
    """Words of a piece with the sums of what their n-grams have; those that have none by their length, if ``every``."""

    def run(words: pa.Table, spots: pa.Table) -> pa.Table:
        logs = dict(zip(spots["spot"].to_pylist(), spots["log"].to_pylist()))
        kept, sums, symbols = [], [], []
        for word in words["word"].to_pylist():
            own = [logs[s] for s in _spots_of(BEGIN + word + END, order) if s in logs]
            if own:
                kept.append(word)
                sums.append(math.fsum(own))
                symbols.append(len(own))
            elif every:
                kept.append(word)
                sums.append(math.log(1e-9) * (len(word) + 1))
                symbols.append(len(word) + 1)
        return pa.table({"word": pa.array(kept, pa.string()), "log": pa.array(sums, pa.float64()), "symbols": pa.array(symbols, pa.int64())})

    return run


def _word_logs(words: DataFrame, model: DataFrame, spec: Model, every: bool = False) -> DataFrame:
    """``(word, log, symbols)`` of different words by joins with the sharded model. What a symbol gets depends
    on the n-gram that ends with it, up to the order; words share these, and each is looked up once, and then
    goes to every piece of the words that has it."""
    pieces = words.count() // SPELLED + 1
    dealt = words.select(F.pmod(F.xxhash64("word"), F.lit(pieces)).alias("piece"), "word")
    spots = save(dealt.groupBy("piece").applyInArrow(_spots(spec.order), "piece long, spot string"), "asked")
    different = save(spots.select("spot").distinct(), "spots")
    parts = different.select("spot", F.explode(F.sequence(F.lit(0), F.char_length("spot"))).alias("size"))
    parts = parts.withColumn("gram", F.expr("substring(spot, char_length(spot) - size + 1, size)"))
    found = parts.join(model.select("gram", "p"), "gram", "left").where("p is not null").groupBy("spot").agg(
        F.max_by("p", "size").alias("p"), F.max("size").alias("size")
    )
    # Weights of the contexts that are longer than the n-gram found.
    contexts = parts.withColumn("gram", F.expr("substring(gram, 1, size - 1)")).where("size > 0").join(model.select("gram", "back"), "gram")
    longer = contexts.select("spot", F.col("size").alias("wide"), "back").where("back is not null")
    weights = longer.join(found.select("spot", "size"), "spot").where("wide > size").groupBy("spot").agg(F.sum(F.log("back")).alias("weight"))
    symbol = found.join(weights, "spot", "left").select("spot", (F.log("p") + F.coalesce("weight", F.lit(0.0))).alias("log"))
    symbol = save(symbol, "spot-logs")
    answers = spots.join(symbol, "spot").select("piece", "spot", "log")
    logs = dealt.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(_spelt(spec.order, every), "word string, log double, symbols long")
    logs = save(logs, "logs")
    discard(different, symbol, spots)
    return logs


def score(rows: DataFrame, model: DataFrame, spec: Model = Model()) -> DataFrame:
    """Rows without their last column, the text ``body``, with ``log`` and ``symbols`` of its words, each by its code points alone."""
    if model.count() > spec.broadcast:
        return _by_joins(rows, model, spec)
    table = model.toArrow()
    parts = (table["gram"].to_pylist(), table["p"].to_numpy(), table["back"].to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(parts)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_score(shared, spec.order), f"{kinds}, log double, symbols long")


def judge_quality(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", spec: Model = Model()
) -> DataFrame:
    """Per row ``key``, ``lang``, ``symbols``, ``perplexity`` (of a symbol), ``threshold``, ``kept``.

    ``trusted``: a column ``key`` with the ids of trusted documents, of which those not held out
    (see :func:`millrace.llm.toxicity.held_out`) train the model; the held-out ones give each
    language's threshold, ``Model.quantile`` of their perplexities times ``Model.slack``. A
    language without any takes the quantile of all languages. Null is a language.

    A null or empty text, and one of white space only, has no perplexity and is not kept. Repeated
    rows are judged alike, one row each; null ids are not trusted. Other columns are left out.
    Without trusted documents all that have words are kept. Empty tables give no rows.
    """
    ids = save(trusted.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct(), "trusted")
    rows = docs.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("body"))
    good = rows.where(~held_out(F.col("id"))).join(small(ids, ID_ROWS), "id", "left_semi")
    perplexity = F.when(F.col("symbols") > 0, F.exp(-F.col("log") / F.col("symbols")))
    with shuffles_dropped(docs.sparkSession):
        model = train_words(good.select("body"), spec)
        scored = save(score_words(rows, model).select("id", "lang", "symbols", perplexity.alias("perplexity")), "scores")
        model.discard()
    unseen = scored.where(held_out(F.col("id")) & F.col("perplexity").isNotNull()).join(ids, "id", "left_semi")
    cut = F.percentile_approx("perplexity", spec.quantile, 10_000) * spec.slack
    by_lang = unseen.groupBy(F.coalesce("lang", F.lit("")).alias("tongue")).agg(cut.alias("own"))
    overall = unseen.agg(cut.alias("cut")).first()["cut"]
    judged = scored.withColumn("tongue", F.coalesce("lang", F.lit(""))).join(by_lang, "tongue", "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return judged.select(
        F.col("id").alias(key), F.col("lang").alias(lang), "symbols", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"),
    )
