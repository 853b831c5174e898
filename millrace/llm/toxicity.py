"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posteriors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import save

_WORD = re.compile(r"[^\W\d_]+")
_MEMO = 100_000


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows of each class, at most (about; drawn by a digest of the id), from which
    the voters' patterns are taken. ``unlabelled``: further rows, with a label or without, that the
    classifier is fitted on beside them, drawn likewise. ``patterns``: the most patterns kept. ``support`` and
    ``purity``: toxic documents a pattern must be in, and how toxic its documents must be, with
    ``doubt`` standard deviations less toxic ones than there are (or words of one text count by chance). ``folds``: voters a
    kind of pattern is dealt to."""

    sample: int = 10_000
    unlabelled: int = 20_000
    patterns: int = 2_000
    support: int = 3
    doubt: float = 0.5
    purity: float = 0.8
    folds: int = 8
    ridge: float = 0.02
    decay: float = 1e-4


#: Kinds of patterns: whole words, and words by their first letters (for inflected and compound forms).
KINDS = {"word": 0, "stem3": 3, "stem4": 4, "stem5": 5, "stem6": 6}


def patterns_of(word: str) -> list[str]:
    out = [f"word:{word}"]
    out += [f"{kind}:{word[:n]}" for kind, n in KINDS.items() if n and len(word) > n]
    return out


def words_in(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Lexicon:
    """The chosen patterns, numbered, and the voter each belongs to."""

    patterns: list[str]
    folds: int
    numbers: dict[str, int] = field(init=False)
    voter: np.ndarray = field(init=False)

    def __post_init__(self):
        self.numbers = {p: i for i, p in enumerate(self.patterns)}
        kinds = list(KINDS)
        self.voter = np.array(
            [kinds.index(p.partition(":")[0]) * self.folds + xxhash.xxh32_intdigest(p) % self.folds for p in self.patterns], np.int64
        )
        self._known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    @property
    def voters(self) -> int:
        """A voter for each kind and fold, and two on density: any two, and any five patterns."""
        return len(KINDS) * self.folds + 2

    def hits(self, text: str | None) -> list[int]:
        """Numbers of the patterns in a text, each once."""
        known, found = self._known, set()
        for word in words_in(text):
            numbers = known.get(word)
            if numbers is None:
                if len(known) >= _MEMO:
                    known.clear()
                numbers = known[word] = tuple(self.numbers[p] for p in patterns_of(word) if p in self.numbers)
            found.update(numbers)
        return sorted(found)

    def votes(self, hits: list[int]) -> int:
        mask = 0
        for v in set(self.voter[hits].tolist()) if hits else ():
            mask |= 1 << v
        words = sum(self.patterns[h].startswith("word:") for h in hits)
        return mask | (words >= 2) << self.voters - 2 | (words >= 5) << self.voters - 1


@dataclass
class LabelModel:
    """Votes given the truth: rates by class (accuracies) and one covariance (correlations). A vote's log
    odds are divided by the number of voters that go with it, by correlation, so that a copy adds little. A known label is one more
    voter, with its own accuracies: how often it says toxic of either class."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    covariance: np.ndarray
    label_toxic: float = 0.5
    label_clean: float = 0.5

    def __post_init__(self):
        alike = np.maximum(self.correlations, 0).sum(axis=1)
        fired, quiet = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        self.weights = (fired - quiet) / np.maximum(alike, 1)
        self.offset = float(np.log(self.prior / (1 - self.prior)) + (quiet / np.maximum(alike, 1)).sum())

    @property
    def correlations(self) -> np.ndarray:
        scale = np.sqrt(np.diag(self.covariance))
        return self.covariance / np.outer(scale, scale)

    def posterior(self, votes: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """Of rows' votes and labels, a label being 1, 0 or, where there is none, NaN."""
        margin = votes @ self.weights + self.offset
        if label is not None:
            says = np.log([(1 - self.label_toxic) / (1 - self.label_clean), self.label_toxic / self.label_clean])
            margin = margin + np.where(label == 1, says[1], np.where(label == 0, says[0], 0.0))
        return sigmoid(margin)


@dataclass
class Classifier:
    lexicon: Lexicon
    label_model: LabelModel
    weights: np.ndarray
    offset: float

    def score(self, text: Column) -> Column:
        """Probability of label 1, 0 to 1; a null or empty text has no patterns and gets the least."""
        lexicon, weights, offset = self.lexicon, self.weights, self.offset

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            return pd.Series([float(sigmoid(weights[lexicon.hits(t)].sum() + offset)) for t in texts], dtype="float64")

        return scored(text)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _bits(masks: np.ndarray, voters: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(voters) & 1).astype(np.float64)


def training_labels(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``(id, gold)``: one row for each labelled id that is not held out."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    return rows.groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("gold"))


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from; a null id counts as the text "null"."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("null"))) % 5 == 0


@F.pandas_udf(T.LongType())
def _sketch(texts: pd.Series) -> pd.Series:
    """The least digest of three words in a row: the same for copies, and mostly for near copies."""

    def one(text: str) -> int:
        words = text.lower().split()
        rows = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        return min(map(xxhash.xxh64_intdigest, rows)) >> 1

    return texts.map(one).astype("int64")


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows, counts = batch.slice(start, 512), (Counter(), Counter())
            for text, gold in zip(rows.column("body"), rows.column("gold").to_pylist()):
                counts[gold].update({p for w in words_in(text.as_py()) for p in patterns_of(w)})
            names = list(counts[1])  # what is in no toxic document is of no use
            n_toxic, n_clean = ([c[p] for p in names] for c in (counts[1], counts[0]))
            others = [p for p in counts[0] if p not in counts[1]]
            yield pa.RecordBatch.from_pydict({
                "pattern": pa.array(names + others, pa.string()),
                "n_toxic": pa.array(n_toxic + [0] * len(others), pa.int64()),
                "n_clean": pa.array(n_clean + [counts[0][p] for p in others], pa.int64()),
            })


def _choose(sample: DataFrame, spec: Settings) -> Lexicon:
    counted = sample.select("body", "gold").mapInArrow(_count_patterns, "pattern string, n_toxic long, n_clean long")
    sums = counted.groupBy("pattern").agg(F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c"))
    by_class = {r["gold"]: r["n"] for r in sample.groupBy("gold").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = max(1, by_class.get(1, 0)), max(1, by_class.get(0, 0))
    toxic, clean = F.col("t") / n_toxic, F.col("c") / n_clean
    sure = (F.col("t") - spec.doubt * F.sqrt("t")) / n_toxic
    pure = sums.where(F.col("t") >= spec.support).where(sure / (sure + (F.col("c") + 1) / n_clean) >= spec.purity)
    worth = F.col("t") * F.log((toxic + 0.5 / n_toxic) / (clean + 0.5 / n_clean))
    best = pure.orderBy(worth.desc(), "pattern").limit(spec.patterns).select("pattern").collect()
    return Lexicon(sorted(r["pattern"] for r in best), spec.folds)


def _vote(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [lexicon.votes(lexicon.hits(t.as_py())) for t in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(masks, pa.int64())], names=["id", "mask"])

    return run


def _moments(voters: int):
    """Sums over all documents (number, votes, products of votes) and over each label's (number, votes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * (1 + voters) + voters * voters)
        for batch in batches:
            votes = _bits(batch.column("mask").to_numpy(), voters)
            n = batch.column("n").to_numpy().astype(float)
            gold = batch.column("gold").to_numpy(zero_copy_only=False).astype(float)
            parts = []
            for weight in (n, n * (gold == 1), n * (gold == 0)):
                parts += [[weight.sum()], weight @ votes]
            total += np.concatenate([*parts, (votes.T @ (votes * n[:, None])).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "amount"])

    return run


def _estimate(votes: DataFrame, lexicon: Lexicon, spec: Settings) -> LabelModel:
    """Accuracies from the documents with a label; prior and correlations from all documents.

    The mean vote of all documents is a mixture of the two classes' means, which gives the prior;
    the covariance of all votes less what the classes' difference explains is the covariance
    within classes. Only sums leave the executors: their number is the square of the voters'.
    """
    voters = lexicon.voters
    rows = votes.mapInArrow(_moments(voters), "place long, amount double")
    sums = np.zeros(3 * (1 + voters) + voters * voters)
    for r in rows.groupBy("place").agg(F.sum("amount").alias("amount")).collect():
        sums[r["place"]] = r["amount"]
    (n, *m), (n1, *m1), (n0, *m0) = sums[: 3 * (1 + voters)].reshape(3, 1 + voters)
    n, mean = max(n, 1), np.array(m) / max(n, 1)
    # Half a document's worth of doubt keeps empty classes and constant voters finite.
    toxic, clean = (np.array(m1) + 0.5) / (n1 + 1), (np.array(m0) + 0.5) / (n0 + 1)
    gap = toxic - clean
    prior = float(np.clip((mean - clean) @ gap / max(gap @ gap, 1e-12), 1 / (n + 2), 0.9))
    whole = sums[3 * (1 + voters) :].reshape(voters, voters) / n - np.outer(mean, mean)
    values, axes = np.linalg.eigh(whole - prior * (1 - prior) * np.outer(gap, gap))
    within = (axes * np.maximum(values, 0)) @ axes.T + spec.ridge * np.eye(voters)
    return LabelModel(prior, toxic, clean, within)


def _label_moments(model: LabelModel, voters: int):
    """Of labelled rows: the posterior weight of both classes (by votes alone), all and with label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4)
        for batch in batches:
            belief = model.posterior(_bits(batch.column("mask").to_numpy(), voters))
            n, gold = batch.column("n").to_numpy().astype(float), batch.column("gold").to_numpy().astype(float)
            total += [(n * belief).sum(), (n * belief * gold).sum(), (n * (1 - belief)).sum(), (n * (1 - belief) * gold).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4)), pa.array(total)], names=["place", "amount"])

    return run


def _with_labels(model: LabelModel, votes: DataFrame, lexicon: Lexicon) -> LabelModel:
    """The label as a voter: its accuracies are what the other voters make of all labelled rows."""
    known = votes.where("gold is not null")
    rows = known.mapInArrow(_label_moments(model, lexicon.voters), "place long, amount double")
    sums = {r["place"]: r["amount"] for r in rows.groupBy("place").agg(F.sum("amount").alias("amount")).collect()}
    toxic, toxic_said, clean, clean_said = (sums.get(i, 0.0) for i in range(4))
    return replace(model, label_toxic=(toxic_said + 1) / (toxic + 2), label_clean=(clean_said + 1) / (clean + 2))


def _believe(lexicon: Lexicon, model: LabelModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = np.array([lexicon.votes(lexicon.hits(t.as_py())) for t in batch.column("body")], np.int64)
            label = np.array([np.nan if g is None else g for g in batch.column("gold").to_pylist()], float)
            belief = model.posterior(_bits(masks, lexicon.voters), label)
            yield pa.RecordBatch.from_arrays([batch.column("body"), pa.array(belief, pa.float64())], names=["body", "belief"])

    return run


def _fit_linear(counts: np.ndarray, flat: np.ndarray, target: np.ndarray, size: int, decay: float) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels on pattern presence, by accelerated gradient steps; ``flat``
    holds the patterns of all rows, ``counts`` how many each row has."""
    rows = len(counts)
    owner = np.repeat(np.arange(rows), counts)
    prior = np.clip(target.mean() if rows else 0.01, 1e-3, 1 - 1e-3)
    weights, offset = np.zeros(size), float(np.log(prior / (1 - prior)))
    if not len(flat):
        return weights, offset
    first, second, step = np.zeros(size + 1), np.zeros(size + 1), 0.1
    for i in range(1, 501):
        margin = np.bincount(owner, weights[flat], rows) + offset
        error = (sigmoid(margin) - target) / rows
        slope = np.append(np.bincount(flat, error[owner], size) + decay * weights, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = step * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-9)
        weights, offset = weights - move[:-1], offset - float(move[-1])
    return weights, offset


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", spec: Settings = Settings()
) -> Classifier:
    """Fit voters, label model and classifier.

    Patterns (words and word beginnings) that mark toxic documents are counted in a bounded sample
    of labelled rows (``Settings.sample`` of each class) and dealt to voters. All documents vote: the
    label model takes the voters' accuracies from labelled ones, the prior and the correlations from
    all, and then weighs the labels themselves, as one more voter that may be wrong. The classifier
    sees no label: it is fitted on the model's posteriors of the labelled sample and of a bounded
    sample of all documents that are not held out (``Settings.unlabelled``), on the voters' patterns and
    those that these posteriors choose anew, so that words of unlabelled documents count too. Held-out rows are not
    learned from at all but for the votes' means and correlations, which use no label.

    Null labels and ids are not learned from; of several labels of an id, and of a text that several
    ids have, the highest holds; an id with several texts counts once, with the first in order. Null
    and empty texts have no votes; very long ones are read whole. Without labelled rows of both
    classes there are no patterns and every score is the prior. Other columns are not used.
    """
    gold = save(training_labels(labels, key, label), "gold")
    sizes = {r["gold"]: r["n"] for r in gold.groupBy("gold").agg(F.count("*").alias("n")).collect()}

    def share(most: int, of: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(most / max(1, of) * (1 << 30))

    drawn = gold.where(F.when(F.col("gold") == 1, share(spec.sample, sizes.get(1, 0))).otherwise(share(spec.sample, sizes.get(0, 0))))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("body"))
    # Settings.sample rows of each class and Settings.unlabelled others at most, whatever the input.
    learnt = rows.where(F.col("id").isNotNull() & ~held_out(F.col("id"))).join(F.broadcast(drawn), "id", "left")
    learnt = learnt.where(F.col("gold").isNotNull() | share(spec.unlabelled, docs.count()))
    learnt = learnt.groupBy("id").agg(F.min("body").alias("body"), F.max("gold").alias("gold"))
    families = learnt.groupBy(_sketch("body").alias("sketch")).agg(F.min("body").alias("body"), F.max("gold").alias("gold"))
    sample = save(families.drop("sketch"), "sample")
    lexicon = _choose(sample.where("gold is not null"), spec)

    voted = save(rows.mapInArrow(_vote(lexicon), "id long, mask long"), "voted")
    votes = save(voted.join(gold, "id", "left").groupBy("mask", "gold").agg(F.count("*").alias("n")), "votes")
    model = _with_labels(_estimate(votes, lexicon, spec), votes, lexicon)
    if not lexicon.patterns:
        return Classifier(lexicon, model, np.zeros(0), float(np.log(model.prior / (1 - model.prior))))

    believed = save(sample.mapInArrow(_believe(lexicon, model), "body string, belief double"), "believed")
    chosen = _choose(believed.withColumn("gold", (F.col("belief") >= 0.5).cast("int")), spec)
    features = Lexicon(sorted({*lexicon.patterns, *chosen.patterns}), spec.folds)

    @F.pandas_udf("array<int>")
    def hits(texts: pd.Series) -> pd.Series:
        return pd.Series([features.hits(t) for t in texts])

    fitted = believed.select(hits("body").alias("hits"), "belief").toArrow()
    found, target = fitted.column("hits").combine_chunks(), fitted.column("belief").to_numpy()
    weights, offset = _fit_linear(found.value_lengths().to_numpy(), found.flatten().to_numpy(), target, len(features.patterns), spec.decay)
    return Classifier(features, model, weights, offset)
