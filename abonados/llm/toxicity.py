"""Toxicity by weak supervision.

Many weak voters, words and word beginnings that labelled toxic documents have more often
than others, vote on every document. A generative label model explains the votes of the
whole corpus by a hidden label: it estimates how often each voter speaks for either label
and how voters depend on one another, so that voters that repeat each other count once.
Its posteriors are the labels on which a linear classifier is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonados.llm.common import ready, stored, widened

#: Labelled documents from which voters are found, at most; the least hashes of their ids.
LABELLED = 20_000
#: Voters of the label model, and terms that the classifier sees.
VOTERS = 64
TERMS = 256
#: A term counts for toxic if this many labelled toxic documents have it, and its share
#: among them is so many times that among the others.
LEAST_TOXIC = 8
LEAST_RATIO = 25.0
#: And it is right in so many labelled documents, against the best term.
LEAST_PRECISION = 0.97
#: Voters repeat each other if their correlation under the toxic label is above this.
REPEATS = 0.7
#: Lengths of word beginnings.
STEMS = (4, 5, 6)
ROUNDS = 12
#: Patterns of votes that a task sums up, at least, and arrays of sums that are added at a
#: time, so that arrays follow the number of patterns, not of partitions.
TASK_PATTERNS = 50_000
FAN_IN = 16


def terms_of(text: str) -> set[str]:
    """Words in lower case without punctuation around them, and their beginnings with a
    star after them."""
    words = {w.strip(".,;:!?\"'()[]*#%&$|-") for w in text.lower().split()}
    words.discard("")
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


@dataclass(frozen=True)
class Model:
    """Terms, the weight of each in the classifier, and its bias; besides them what the
    label model found: the voters' rates under either label and their redundancy."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    prior: float
    rates: tuple[tuple[float, float], ...]
    redundancy: tuple[float, ...]


def find_terms(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
    labelled: int = LABELLED,
) -> tuple[list[str], float]:
    """The terms that tell toxic documents best, best first, and the share of toxic ones.

    Counted on a sample of at most ``labelled`` labelled rows. Null labels, ids and texts
    are not learned from; a document with several labels counts with each.
    """
    ready(documents.sparkSession)
    sample = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y")).dropna()
    sample = sample.orderBy(F.xxhash64("id"), "id", "y").limit(labelled)  # so many short rows, also when broadcast
    texts = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    known = texts.join(F.broadcast(stored(sample, "labelled")), "id").select("text", "y").filter("text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, ys = [], []
            for value, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = list(terms_of(value.as_py()))
                terms += ["", *found]
                ys += [y] * (len(found) + 1)
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), "y": pa.array(ys, pa.int32())})

    each = known.mapInArrow(counted, "term string, y int").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("toxic"), F.count(F.lit(1)).alias("all")
    )
    each = stored(each.filter((F.col("toxic") >= LEAST_TOXIC) | (F.col("term") == "")), "terms")
    whole = each.filter("term = ''").first()
    if whole is None or not 0 < whole["toxic"] < whole["all"]:
        return [], 0.0
    clean = whole["all"] - whole["toxic"]
    share, other = F.col("toxic") / whole["toxic"], (F.col("all") - F.col("toxic") + 0.5) / (clean + 1)
    right = F.col("toxic") / F.col("all")
    top = each.filter("term != ''").agg(F.max(right).alias("top")).first()["top"] or 0.0
    best = each.filter(right >= LEAST_PRECISION * top).filter((F.col("term") != "") & (share / other >= LEAST_RATIO)).withColumn("gain", share * F.log(share / other))
    chosen = best.orderBy(F.desc("gain"), "term").limit(TERMS).collect()
    return [row["term"] for row in chosen], whole["toxic"] / whole["all"]


def votes(documents: DataFrame, terms: list[str], text: str = "text") -> DataFrame:
    """``documents`` with ``_votes``: the numbers of the terms that the text has."""
    ready(documents.sparkSession)
    number = {term: i for i, term in enumerate(terms)}
    position = documents.columns.index(text)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.keys()
        for batch in batches:
            found = [sorted(number[t] for t in terms_of(v.as_py() or "") & known) for v in batch.column(position)]
            columns = [*batch.columns, pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_votes"])

    return documents.mapInArrow(vote, widened(documents, _votes="array<int>"))


def _sums(patterns: DataFrame, function, width: int) -> np.ndarray:
    """The sum over all patterns of ``function(matrix of votes, counts)``, ``width`` numbers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                matrix = np.zeros((part.num_rows, TERMS))
                lists = part.column(0)
                rows = np.repeat(np.arange(part.num_rows), [len(x) for x in lists.to_pylist()])
                matrix[rows, lists.flatten().to_numpy()] = 1
                total += function(matrix, part.column(1).to_numpy().astype(float))
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, width).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    rows = patterns.select("_votes", "n").mapInArrow(summed, "sums array<double>")
    parts = patterns.rdd.getNumPartitions()
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = rows.repartition(parts).mapInArrow(added, "sums array<double>")
    return np.sum([row["sums"] for row in rows.collect()], axis=0, initial=0.0) + np.zeros(width)


def _label_model(patterns: DataFrame, m: int, prior: float):
    """Rates, silence and redundancy of the voters, and the posterior they give.

    A voter that finds nothing abstains; a document on which all abstain is evidence of
    its own, as silent as documents of either label are. EM estimates how often each
    voter speaks under either label and how often all are silent. Then the correlations
    between voters under the toxic label are taken; voters that repeat each other share
    one vote, and EM runs again.
    """
    rates = np.stack([np.full(m, 0.05), np.full(m, 0.05 / LEAST_RATIO**2)])
    silent, weight, base = np.array([0.1, 0.99]), np.ones(m), prior

    def posterior(v: np.ndarray, rates=rates, silent=silent, base=base, weight=weight) -> np.ndarray:
        spoken = v @ (weight * np.log(rates[0] / rates[1]))
        score = np.log(base / (1 - base)) + np.where(v.any(axis=1), spoken, np.log(silent[0] / silent[1]))
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))

    for turn in range(2):
        for _ in range(ROUNDS // 2):
            def expected(v, n, state=(rates, silent, base, weight)):
                v = v[:, :m]
                p = posterior(v, *state) * n
                quiet = ~v.any(axis=1)
                return np.concatenate([[p.sum(), n.sum(), p @ quiet, (n - p) @ quiet], p @ v, (n - p) @ v])

            s = _sums(patterns, expected, 4 + 2 * m)
            toxic, clean = s[0], s[1] - s[0]
            base = min(max(toxic / max(s[1], 1), 1e-4), 0.5)
            silent = np.clip(np.array([(s[2] + 1) / (toxic + 2), (s[3] + 1) / (clean + 2)]), 1e-4, 1 - 1e-4)
            silent[0] = min(silent[0], silent[1])
            rates = np.stack([(s[4 : 4 + m] + 0.05) / (toxic + 1), (s[4 + m :] + 0.05) / (clean + 100)])
            rates = np.clip(rates, 1e-7, 0.999)
            rates[1] = np.minimum(rates[1], rates[0])  # a voter speaks for toxic or abstains
        if turn == 0:
            def products(v, n, state=(rates, silent, base, weight)):
                v = v[:, :m]
                p = posterior(v, *state) * n
                return np.concatenate([[p.sum()], ((v * p[:, None]).T @ v).ravel()])

            s = _sums(patterns, products, 1 + m * m)
            both = s[1:].reshape(m, m) / max(s[0], 1e-9)
            one = np.diag(both)
            spread = np.sqrt(np.clip(one * (1 - one), 1e-9, None))
            correlation = (both - np.outer(one, one)) / np.outer(spread, spread)
            np.fill_diagonal(correlation, 1)
            weight = 1 / np.where(correlation > REPEATS, correlation, 0).sum(axis=1)
    return (lambda v: posterior(v, rates, silent, base, weight)), base, rates, weight


def train(
    documents: DataFrame, labels: DataFrame, corpus: DataFrame, id_column: str = "doc_id", text: str = "text",
    label: str = "toxic", labelled: int = LABELLED,
) -> Model:
    """A model whose voters come from labelled ``documents``, whose label model is fitted
    on the votes of all of ``corpus``, and whose classifier is trained on its posteriors.

    Each round sums over the distinct patterns of votes, counted once; only these sums,
    no more than the square of the number of terms, come to the driver.
    """
    terms, prior = find_terms(documents, labels, id_column, text, label, labelled)
    if not terms:
        return Model((), (), -4.0, 0.0, (), ())
    texts = votes(corpus.select(F.col(text).cast("string").alias("text")), terms)
    patterns = stored(texts.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")), "patterns")
    patterns = patterns.coalesce(1 + patterns.count() // TASK_PATTERNS)
    m, k = min(VOTERS, len(terms)), len(terms)
    posterior, base, rates, weight = _label_model(patterns, m, prior)
    w, b = np.zeros(k), np.log(base / (1 - base))
    for _ in range(ROUNDS):
        def newton(v, n, w=w, b=b):
            x = np.concatenate([v[:, :k], np.ones((len(v), 1))], axis=1)
            p = 1 / (1 + np.exp(-np.clip(v[:, :k] @ w + b, -30, 30)))
            slope = x.T @ (n * (posterior(v[:, :m]) - p))
            return np.concatenate([slope, ((x * (n * p * (1 - p))[:, None]).T @ x).ravel()])

        s = _sums(patterns, newton, (k + 1) * (k + 2))
        slope, bend = s[: k + 1], s[k + 1 :].reshape(k + 1, k + 1)
        keep = np.append(np.full(k, 1.0), 1e-6)
        step = np.linalg.solve(bend + np.diag(keep), slope - keep * np.append(w, 0.0))
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        w, b = w + step[:k], b + step[k]
        if np.abs(step).max() < 1e-3:
            break
    return Model(tuple(terms), tuple(w), float(b), float(base), tuple(map(tuple, rates.T)), tuple(1 / weight))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` (0 to 1, of the whole text) and ``predicted`` (1 from
    0.5). Null and empty texts have the score of a text without any term. Columns of
    these names are replaced; repeated rows are scored alike."""
    kept = documents.drop("score", "predicted", "_votes")
    weights = F.array(*[F.lit(float(x)) for x in model.weights]) if model.weights else F.array(F.lit(0.0))
    total = F.aggregate("_votes", F.lit(model.bias), lambda s, i: s + F.element_at(weights, i + 1))
    voted = votes(kept, list(model.terms), text).withColumn("score", 1 / (1 + F.exp(-total)))
    return voted.drop("_votes").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
