"""Language-model scores by deleted interpolation of word n-grams.

The probability of a word after another mixes maximum-likelihood estimates: of the pair,
of the word, and one over the vocabulary. The weights of the mixture depend on how often
the first word was seen, by powers of two; expectation-maximisation learns them on part
of the training documents, whose own counts are deleted meanwhile.

Documents are dealt to blocks of bounded size. A block sends each of its distinct n-grams
once to the task that counts that n-gram over all blocks, and gets the counts back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonados.llm.common import hashed_words, mixed, ready, stored, text_chunks

#: Bytes of text in a block.
BLOCK_BYTES = 8_000_000
#: The token that ends a document; the first word follows it.
END = np.uint64(0x5DEECE66D)
BUCKETS = 48
ROUNDS = 60
#: No weight falls below this, so every text has a probability.
LEAST_WEIGHT = 1e-5
#: What a block's documents are for.
TRAIN, TUNE, OTHER = 0, 1, 2


def _tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed tokens of the texts, an end after each, and where each text's tokens end."""
    parts, counts = [], []
    for _, _, data, ends in text_chunks(texts):
        words, upto = hashed_words(data, ends)
        parts.append(np.insert(words, upto, END))
        counts.append(np.diff(upto, prepend=0) + 1)
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def _grams(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token its context, and a hash of the two."""
    context = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    context[ends[:-1]] = END
    return context, mixed(mixed(context) + tokens)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ordered keys as steps, byte by byte: the high bytes of steps are zeros, which a
    shuffle compresses."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(held: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(8, -1).T).view("<u8")
    return np.cumsum(steps.ravel(), dtype=np.uint64)


def _entries(tokens: np.ndarray, pairs: np.ndarray, parts: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(kind, part, keys in order, their counts) of the distinct words and pairs."""
    for kind, found in ((0, tokens), (1, pairs)):
        keys, counts = np.unique(found, return_counts=True)
        bounds = np.searchsorted(_part(keys, parts), np.arange(parts + 1, dtype=np.uint64))
        for part in np.flatnonzero(np.diff(bounds)):
            cut = slice(bounds[part], bounds[part + 1])
            yield kind, int(part), keys[cut], counts[cut].astype(np.uint32)


def _counted(blocks: DataFrame, parts: int) -> DataFrame:
    """Counts for every block: ``at``, ``kind``, ``part``, ``every`` and, for blocks of
    tuning documents, ``rest`` (without these documents), in the order of the block's keys in that part. A row with
    ``at`` -1 tells how many distinct words and how many tokens a part has."""

    def send(table: pa.Table) -> pa.Table:
        at, use = table.column("at")[0].as_py(), table.column("use")[0].as_py()
        tokens, ends = _tokens(table.column("text"))
        _, pairs = _grams(tokens, ends)
        rows = [(at, use, k, p, _packed_keys(keys), n.tobytes()) for k, p, keys, n in _entries(tokens, pairs, parts)]
        return pa.Table.from_pylist(
            [dict(zip(("at", "use", "kind", "part", "keys", "n"), row, strict=True)) for row in rows],
            pa.schema([("at", pa.int64()), ("use", pa.int32()), ("kind", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]),
        )

    sent = blocks.groupBy("at").applyInArrow(send, "at long, use int, kind int, part long, keys binary, n binary")

    def count(table: pa.Table) -> pa.Table:
        kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
        at, use = table.column("at").to_pylist(), np.array(table.column("use").to_pylist())
        keys = [_keys(x) for x in table.column("keys").to_pylist()]
        own = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("n").to_pylist()]).astype(float)
        sizes = [len(x) for x in keys]
        tunes = (use == TUNE).tolist()
        use = np.repeat(use, sizes)
        _, number = np.unique(np.concatenate(keys), return_inverse=True)
        every = np.bincount(number, np.where(use != OTHER, own, 0)).astype(np.int64)
        rest = np.bincount(number, np.where(use == TRAIN, own, 0)).astype(np.int64)
        out, start = [], 0
        for block, n, tune in zip(at, sizes, tunes, strict=True):
            mine = number[start : start + n]
            start += n
            without = rest[mine].astype("<u8").tobytes() if tune else None
            out.append({"at": block, "kind": kind, "part": part, "every": every[mine].astype("<u8").tobytes(), "rest": without})
        if kind == 0:
            sums = [np.count_nonzero(every), every.sum(), np.count_nonzero(rest), rest.sum()]
            out.append({"at": -1, "kind": kind, "part": part, "every": np.array(sums, "<u8").tobytes(), "rest": None})
        return pa.Table.from_pylist(out, pa.schema([("at", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("every", pa.binary()), ("rest", pa.binary())]))

    return sent.groupBy("kind", "part").applyInArrow(count, "at long, kind int, part long, every binary, rest binary")


def _looked_up(table: pa.Table, counts: pa.Table, column: str):
    """The counts of every token, of its context and of the two, in the order of the
    texts; and where each text's tokens end."""
    tokens, ends = _tokens(table.column("text"))
    context, pairs = _grams(tokens, ends)
    by_kind: list[list[tuple[int, bytes]]] = [[], []]
    for kind, part, held in zip(*(counts.column(c).to_pylist() for c in ("kind", "part", column)), strict=True):
        by_kind[kind].append((part, held))
    found = [np.concatenate([np.frombuffer(h, "<u8") for _, h in sorted(rows)]).astype(float) for rows in by_kind]
    words, number = np.unique(tokens, return_inverse=True)
    two = np.unique(pairs, return_inverse=True)[1]
    before = np.concatenate([[np.searchsorted(words, END)], number[:-1]])
    before[ends[:-1]] = np.searchsorted(words, END)
    return found[0][number], found[0][before], found[1][two], ends


def _buckets(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(int), 0).clip(0, BUCKETS - 1)


def _estimates(word, context, pair, tokens: float, vocabulary: float):
    return pair / np.maximum(context, 1), word / max(tokens, 1), 1 / (vocabulary + 1)


def _weights(blocks: DataFrame, counts: DataFrame, vocabulary: float, tokens: float) -> np.ndarray:
    """Mixture weights (pair, word, uniform) of every bucket, learned on the blocks' documents
    with counts from the rest. Tokens are grouped by rounded estimates; that table, not the
    documents, comes to the driver, and rounding bounds its size."""

    def cells(_, table: pa.Table, held: pa.Table) -> pa.Table:
        out = pa.schema([("bucket", pa.int32()), ("q2", pa.int32()), ("q1", pa.int32()), ("n", pa.int64())])
        if not table.num_rows:
            return out.empty_table()
        word, context, pair, _ = _looked_up(table, held, "rest")
        p2, p1, _ = _estimates(word, context, pair, tokens, vocabulary)
        quarter = lambda p: np.where(p > 0, np.round(4 * np.log(np.maximum(p, 1e-30))), -999).astype(np.int32)
        rows, n = np.unique(np.stack([_buckets(context), quarter(p2), quarter(p1)], 1), axis=0, return_counts=True)
        return pa.table([pa.array(rows[:, 0], pa.int32()), pa.array(rows[:, 1], pa.int32()), pa.array(rows[:, 2], pa.int32()), pa.array(n, pa.int64())], schema=out)

    made = blocks.groupBy("at").cogroup(counts.groupBy("at")).applyInArrow(cells, "bucket int, q2 int, q1 int, n long")
    rows = made.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).collect()
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not rows:
        return weights
    bucket, q2, q1, n = (np.array([row[i] for row in rows]) for i in range(4))
    p = np.stack([np.where(q2 == -999, 0, np.exp(q2 / 4)), np.where(q1 == -999, 0, np.exp(q1 / 4)), np.full(len(n), 1 / (vocabulary + 1))], 1)
    for _ in range(ROUNDS):
        share = weights[bucket] * p
        share *= (n / share.sum(1))[:, None]
        # one token of each kind is added, so an empty bucket stays even
        sums = np.stack([np.bincount(bucket, share[:, i], BUCKETS) for i in range(3)], 1) + 1 / 3
        weights = np.maximum(sums / sums.sum(1, keepdims=True), LEAST_WEIGHT)
        weights /= weights.sum(1, keepdims=True)
    return weights


def score(documents: DataFrame, training: Column, tuning: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's id, ``trained`` (``training`` holds), ``n_tokens``, ``n_known``
    (tokens that training has), ``train_tokens``, ``base_score`` (log10 probability under
    add-one word counts) and ``score`` (of the model).

    Tokens are words between white space, A-Z in lower case, and one end; null and empty
    texts have the end alone. ``tuning`` names the training documents on which weights are
    learned; their counts join the model afterwards. Without training documents every
    count is 0. Null conditions are false; repeated rows count and are scored each; an
    empty table gives an empty result.
    """
    ready(documents.sparkSession)
    yes = lambda c: F.coalesce(c, F.lit(False))
    use = F.when(yes(training) & yes(tuning), TUNE).when(yes(training), TRAIN).otherwise(OTHER)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"), use.alias("use"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    parts = max(1, -(-int(size) // BLOCK_BYTES))
    at = F.pmod(F.xxhash64("id", "text"), F.lit(parts)) + F.col("use") * parts
    blocks = rows.withColumn("at", at.cast("long"))  # copies differ in id, so they spread
    counts = stored(_counted(blocks, parts), "counts")
    vocabulary = tokens = rest_vocabulary = rest_tokens = 0
    for row in counts.filter("at = -1").select("every").toLocalIterator():
        v, n, rv, rn = np.frombuffer(bytes(row["every"]), "<u8").tolist()
        vocabulary, tokens, rest_vocabulary, rest_tokens = vocabulary + v, tokens + n, rest_vocabulary + rv, rest_tokens + rn
    tuned = F.col("at").between(TUNE * parts, (TUNE + 1) * parts - 1)
    weights = _weights(blocks.filter(F.col("use") == TUNE), counts.filter(tuned).drop("every"), rest_vocabulary, rest_tokens)

    def scored(_, table: pa.Table, held: pa.Table) -> pa.Table:
        word, context, pair, ends = _looked_up(table, held, "every")
        p2, p1, p0 = _estimates(word, context, pair, tokens, vocabulary)
        w = weights[_buckets(context)]
        model = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
        base = np.log10((word + 1) / (tokens + vocabulary + 1))
        begins = np.concatenate([[0], ends[:-1]])
        sums = [np.add.reduceat(x, begins) for x in (base, model, (word > 0).astype(np.int64))]
        n = len(ends)
        columns = [table.column("id").combine_chunks(), pa.array(np.full(n, table.column("use")[0].as_py() != OTHER)), pa.array(np.diff(ends, prepend=0)), pa.array(sums[2]), pa.array(np.full(n, int(tokens), np.int64)), pa.array(sums[0]), pa.array(sums[1])]
        return pa.table(columns, names=["id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    both = blocks.groupBy("at").cogroup(counts.filter("at >= 0").drop("rest").groupBy("at"))
    return both.applyInArrow(scored, schema).withColumnRenamed("id", id_column)
