"""Near-duplicates by a similarity join on minwise tokens, in bands and chosen paths.

Every document has a set of word shingles and, of that, one minwise token for each of
``SLOTS`` permutations. A tree begins with a band: documents that agree in all tokens of a
few slots enter the same node. Below, it branches on tokens: a document enters the children
of the tokens that a random choice picks, about 1/threshold of its tokens, so documents that
share many tokens meet in some child. Nodes that are small are compared exhaustively;
larger ones are compared in blocks. Where these leave groups apart, all other rows of the
node meet its largest group and one another in pairs of blocks; the largest group's own
rows are not paired. If that would be too many rows, the nodes branch again before.
Independent trees repeat this. Documents that look alike in some node are confirmed on
their full sets, and confirmed links make components.

Documents with equal sets are one class from the start, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abonados.llm.common import components, hashed_words, mixed, ready, shingles, stored, text_chunks, unused

#: Minwise tokens of a document.
SLOTS = 128
#: Trees that are grown at most, and slots of a band at most. One token of 16 bits would
#: bring together ever more documents that differ as a corpus grows; three do not.
MOST_TREES, MOST_SLOTS = 24, 3
#: The share of pairs at the threshold that the first levels of all trees may miss; deeper
#: down, trees miss fewer the more alike two documents are.
MISSED = 7e-6
#: Nodes up to this size are compared exhaustively; twice it is the size of a block pair.
SMALL_NODE = 512
LEVELS = 3
#: The first band is looked at before all others. What it holds together is one group from
#: then on: trees only look for links between different groups. Groups are named anew, in so
#: many rounds, before a large node branches.
ROUNDS = 1
#: Rows of pairs of blocks, for each class, up to which a large node does not branch.
PAIR_ROWS = 8
#: Documents look alike if their tokens agree in the threshold less this share: four
#: standard deviations of the estimate from ``SLOTS`` tokens.
MARGIN = 0.14
#: Full sets confirmed in one task at a time: documents, and words of their texts.
BLOCK = 768
BLOCK_BYTES = 24_000_000

#: Bits of a Bloom filter of join keys: for each key, and at most.
KEY_BITS, MOST_BITS = 16, 1 << 28

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(shingle_set: np.ndarray) -> np.ndarray:
    """One 16-bit minwise token per slot; the set is not empty."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingle_set), 1024):
        part = shingle_set[start : start + 1024]
        np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def _bands(threshold: float) -> np.ndarray:
    """The slots of each tree's band: so many to a band, ``MOST_SLOTS`` or fewer, that
    ``MOST_TREES`` bands find enough of the pairs at the threshold, or one."""
    for slots in range(MOST_SLOTS, 0, -1):
        trees = int(np.ceil(np.log(MISSED) / np.log1p(-min(threshold, 0.999) ** slots)))
        if trees <= MOST_TREES or slots == 1:
            break
    return np.random.default_rng(21).permutation(SLOTS)[: min(trees, SLOTS // slots) * slots].reshape(-1, slots)


def _chosen(tokens: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For documents (rows of ``tokens``) in nodes, the children: row numbers and nodes."""
    slots = np.arange(SLOTS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    children = mixed(mixed(tokens.astype(np.uint64) + slots[None, :]) + nodes[:, None])
    limit = np.uint64(int(2**64 / (threshold * SLOTS)))
    rows, picked = np.nonzero(mixed(children) < limit)
    return rows, children[rows, picked]


def _sketched(documents: DataFrame, size: int, id_column: str, text: str) -> DataFrame:
    """``id``, ``mark`` and ``bytes`` of the text, ``n`` (size of the set), ``key`` (of the set; null
    for none) and ``tokens``: the low bytes of all of them (``_low``), then the high ones."""
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.col(text)).alias("mark"),
        F.col(text).cast("string").alias("text"),
        F.octet_length(F.col(text).cast("string")).cast("long").alias("bytes"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, ends in text_chunks(batch.column(2)):
                words, upto = hashed_words(data, ends)
                counts, keys, tokens, begin = [], [], [], 0
                for stop in upto.tolist():
                    found = shingles(words[begin:stop], size)
                    begin = stop
                    counts.append(len(found))
                    if len(found):
                        low = np.bitwise_xor.reduce(mixed(found))
                        keys.append(np.array([low, mixed(found + low).sum()], np.uint64).tobytes())
                        tokens.append(minwise(found).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())
                    else:
                        keys.append(None)
                        tokens.append(None)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column(0)[start:end],
                        "mark": batch.column(1)[start:end],
                        "bytes": batch.column(3)[start:end],
                        "n": pa.array(counts, pa.int64()),
                        "key": pa.array(keys, pa.binary()),
                        "tokens": pa.array(tokens, pa.binary()),
                    }
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sketch, f"id {kind}, mark long, bytes long, n long, key binary, tokens binary")


def _signatures(column: pa.Array) -> np.ndarray:
    parts = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2, SLOTS).astype(np.uint16)
    return parts[:, 0] | parts[:, 1] << 8


def _low(tokens: str = "tokens") -> Column:
    return F.substring(tokens, 1, SLOTS)


def _roots(classes: DataFrame, bands: np.ndarray) -> DataFrame:
    """The first level of the trees: (``node``, ``key``, ``known``)."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _signatures(batch.column(2)).astype(np.uint64)
            for tree, band in enumerate(bands):
                nodes = np.full(len(tokens), mixed(np.array([tree + 1], np.uint64))[0])
                for slot in band:
                    nodes = mixed(nodes + tokens[:, slot])
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), batch.column(0), batch.column(1)], ["node", "key", "known"])

    return classes.select("key", "known", "tokens").mapInArrow(branch, "node long, key binary, known binary")


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """The next level below ``rows`` (``node``, ``key``, ``known``, ``tokens``)."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column(0).to_numpy().view(np.uint64)
            chosen, below = _chosen(_signatures(batch.column(3)), nodes, threshold)
            taken = [batch.column(i).take(pa.array(chosen)) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(below.view(np.int64)), *taken], ["node", "key", "known"])

    return rows.select("node", "key", "known", "tokens").mapInArrow(branch, "node long, key binary, known binary")


def _group() -> Column:
    """What a class is known to belong to; ``known`` is null where that is its own key."""
    return F.coalesce("known", "key")


def _open(level: DataFrame) -> DataFrame:
    """The rows of nodes that hold different groups, with the ``size`` of the node."""
    mark = F.xxhash64(_group())
    sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(mark).alias("low"), F.max(mark).alias("high"))
    return level.join(sizes.filter("low != high").select("node", "size"), "node")


def _alike(nodes: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Links (``a``, ``b``) between groups (``known``) that look alike in some members
    within a node of ``nodes`` (``node``, ``key``, ``known``): each group with the first
    that it is held together with."""
    rows = nodes.join(classes.select("key", _low().alias("bits")), "key").select("node", _group().alias("known"), "bits")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # all rows of a node follow one another; the last one may go on in the next batch
            ids = batch.column(0).to_numpy()
            cut = int(np.searchsorted(ids, ids[-1], side="left"))
            if cut:
                yield from _linked([*held, batch.slice(0, cut)], least)
                held = []
            held.append(batch.slice(cut))
        yield from _linked(held, least)

    ordered = rows.repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(compared, "a binary, b binary")


def _linked(batches: list[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    nodes = rows.column("node").to_numpy()
    # a token's low byte tells most pairs apart; agreement by chance is taken off
    tokens = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint8).reshape(-1, SLOTS)
    need = SLOTS * (least + (1 - least) / 256)
    known = rows.column("known")
    packed = np.frombuffer(b"".join(known.to_pylist()), "S16")
    # by name: in every tree the same group comes first
    _, found, group = np.unique(packed, return_index=True, return_inverse=True)
    label, left, right = np.arange(len(found)), [], []
    for step in range(1, len(nodes)):
        first = np.flatnonzero(nodes[step:] == nodes[:-step])
        if not len(first):
            break
        first = first[group[first] != group[first + step]]
        if not len(first):
            continue
        for part in np.array_split(first, -(-len(first) // 20_000)):
            hits = part[(tokens[part] == tokens[part + step]).sum(axis=1) >= need]
            left.append(hits)
            right.append(hits + step)
    if not left:
        return
    a, b = group[np.concatenate(left)], group[np.concatenate(right)]
    while True:
        before = label.copy()
        np.minimum.at(label, b, label[a])
        np.minimum.at(label, a, label[b])
        label = label[label]
        if (label == before).all():
            break
    members = np.flatnonzero(label != np.arange(len(label)))
    first, other = (known.take(pa.array(found[x])) for x in (label[members], members))
    yield from pa.table({"a": first, "b": other}).to_batches()


def _named(classes: DataFrame, links: list[DataFrame], rounds: int) -> DataFrame:
    """``classes`` with the group (``known``) in which so many rounds of the links hold
    each of them. A group may be a part of what is held together: then more is compared."""
    groups = components(reduce(DataFrame.unionByName, links), "a", "b", rounds)
    joined = classes.join(groups, classes["key"] == groups["node"], "left")
    return joined.select("key", "tokens", F.when(F.col("label") != F.col("key"), F.col("label")).alias("known"))


def _candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """Links (``a``, ``b``) that hold together all classes (``key``, ``tokens``) which
    look alike in some node of some tree."""
    least, bands = threshold - MARGIN, _bands(threshold)
    named = classes.withColumn("known", F.lit(None).cast("binary"))
    # the first tree's nodes are apart, and so are most links in them
    met = stored(_open(_roots(named, bands[:1])), "met")
    links = [stored(_alike(_blocks(met), classes, least), "alike")]
    level = _roots(_named(classes, links, rounds=0), bands)
    most = PAIR_ROWS * max(classes.count(), 10 * SMALL_NODE)
    for depth in range(1, LEVELS + 1):
        met = stored(_open(level), "met")
        links.append(stored(_alike(_blocks(met), classes, least), "alike"))
        large = met.filter(F.col("size") > SMALL_NODE).select("node", "key")
        if not large.limit(1).count():
            break
        # groups that blocks left apart meet in pairs of blocks; if these are too many rows,
        # their nodes branch before
        renamed = _named(classes, links, ROUNDS).select("key", "known")
        apart = stored(_parted(large.join(renamed, "key")), "apart")
        if depth == LEVELS or (apart.agg(F.sum(F.size(_meetings()))).first()[0] or 0) <= most:
            links.append(stored(_alike(_open(_block_pairs(apart)), classes, least), "alike"))
            break
        level = _children(apart.join(classes.select("key", "tokens"), "key"), threshold)
    return reduce(DataFrame.unionByName, links)


def _confirmed(groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between classes whose full sets have a similarity of ``percent`` or more:
    each class with the first it is linked to in its block, over all pairs of blocks.

    ``groups``: ``group``, ``blocks`` (how many it has), ``key``, ``text``; rows may repeat.
    """
    own = F.pmod(F.xxhash64("key"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("x"), F.greatest(own, other).alias("y")),
    )
    rows = groups.select("group", F.explode(pairs).alias("pair"), own.alias("own"), "key", "text")
    rows = rows.select(F.xxhash64("group", "pair").alias("at"), "key", "text")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, sets = None, [], []
        for batch in batches:
            for start, _, data, ends in text_chunks(batch.column(2)):
                words, upto = hashed_words(data, ends)
                begin = 0
                for i, stop in enumerate(upto.tolist()):
                    node = batch.column(0)[start + i].as_py()
                    key = batch.column(1)[start + i].as_py()
                    if node != at:
                        yield from _links(keys, sets, percent)
                        at, keys, sets = node, [], []
                    if not keys or keys[-1] != key:  # rows that repeat id and text follow each other
                        keys.append(key)
                        sets.append(shingles(words[begin:stop], size))
                    begin = stop
        yield from _links(keys, sets, percent)

    return rows.repartition("at").sortWithinPartitions("at", "key").mapInArrow(confirm, "a binary, b binary")


def _links(keys: list[bytes], sets: list[np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    """A forest of the exact links among these sets, by one product of incidence matrices
    over runs of shingles that at least two of them have."""
    if len(sets) < 2:
        return
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    number, owner = number[shared], owner[shared]
    number = np.unique(number, return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, 8_000_000 // len(sets))
    bounds = np.searchsorted(number, np.arange(0, (number[-1] + 1 if len(number) else 0) + width, width))
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if lo < hi:
            part = np.zeros((len(sets), int(number[hi - 1]) + 1 - i * width), np.float32)
            part[owner[lo:hi], number[lo:hi] - i * width] = 1
            common += part @ part.T
    both = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(100 * common >= percent * both, 1))
    label = np.arange(len(sets))
    while True:
        before = label.copy()
        np.minimum.at(label, b, label[a])
        np.minimum.at(label, a, label[b])
        label = label[label]
        if (label == before).all():
            break
    members = np.flatnonzero(label != np.arange(len(sets)))
    if len(members):
        yield pa.RecordBatch.from_pydict(
            {
                "a": pa.array([keys[i] for i in label[members]], pa.binary()),
                "b": pa.array([keys[i] for i in members], pa.binary()),
            }
        )


def near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` (the least id that
    is reachable over links, its own included) and ``kept`` (it is that id).

    Two documents are linked if their sets of ``size``-word shingles have a similarity of
    ``percent`` or more; words are what white space separates, A-Z in lower case. With
    fewer words the whole sequence is one shingle. Null and empty texts are linked with
    nothing. Null ids never name a component unless all its ids are null. Repeated rows
    count each; other columns are left aside; an empty table gives an empty result.
    """
    ready(documents.sparkSession)
    threshold = percent / 100
    sketched = stored(_sketched(documents, size, id_column, text), "sketches")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("mark"), F.col("bytes"))
    # equal sets have equal tokens
    named = sketched.filter("key IS NOT NULL").groupBy("key").agg(F.min(first).alias("first"), F.first("tokens").alias("tokens"))
    named = stored(named.select("key", "tokens", *[F.col(f"first.{x}").alias(x) for x in ("id", "mark", "bytes")]), "classes")
    classes = named.select("key", "tokens")

    groups = components(_candidates(classes, threshold), "a", "b")
    texts = documents.select(
        F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).cast("string").alias("text")
    )
    members = groups.join(named.drop("tokens"), groups["node"] == named["key"])
    members = members.select("key", F.col("label").alias("group"), "id", "mark", "bytes")
    extent = members.groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("bytes") / BLOCK_BYTES)).alias("blocks")
    members = stored(members.drop("bytes").join(extent.select("group", blocks), "group"), "members").filter("blocks > 0")
    with _filtered_early(documents.sparkSession, members.count()):
        found = texts["id"].eqNullSafe(members["id"]) & (texts["mark"] == members["mark"])
        full = texts.join(members, found).select("key", "group", "blocks", "text")
        linked = stored(_confirmed(full, size, percent), "confirmed")
    linked = components(linked, "a", "b")

    # classes by component, their documents, and the least id
    ids = sketched.select("id", "n", "key").join(linked, sketched["key"] == linked["node"], "left")
    ids = stored(ids.select("id", "n", F.coalesce("label", "key").alias("component")), "members")
    least = ids.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    return ids.join(least, "component", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    ).withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))


@contextmanager
def _filtered_early(spark: SparkSession, keys: int) -> Iterator[None]:
    """While it lasts, a join with so many keys sends a Bloom filter of them to the other
    side's scan before that is shuffled, whatever the sizes. The filter has at most 32 MB;
    with more keys more rows pass it, and the join decides."""
    bits = min(max(KEY_BITS * keys, 1 << 13), MOST_BITS)
    filters = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": "0",
        "creationSideThreshold": "1t",
        "expectedNumItems": str(max(keys, 1)),
        "maxNumItems": str(max(keys, 1)),
        "numBits": str(bits),
        "maxNumBits": str(MOST_BITS),
    }
    wanted = {f"spark.sql.optimizer.runtime.bloomFilter.{name}": value for name, value in filters.items()}
    wanted["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _block_of(size: str) -> tuple[Column, Column]:
    """The number of blocks for so many rows of a node, about half a small node each, and
    a row's own."""
    blocks = F.ceil(F.col(size) / (SMALL_NODE / 2)).cast("long")
    return blocks, F.pmod(F.xxhash64("node", "key"), blocks)


def _blocks(rows: DataFrame) -> DataFrame:
    """Nodes of any size as blocks, small ones as they are."""
    block = F.when(F.col("size") > SMALL_NODE, F.xxhash64("node", _block_of("size")[1])).otherwise(F.col("node"))
    return rows.select(block.alias("node"), "key", "known")


def _parted(rows: DataFrame) -> DataFrame:
    """The rows of nodes that hold different groups: ``main`` tells whether a row is of its
    node's largest group, ``held`` how many are, and ``rest`` how many are not."""
    mark = F.xxhash64(_group())
    groups = rows.groupBy("node", mark.alias("mark")).agg(F.count(F.lit(1)).alias("held"))
    sizes = groups.groupBy("node").agg(F.sum("held").alias("size"), F.max(F.struct("held", "mark")).alias("most"))
    sizes = sizes.select("node", "most.*", (F.col("size") - F.col("most.held")).alias("rest"))
    return rows.join(sizes.filter("rest > 0"), "node").select("node", "key", "known", (mark == F.col("mark")).alias("main"), "held", "rest")


def _meetings() -> Column:
    """The pairs of blocks that a row of ``_parted`` enters. Blocks of the largest group are
    numbered from 0, others from -1 down."""
    (blocks, own), (others, other) = _block_of("held"), _block_of("rest")
    first = F.lit(0).cast("long")
    main = F.transform(F.sequence(first, others - 1), lambda x: F.struct(own.alias("x"), (-1 - x).alias("y")))
    met = F.transform(F.sequence(first, blocks - 1), lambda x: F.struct(x.alias("x"), (-1 - other).alias("y")))
    among = F.transform(
        F.sequence(first, others - 1),
        lambda x: F.struct((-1 - F.least(x, other)).alias("x"), (-1 - F.greatest(x, other)).alias("y")),
    )
    return F.when(F.col("main"), main).otherwise(F.concat(met, among))


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Nodes of any size as pairs of blocks, so that every two documents of a node that are
    of different groups meet in one pair."""
    return rows.select(F.explode(_meetings()).alias("pair"), "node", "key", "known").select(
        F.xxhash64("node", "pair").alias("node"), "key", "known"
    )


def drop_near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each component, whole and with the input's columns; rows that
    repeat an id count as one document."""
    judged = near_duplicates(documents, size, percent, id_column, text)
    (name,) = unused(documents, "_lost")
    lost = judged.filter(~F.col("kept")).select(F.col(id_column).alias(name)).distinct()
    return documents.join(lost, F.col(id_column).eqNullSafe(F.col(name)), "left_anti")
