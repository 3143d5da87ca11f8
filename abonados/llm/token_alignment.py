"""Aligning the tokens of two vocabularies by the bytes that they stand for.

Both tokenizations of a text end their tokens at byte offsets. Offsets at which both end
a token cut the text into groups. They are found by divide and conquer: the shared end
nearest to the middle is located by bisection and both halves are cut likewise; what has
no shared end inside is a group.

Neither vocabulary joins what a space begins with what stands before it, so the ends of
words are shared and each distinct word is cut once.
"""

from __future__ import annotations

import hashlib
import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from abonados.llm.common import ready, stored
from abonados.llm.encoder import PLAIN, Remembered, byte_letters, byte_level, vocabulary

#: Words that a worker keeps aligned; twice as many are held at most.
KEPT_WORDS = 350_000
#: Bytes of text after which a block of documents ends.
BLOCK = 32 << 20
_TAIL = ".,;:!?"
#: White space before a space: the word that follows is not cut off there.
_RUNS_OF_SPACE = regex.compile(r"[\s\x1c-\x1f] ")
_WORD_BORDER = regex.compile(r"(?<![\s\x1c-\x1f])(?= )")


def shared_cuts(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """How many tokens of either side stand before the end of each group; ``a`` and ``b``
    are the tokens' ends, ascending, both up to the same last one."""
    if not a or not b:
        return []
    if len(a) == 1 or len(b) == 1:
        return [(len(a), len(b))]
    cuts, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if j - i > 1 and m - k > 1:
            # the ends inside, from the middle outwards; the last one ends the interval
            at = middle = (i + j - 2) // 2
            place = bisect_left(b, a[at], k, m)
            far = 0
            while b[place] != a[at]:
                far = -far if far > 0 else 1 - far
                at = middle + far
                if at >= j - 1 or at < i:
                    far = -far if far > 0 else 1 - far
                    at = middle + far
                    if at >= j - 1 or at < i:
                        break
                place = bisect_left(b, a[at], k, m)
            else:
                todo.append((at + 1, j, place + 1, m))
                todo.append((i, at + 1, k, place + 1))
                continue
        cuts.append((j, m))
    return cuts


def overlaps(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of token numbers whose byte ranges overlap; tokens are given by their ends,
    ascending, both up to the same last one."""
    found, i, k = [], 0, 0
    while i < len(a):
        found.append((i, k))
        end_a, end_b = a[i], b[k]
        if end_a <= end_b:
            i += 1
        if end_b <= end_a:
            k += 1
    return found


class Aligner:
    """Groups and linked id pairs of whole texts.

    ``byte_vocabulary`` is a byte-level vocabulary and encodes the text after a space;
    ``piece_vocabulary`` is one of pieces that adds the space itself and may fall back
    to bytes. Strings of special tokens are ordinary text to both.
    """

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
        self.first = Tokenizer.from_file(byte_vocabulary)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary)
        as_byte = {letter: b for b, letter in enumerate(byte_letters())}
        size = self.first.get_vocab_size()
        plain = [self.first.id_to_token(i) or "" for i in range(size)]
        first = [bytes(as_byte.get(c, 0) for c in t) for t in plain]
        second = [self._spelt(i) for i in range(self.second.get_piece_size())]
        self.spelt_a, self.spelt_b = first.__getitem__, second.__getitem__
        self.length_a, self.length_b = [len(t) for t in first].__getitem__, [len(t) for t in second].__getitem__
        self.pieces = self.second.get_piece_size()
        self.letter_of_space = byte_level(" ")
        self.tails: dict[str, list[int]] = {}
        self.space = self.second.piece_to_id("▁")
        self.words = Remembered(KEPT_WORDS)

    def _spelt(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def __call__(self, text: str) -> tuple[str, int, int, int, np.ndarray] | None:
        """The groups as text, the numbers of tokens and groups, and the linked pairs
        (first id * pieces + second id, one per link). None if the bytes of the tokens are
        not those of the text."""
        if not text:
            return None
        whole = " " + text
        if _RUNS_OF_SPACE.search(whole):
            words = _WORD_BORDER.split(whole)
            if not words[0]:
                words = words[1:]
        else:
            words = [" " + w for w in text.split(" ")]
        unknown = self.words.missing(words)
        if unknown:
            self._learn(list(unknown))
        found = list(map(self.words.new.__getitem__, words))
        if None in found:
            return None
        groups, n_a, n_b, n_groups, pairs = zip(*found, strict=True)
        return ";".join(groups), sum(n_a), sum(n_b), sum(n_groups), np.frombuffer(b"".join(pairs), "<u4")

    def _learn(self, words: list[str]) -> None:
        first = self._first_ids(words)
        second = self.second.encode([w[1:] for w in words], num_threads=1)
        for word, a, b in zip(words, first, second, strict=True):
            # the piece vocabulary adds no space to nothing: a last space stands alone
            self.words.new[word] = self._aligned(word.encode(), a, b or [self.space])

    def _first_ids(self, words: list[str]) -> list[list[int]]:
        """A space and plain letters are one piece, and so is punctuation after them; all
        other words go through the tokenizer as they stand."""
        spell, ids, odd = self.first.model.tokenize, [], []
        for number, word in enumerate(words):
            body = word[1:]
            stem = body.rstrip(_TAIL)
            tail = body[len(stem) :]
            if PLAIN.fullmatch(stem) and len(tail) < 4:
                found = [token.id for token in spell(self.letter_of_space + (stem if stem.isascii() else byte_level(stem)))]
                if tail:
                    if tail not in self.tails:
                        self.tails[tail] = self.first.encode(tail, add_special_tokens=False).ids
                    found += self.tails[tail]
                ids.append(found)
            else:
                odd.append(number)
                ids.append(None)
        rest = self.first.encode_batch_fast([words[number] for number in odd], add_special_tokens=False)
        for number, encoding in zip(odd, rest, strict=True):
            ids[number] = encoding.ids
        return ids

    def _aligned(self, word: bytes, a: list[int], b: list[int]) -> tuple[str, int, int, int, bytes] | None:
        if b"".join(map(self.spelt_a, a)) != word or b"".join(map(self.spelt_b, b)) != word:
            return None
        ends_a, ends_b = list(accumulate(map(self.length_a, a))), list(accumulate(map(self.length_b, b)))
        cuts, groups, i, k = shared_cuts(ends_a, ends_b), [], 0, 0
        for j, m in cuts:
            if j - i == m - k == 1:
                groups.append(f"{a[i]}|{b[k]}")
            else:
                groups.append(f"{','.join(map(str, a[i:j]))}|{','.join(map(str, b[k:m]))}")
            i, k = j, m
        pieces = self.pieces
        pairs = [a[i] * pieces + b[k] for i, k in overlaps(ends_a, ends_b)]
        return ";".join(groups), len(a), len(b), len(cuts), pack(f"<{len(pairs)}I", *pairs)


@lru_cache(maxsize=2)
def aligner(byte_vocabulary: str, piece_vocabulary: str) -> Aligner:
    """The worker's aligner, shared by its tasks."""
    return Aligner(byte_vocabulary, piece_vocabulary)


def _blocks(documents: DataFrame, paths: tuple[str, str], id_column: str, text: str, digest: bool) -> DataFrame:
    """Stored rows: each document with its distinct pairs (``codes``) and how many links
    each has (``links``), and for each block of documents one row without a number of
    groups that has the block's distinct pairs and in how many documents they are."""
    rows = documents.select(F.col(id_column).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"block long, doc {kind}, n_a long, n_b long, n_groups long, groups string, codes binary, links binary"

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, block, held = aligner(*paths), TaskContext.get().partitionId() << 24, 0
        seen: list[np.ndarray] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            counted = np.concatenate([np.empty((0, 2), np.int64), *seen])
            codes, at = np.unique(counted[:, 0], return_inverse=True)
            return codes, np.bincount(at, counted[:, 1], len(codes)).astype(np.int64)

        def closing(type_of_id: pa.DataType) -> pa.RecordBatch:
            codes, n = summed()
            return _batch(pa.nulls(1, type_of_id), block, [(None, None, None, None, codes.astype("<u4").tobytes(), n.astype("<i8").tobytes())])

        type_of_id = None
        for batch in batches:
            type_of_id = batch.schema.field(0).type
            found, of_batch, begun = [], [], 0
            for row, value in enumerate(batch.column(1)):
                plain = value.as_py() or ""
                held += len(plain)
                result = align(plain)
                if result is None:
                    found.append((0, 0, 0, "", b"", b""))
                else:
                    groups, n_a, n_b, n_groups, pairs = result
                    codes, links = np.unique(pairs, return_counts=True)
                    of_batch.append(codes)
                    groups = hashlib.sha256(groups.encode()).hexdigest() if digest else groups
                    found.append((n_a, n_b, n_groups, groups, codes.tobytes(), links.astype("<u4").tobytes()))
                if held >= BLOCK or row + 1 == batch.num_rows:
                    if of_batch:
                        codes, n = np.unique(np.concatenate(of_batch), return_counts=True)
                        seen[:] = [np.stack(summed(), 1), np.stack([codes.astype(np.int64), n], 1)]
                    yield _batch(batch.column(0).slice(begun, row + 1 - begun), block, found)
                    found, of_batch, begun = [], [], row + 1
                if held >= BLOCK:
                    yield closing(type_of_id)
                    block, held = block + 1, 0
                    seen.clear()
        if type_of_id is not None and held:
            yield closing(type_of_id)

    return stored(rows.mapInArrow(aligned, schema), "aligned")


def _batch(ids: pa.Array, block: int, rows: list[tuple]) -> pa.RecordBatch:
    n_a, n_b, n_groups, groups, codes, links = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block] * len(rows), pa.int64()),
            "doc": ids,
            "n_a": pa.array(n_a, pa.int64()),
            "n_b": pa.array(n_b, pa.int64()),
            "n_groups": pa.array(n_groups, pa.int64()),
            "groups": pa.array(groups, pa.string()),
            "codes": pa.array(codes, pa.binary()),
            "links": pa.array(links, pa.binary()),
        }
    )


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows as one row per pair."""
    for batch in batches:
        for block, codes, n in zip(*batch.columns, strict=True):
            pairs = np.frombuffer(codes.as_py(), "<u4").astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(pairs), block.as_py(), np.int64)),
                    "code": pa.array(pairs),
                    "n": pa.array(np.frombuffer(n.as_py(), "<i8")),
                }
            )


def align_tokens(
    documents: DataFrame,
    byte_vocabulary: str | None = None,
    piece_vocabulary: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    digest: bool = False,
) -> DataFrame:
    """How two vocabularies' tokens of every text correspond: the id, ``n_a``, ``n_b``,
    ``n_groups``, ``groups``, ``n_links``, ``n_best`` and ``count_sum``.

    ``groups`` lists the tokens between shared ends as ``a1,a2|b1;a3|b2,b3``, or is its
    sha256 with ``digest``. A link is a pair of tokens whose bytes overlap; its count is
    the number of documents of the corpus that hold its two ids linked. ``n_best`` are the
    links whose count is the highest of their first id, ``count_sum`` adds up all counts.

    Null and empty texts, and texts that the vocabularies do not spell byte by byte,
    have no tokens: zeros and empty ``groups``. Repeated rows count as documents each,
    null ids stay null, an empty table stays empty, other columns are left aside.

    Blocks of documents count their pairs before anything is shuffled, and get back the
    corpus's counts of these pairs only.
    """
    ready(documents.sparkSession)
    paths = (byte_vocabulary or vocabulary("byte_bpe_50k.json"), piece_vocabulary or vocabulary("piece_bpe_32k.model"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    held = _blocks(documents, paths, id_column, text, digest)
    of_blocks = held.filter("n_groups IS NULL").select("block", "codes", "links")
    pairs = stored(of_blocks.mapInArrow(_spread, "block long, code long, n long"), "pairs")
    # a first id has no more pairs than the second vocabulary has pieces
    of_first = Window.partitionBy(F.floor(F.col("code") / pieces))
    totals = pairs.groupBy("code").agg(F.sum("n").alias("documents"))
    totals = totals.withColumn("best", F.col("documents") == F.max("documents").over(of_first))
    known = pairs.select("block", "code").join(totals, "code").select("block", "code", "documents", "best")
    rows = held.filter("n_groups IS NOT NULL")
    kind = rows.schema["doc"].dataType.simpleString()
    schema = (
        f"doc {kind}, n_a long, n_b long, n_groups long, groups string, n_links long, n_best long, count_sum long"
    )

    def counted(docs: pa.Table, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("code").to_numpy())
        codes = table.column("code").to_numpy()[order]
        of_pair = np.concatenate([table.column("documents").to_numpy()[order], [0]])
        best = np.concatenate([table.column("best").to_numpy(zero_copy_only=False).astype(bool)[order], [False]])
        n_links, n_best, sums = [], [], []
        for own, links in zip(docs.column("codes"), docs.column("links"), strict=True):
            at = np.searchsorted(codes, np.frombuffer(own.as_py(), "<u4"))
            times = np.frombuffer(links.as_py(), "<u4").astype(np.int64)
            n_links.append(int(times.sum()))
            n_best.append(int(times[best[at]].sum()))
            sums.append(int((times * of_pair[at]).sum()))
        out = docs.select(["doc", "n_a", "n_b", "n_groups", "groups"])
        for name, column in (("n_links", n_links), ("n_best", n_best), ("count_sum", sums)):
            out = out.append_column(name, pa.array(column, pa.int64()))
        return out

    judged = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(counted, schema)
    return judged.withColumnRenamed("doc", id_column)
