"""Histogram packing against its definition: whole texts, tight packs, longest first."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from abonados.llm import histogram_packing as packing
from abonados.llm import queries
from abonados.llm.encoder import encoder, vocabulary

SCHEMA = "doc_id long, text string, ids string, block int, length long, doc string"


def texts():
    draw = random.Random(11)
    out = [None, "", " ", "a", "a", "क़ <|endoftext|> İ é é", "word " * 2047, "word " * 2048, "word " * 2049, "x " * 9000]
    out += [" ".join(f"w{draw.randrange(900)}." for _ in range(draw.randrange(1, 400))) for _ in range(200)]
    return list(enumerate([*out, *["same text"] * 150]))


def ids_of(text):
    tokenizer = Tokenizer.from_file(vocabulary())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, ids, size):
    pieces, packs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        packs[r.sequence_id].append((r.offset, r.length))
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(ids[r.doc_id]))
    for doc, own in ids.items():
        assert [sum(n for _, n in sorted(pieces[doc])[:k]) for k in range(len(pieces[doc]))] == [s for s, _ in sorted(pieces[doc])]
        assert sum(n for _, n in pieces[doc]) == len(own)
    total = sum(map(len, ids.values()))
    fills = []
    for pack in packs.values():
        at = 0
        for offset, length in sorted(pack):
            assert offset == at
            at += length
        fills.append(at)
    rest = [1 << k for k in range(size.bit_length()) if (total % size) >> k & 1]
    assert Counter(fills) == Counter([size] * (total // size) + rest)
    return len(rows)


def test_query_packs_every_id_once_without_padding(spark, tmp_path):
    rows = [(i, t, "i", 1, 2, "d") for i, t in texts()]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: ids_of(t) for i, t in texts()}
    packed = queries.op12(spark, str(tmp_path)).collect()
    assert check(packed, ids, 2048) <= len(ids) + 2 * (sum(map(len, ids.values())) // 2048 + 12)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_sizes_with_ids(spark, size):
    rows = [(i, t, "i", 1, 2, "d") for i, t in texts()[:80]]
    packed = packing.pack_by_histogram(spark.createDataFrame(rows, SCHEMA), size=size, with_ids=True).collect()
    ids = {i: ids_of(t) for i, t in texts()[:80]}
    check(packed, ids, size)
    for r in packed:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length]


def placed_one_by_one(histogram, size):
    """The rule document by document: the emptiest pack, of equal ones the lowest."""
    total = sum(n * c for n, c in histogram.items())
    room = [size] * (total // size) + [1 << k for k in range(size.bit_length(), -1, -1) if (total % size) >> k & 1]
    packs, waiting = [[] for _ in room], Counter(histogram)
    for length in range(size, 0, -1):
        while waiting[length]:
            waiting[length] -= 1
            k = max(range(len(room)), key=lambda i: (room[i], -i))
            part = min(length, room[k])
            packs[k].append(part)
            room[k] -= part
            waiting[length - part] += 1
    return Counter(tuple(sorted(p)) for p in packs)


def test_patterns_equal_the_rule_document_by_document():
    draw = random.Random(2)
    for _ in range(60):
        size = draw.randrange(1, 40)
        histogram = Counter(draw.randrange(1, size + 1) for _ in range(draw.randrange(0, 120)))
        plan = packing.shortest_pack_first(histogram, size)
        found = Counter()
        for pattern, _, n in plan.patterns:
            found[tuple(sorted(x for length, times in pattern for x in [length] * times))] += n
        assert found == placed_one_by_one(histogram, size)


def test_plan_is_bounded_by_the_size_of_a_pack():
    lengths = {n: 10**9 // n + n for n in range(1, 2049)}
    plan = packing.shortest_pack_first(lengths, 2048)
    assert sum(map(len, plan.parts)) < 200_000
    assert sum(n for _, _, n in plan.patterns) - sum(n * c for n, c in lengths.items()) // 2048 <= 11


def test_empty_table(spark):
    assert packing.pack_by_histogram(spark.createDataFrame([], SCHEMA)).collect() == []


def test_encoder_equals_whole_texts():
    tokenizer, encode, draw = Tokenizer.from_file(vocabulary()), encoder(vocabulary()), random.Random(4)
    odd = ["क़", "ড়", "שּׁ", "İ", "ß", "é", "<|endoftext|>", "<|STARTOFTEXT|>", "🙂", "12", "'ll", "'S", "\x00", "ſ", "‍", "Ab", "É,", "!?", " ", "\n", "　", "\x1c"]
    letters = [chr(draw.randrange(0x20, 0x2FFF)) for _ in range(3000)]
    for _ in range(3000):
        text = "".join(draw.choice(odd if draw.random() < 0.6 else letters) for _ in range(draw.randrange(12)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
