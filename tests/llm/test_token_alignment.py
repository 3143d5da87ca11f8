"""Token alignment against both whole-text encodings and pairwise overlaps."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from abonados.llm import queries, token_alignment

SCHEMA = "doc_id long, text string, block int, codes string, doc string, n long"


def texts():
    draw = random.Random(3)
    odd = ["  ", "\n", "\t", " \n ", "\x1c ", "\xa0", "　", "é", "é", "क़", "日本語の文", "🙂👍🏽", "ﬁ", "\x00", "''s", "12345", "<0x41>", "<|endoftext|>", "</s>", "<unk>", "!!!", "Ünïcödé", "http://x.yz/a?b=c"]
    words = ["the", "alignment", "tokens", "Zwiebelsuppe,", "aujourd'hui", "of", "x"]
    out = [None, "", " ", "  ", "\n", "a", "▁", "a ▁b", " lead", "trail ", "the\x1c cat", "the cat", "the cat", "文" * 500]
    out += ["long" * 800, " ".join(draw.choice(words) for _ in range(5000))]
    for _ in range(150):
        out.append("".join(draw.choice(odd if draw.random() < 0.4 else words) + draw.choice(["", " ", " "]) for _ in range(draw.randrange(1, 25))))
    return list(enumerate(out))


def tokens(first, second, text):
    """(ids, spans) of both sides, or nothing."""
    if not text:
        return None
    byte_of = {c: b for b, c in enumerate(token_alignment.byte_letters())}
    a = first.encode(" " + text, add_special_tokens=False)
    of_a = [bytes(byte_of[c] for c in t) for t in a.tokens]
    b = second.encode(text)
    of_b = []
    for i in b:
        piece = second.id_to_piece(i)
        of_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(of_a) != whole or b"".join(of_b) != whole:
        return None

    def spans(parts):
        at, out = 0, []
        for part in parts:
            out.append((at, at + len(part)))
            at += len(part)
        return out

    return a.ids, spans(of_a), b, spans(of_b)


def expected(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, counts, links = {}, Counter(), {}
    for doc, text in rows:
        both = tokens(first, second, text)
        if both is None:
            found[doc], links[doc] = (0, 0, 0, ""), []
            continue
        a, spans_a, b, spans_b = both
        ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, start = [], 0
        for end in ends:
            inside = [
                ",".join(str(i) for i, (s, e) in zip(ids, spans, strict=True) if start <= s and e <= end)
                for ids, spans in ((a, spans_a), (b, spans_b))
            ]
            groups.append("|".join(inside))
            start = end
        found[doc] = (len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
        links[doc] = [
            (x, y)
            for x, (s, e) in zip(a, spans_a, strict=True)
            for y, (t, f) in zip(b, spans_b, strict=True)
            if s < f and t < e
        ]
        counts.update(set(links[doc]))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    return {
        doc: (*found[doc], len(own), sum(counts[p] == highest[p[0]] for p in own), sum(counts[p] for p in own))
        for doc, own in links.items()
    }


@pytest.mark.parametrize("block", [token_alignment.BLOCK, 200])
def test_query_equals_brute_force(spark, tmp_path, block):
    small = [(i, t) for i, t in texts() if len(t or "") < 2500]
    rows = [(i, t, 1, "c", "d", 2) for i, t in small]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    before, token_alignment.BLOCK = token_alignment.BLOCK, block
    try:
        got = queries.op13(spark, str(tmp_path)).collect()
    finally:
        token_alignment.BLOCK = before
    names = ("n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum")
    assert {r.doc_id: tuple(r[n] for n in names) for r in got} == expected(small)


def test_groups_of_long_texts(spark):
    rows = [(i, t) for i, t in texts() if 500 <= len(t or "") < 4000]
    got = {r.doc_id: r for r in token_alignment.align_tokens(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, (n_a, n_b, n_groups, digest, *_) in expected(rows).items():
        row = got[doc]
        assert (row.n_a, row.n_b, row.n_groups) == (n_a, n_b, n_groups)
        assert hashlib.sha256(row.groups.encode()).hexdigest() == digest


def test_shared_cuts_equal_the_intersection():
    draw = random.Random(8)
    for _ in range(500):
        n = draw.randrange(1, 60)
        a, b = (sorted({*draw.sample(range(1, n + 1), draw.randrange(n)), n}) for _ in range(2))
        cuts = token_alignment.shared_cuts(a, b)
        assert cuts == [(a.index(e) + 1, b.index(e) + 1) for e in sorted({*a} & {*b})]


def test_empty_table(spark):
    assert token_alignment.align_tokens(spark.createDataFrame([], SCHEMA)).collect() == []
