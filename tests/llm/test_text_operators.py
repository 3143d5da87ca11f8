"""The text operators against brute force on small tables with nulls, empty and long
texts, ties, repeated texts and further columns whose names the operators also use."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from abonados.llm import (
    chat,
    decontaminate,
    exact_dedup,
    language,
    lm,
    near_dedup,
    packing,
    token_counts,
    url_filter,
)
from abonados.llm.encoder import vocabulary

SCHEMA = "doc_id long, text string, lang string, uid string, word string, n long, kept boolean, key binary, id long"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
PASSAGE = " ".join(f"bench{i}" for i in range(20))


def rows():
    draw = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    say = lambda n: " ".join(draw.choice(vocab) for _ in range(n))
    texts = [None, "", " \t\n", "one", "one two", "One\x0btwo", "one two three", "one two three"]
    for _ in range(12):
        base = say(60).split()
        texts += [" ".join(base), " ".join([*base[:-1], "changed"]), " ".join(["Changed", *base[1:]]).upper(), "  ".join(base)]
    texts += [say(9000), "x" * 50_000, f"{say(30)} {PASSAGE} {say(30)}", f"{say(900)} {PASSAGE}", "a b", "b, A; b"]
    return [(i, t, ("en", "fr", None)[i % 3], "u", "w", 1, True, b"k", -1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return {r[0]: r[1] or "" for r in rows()}


def by_id(frame, column="doc_id"):
    found = {r[column]: r for r in frame.collect()}
    assert len(found) == frame.count()
    return found


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def near_components(size, percent):
    sets = {i: shingles(t, size) for i, t in texts().items()}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                linked = sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
                if linked and least[a] < least[b]:
                    least[b], changed = least[a], True
    return sets, least


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, size, percent):
    sets, least = near_components(size, percent)
    found = by_id(near_dedup.near_duplicates(documents, size=size, percent=percent))
    assert {i: r.component_id for i, r in found.items()} == least
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_large_nodes_lose_no_link(spark, monkeypatch):
    """Nodes above the bound branch, and end in blocks and pairs of blocks."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 4)
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(200)]
    found = []
    for i in range(60):
        words = list(base)
        words[(3 * i) % 200] = f"own{i}"
        found.append((i, " ".join(words)))
    found += [(i, " ".join(f"w{draw.randrange(500)}" for _ in range(100))) for i in range(60, 80)]
    judged = near_dedup.near_duplicates(spark.createDataFrame(found, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in judged} == {i: 0 if i < 60 else i for i, _ in found}


def test_near_dedup_keeps_one_whole_row_of_each_group(documents):
    _, least = near_components(5, 80)
    kept = near_dedup.drop_near_duplicates(documents, size=5, percent=80)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def stays():
    groups = {}
    for i, t in texts().items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    return groups


def test_exact_dedup_equals_brute_force(documents):
    found = by_id(exact_dedup.duplicate_report(documents))
    for normal, members in stays().items():
        for _, i in members:
            r = found.pop(i)
            assert (r.keep_id, r.group_size, r.kept) == (min(members)[1], len(members), i == min(members)[1])
            assert r.text_sha256 == hashlib.sha256(normal.encode()).hexdigest()
    assert not found


def test_exact_dedup_keeps_whole_rows(documents):
    kept = exact_dedup.deduplicate(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(m)[1] for m in stays().values())


ITEMS = [("q1", PASSAGE), ("q2", "A b"), ("q3", None), ("q4", "?!"), ("q0", "B a"), ("q5", "never seen words")]


def benchmark_rows(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def test_decontamination_equals_brute_force(spark, documents):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    found = by_id(decontaminate.contamination(documents, benchmark_rows(spark)))
    clean = []
    for i, t in texts().items():
        words, hit, items = words_of(t), set(), set()
        for item, text in ITEMS:
            w = words_of(text)
            for window in [w[k : k + 13] for k in range(max(1, len(w) - 12))] if w else []:
                for k in range(len(words) - len(window) + 1):
                    if words[k : k + len(window)] == window:
                        hit |= set(range(k, k + len(window)))
                        items.add(item)
        r, bad = found[i], bool(hit) and 20 * len(hit) >= len(words)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(words), len(hit), len(items), bad)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        clean += [] if bad else [i]
    kept = decontaminate.decontaminate(documents, benchmark_rows(spark))
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == clean


def encoded():
    tokenizer = Tokenizer.from_file(vocabulary())
    return {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts().items()}


def test_packing_places_every_piece_once_and_without_gaps(documents):
    ids = {i: [*x, 0] for i, x in encoded().items()}
    packed = packing.pack(packing.cut(documents)).collect()
    assert len({(r.doc_id, r.piece) for r in packed}) == len(packed)
    together = Counter()
    for r in packed:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and len(part) == r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        together[r.doc_id] += r.length
    assert together == {i: len(x) for i, x in ids.items()}
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert ends[r.sequence_id] <= 2048


def test_token_counts_equal_brute_force(documents):
    lengths = [len(x) for x in encoded().values()]
    histogram = token_counts.length_histogram(documents)
    assert {r.n_tokens: r.documents for r in histogram.collect()} == Counter(lengths)
    for limit in (0, 3, 70, 10**6):
        r = token_counts.kept_at(histogram, limit).collect()[0]
        assert r.tokens_kept == sum(min(n, limit) for n in lengths)
        assert r.documents_cut == sum(n > limit for n in lengths)
    assert token_counts.token_quantile(histogram, 0.5).collect()[0].n_tokens == sorted(lengths)[(len(lengths) + 1) // 2 - 1]


def test_base_scores_equal_brute_force(documents):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)), "\0"] for i, t in texts().items()}
    count = Counter(w for i, x in tokens.items() if i % 5 for w in x)
    total, distinct = sum(count.values()), len(count)
    found = by_id(lm.score(documents, F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 1))
    for i, x in tokens.items():
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(count[w] > 0 for w in x), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in x))
        assert r.score < 0


def test_languages_are_told_apart_and_texts_without_letters_are_not(spark):
    english = ["the cat sat on the mat and the dog was with them", "this is what they have said about the weather"]
    french = ["le chat est sur la table et le chien avec eux", "voici ce que les gens ont dit de la pluie"]
    train = [(t, k) for k, group in (("en", english), ("fr", french)) for t in group * 4]
    model = language.train(spark.createDataFrame(train, "text string, lang string"))
    judged = language.identify(
        spark.createDataFrame([(0, english[0]), (1, french[0]), (2, None), (3, ""), (4, "12 34 !")], "doc_id long, text string"), model
    )
    found = by_id(judged)
    assert [found[i].lang_pred for i in range(5)] == ["en", "fr", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert all(found[i].rejected for i in (2, 3, 4))


def test_url_rules(spark):
    cases = [
        ("http://net/x", "net/", "block"),
        ("http://a.NET", None, None),
        ("http://a.NET/", "net/", "block"),
        ("http://www.example.net/en/a?b", "example.net/en/", "allow"),
        ("http://example.net/de/", "net/", "block"),
        ("http://notnet.org/fr/x", "org/fr/", "allow"),
        ("http://example.com/de/x#y", "example.com/de/", "block"),
        ("http://myexample.com/de/", None, None),
        ("no scheme net/", None, None),
        (None, None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "r") for i, c in enumerate(cases)], "page_id long, url string, word string")
    found = by_id(url_filter.filter_urls(pages, url_filter.rule_table(spark)), "page_id")
    for i, (_, rule, verdict) in enumerate(cases):
        assert found[i].rule == rule
        assert verdict is None or found[i].verdict == verdict
        assert found[i].verdict in ("allow", "block")


def test_transcripts_recover_roles(spark):
    turns = [(c, t, ("user", "assistant")[t % 2], ("User: ", "Assistant: ")[t % 2] + f"words {t}") for c in range(20) for t in range(6)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    model = chat.train(frame)
    odd = spark.createDataFrame([(99, 0, None), (99, 1, ""), (99, 1, "")], "conv_id long, turn long, text string")
    parsed = chat.parse(frame.drop("role").unionByName(odd), model).collect()
    assert len(parsed) == len(turns) + 3
    right = {(c, t): r for c, t, r, _ in turns}
    assert all(r.role_pred == right[r.conv_id, r.turn] for r in parsed if r.conv_id != 99)


def test_empty_tables_give_empty_results(spark, none):
    assert near_dedup.near_duplicates(none, size=3, percent=85).count() == 0
    assert exact_dedup.duplicate_report(none).count() == 0
    assert decontaminate.contamination(none, benchmark_rows(spark)).count() == 0
    assert packing.pack(packing.cut(none)).count() == 0
    assert token_counts.length_histogram(none).count() == 0


def test_stages_are_those_of_the_pipeline():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "exact_dedup",
        "minhash_near_dedup",
        "benchmark_decontamination",
        "best_fit_packing",
    ]
