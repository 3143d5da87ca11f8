"""Copies count once in a language's sample; open sequences are filled up in the end."""

import numpy as np
import pytest

from abonados.llm import language, packing


def test_copies_are_one_passage(spark):
    texts = [f"distinct passage number {i} of the sample" for i in range(40)]
    copies = [("copied text that stands here very often", "en")] * 400
    rows = copies + [(t, "en") for t in texts] + [("ein Satz", "de"), (None, "de"), ("12", "de"), ("no label", None)]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"), sample_documents=30)
    assert set(model) == {"en", "de"} and model["de"] == b"ein satz"
    found = model["en"].decode().split("\n")
    assert len(found) == len(set(found)) == 30
    whole = language.train(spark.createDataFrame(rows, "text string, lang string"))["en"].decode().split("\n")
    assert sorted(whole) == sorted([*texts, copies[0][0]])


def test_empty_sample(spark):
    assert language.train(spark.createDataFrame([], "text string, lang string")) == {}


def best_fit_count(lengths, size):
    gaps = []
    for s in lengths:
        fitting = [g for g in gaps if g >= s]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - s)
        else:
            gaps.append(size - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_refit_is_whole_and_never_worse(seed):
    random = np.random.default_rng(seed)
    size = 64
    lengths = np.sort(random.integers(1, size if seed % 2 else size // 3, random.integers(1, 300)))[::-1].astype(np.int64)
    before, starts = packing.sum_of_squares(lengths, size)
    sequences, offsets = packing.refit(lengths, before, starts, size)
    assert len(set(sequences)) <= len(set(before))
    filled = np.bincount(before, weights=lengths)
    loose = lengths[filled[before] < size]
    full = int((filled == size).sum())
    assert len(set(sequences)) == full + min(best_fit_count(loose.tolist(), size), int((filled < size).sum()))
    for sequence in set(sequences):
        inside = np.flatnonzero(sequences == sequence)
        inside = inside[np.argsort(offsets[inside])]
        ends = np.cumsum(lengths[inside])
        assert ends[-1] <= size and offsets[inside].tolist() == [0, *ends[:-1]]


def test_refit_of_nothing():
    none = np.empty(0, np.int64)
    assert [len(x) for x in packing.refit(none, none, none, 8)] == [0, 0]
