"""Keys travel as steps and come back as they were."""

import zlib

import numpy as np

from abonados.llm import lm


def test_keys_come_back_and_compress():
    draw = np.random.default_rng(2)
    for keys in (draw.integers(0, 2**57, 20_000, dtype=np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.array([], np.uint64)):
        keys = np.unique(keys)
        packed = lm._packed_keys(keys)
        assert len(packed) == 8 * len(keys)
        assert (lm._keys(packed) == keys).all()
        if len(keys) > 3:
            assert len(zlib.compress(packed, 1)) < 0.85 * len(zlib.compress(keys.tobytes(), 1))
