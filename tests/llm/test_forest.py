"""A spanning forest that doesn't hold the pairs it is made of."""

import weakref

import numpy as np
from firnline.llm import simhash


def test_chunks_are_dropped_as_they_are_read():
    alive = []

    def chunks():
        for k in range(40):
            i = np.repeat(np.arange(200), 50)
            j = (i + np.tile(np.arange(1, 51), 200) + k) % 200
            alive.append(weakref.ref(i))
            yield i, j
            del i, j
            assert sum(r() is not None for r in alive) <= 2

    i, j = simhash.forest(200, chunks(), np.arange(200, dtype=np.uint64))
    assert len(i) == 199
