"""The registered scores use the trigram context."""

import numpy as np
from firnline.llm import backoff


def test_order_and_packed_counts(documents):
    assert backoff.ORDER >= 3
    rows = documents([(i, t) for i, t in enumerate(["a b c", "a b c", "x b d", "x b d"])])
    three, two = ({r.doc_id: r.log_score for r in backoff.scored(rows, *order).collect()} for order in ((), (2,)))
    assert three[0] > two[0]  # after "a b" always c, after "b" c or d
    for usual, counts in ((1, [1, 1, 5, 1 << 40, 1, 1, 1, 1, 2]), (0, [0, 0, 3]), (1, [])):
        counts = np.array(counts, dtype=np.int64)
        assert backoff.unpacked_counts(backoff.packed_counts(counts, usual), usual).tolist() == counts.tolist()
