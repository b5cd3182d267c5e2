"""Training steps and pipeline stages against plain Python."""

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from compare import TABLES
from firnline.llm import chat, quality
from test_corpus import check_packing, plain_components, plain_print
from test_scans import plain_hits


def test_follow_leader_step_by_step():
    """The usual per-coordinate formulas with dictionaries."""
    rng, bits = np.random.default_rng(3), 5
    examples = []
    for _ in range(60):
        index = np.unique(rng.integers(0, 1 << bits, 6))
        examples.append((int(index[0] % 3 == 0), index, rng.random(len(index))))
    alpha, beta, l1, l2, epochs = 2.0, 1.0, 0.05, 0.1, 2
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for label, index, value in examples:
            x = {**dict(zip(index.tolist(), value.tolist())), 1 << bits: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - label) * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    got = quality.follow_leader(examples, bits, epochs, alpha, beta, l1, l2)
    assert np.allclose(got, [weight(i) for i in range((1 << bits) + 1)], atol=1e-12)
    assert np.count_nonzero(got) > 5


def plain_boilerplate(docs, ratio, least):
    """(doc_id, text) without the lines that too many of a host's different pages carry."""
    pages = collections.defaultdict(set)
    for _, host, text in docs:
        pages[host or ""].add(text or "")
    bad = {}
    for host, texts in pages.items():
        held = collections.Counter(x for t in texts for x in {y.strip(" ") for y in t.split("\n")} if x)
        bad[host] = {x for x, n in held.items() if n >= least and n > ratio * len(texts)}
    return [(d, t if t is None or not bad[h or ""] else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad[h or ""]))
            for d, h, t in docs]


def planted(tmp_path, spark):
    """Tables with copies, boilerplate, benchmark passages, odd rows and a long text."""
    rng = np.random.default_rng(21)
    words = np.array([f"w{i}" for i in range(900)])
    body = lambda n: "\n".join(" ".join(rng.choice(words, 12)) for _ in range(n))
    item = " ".join(rng.choice(words, 30))
    texts = [body(int(rng.integers(2, 30))) for _ in range(60)]
    rows = [(i, f"menu home\n{t}", f"h{i % 3}") for i, t in enumerate(texts)]
    rows += [(100 + i, rows[5][1], "h2") for i in range(8)]
    rows += [(200 + i, rows[7][1].replace(rows[7][1].split()[20 + i], "edited", 1), "h1") for i in range(4)]
    rows += [(300 + i, f"{body(3)}\nbefore {item[:90 + i]} {item} after", "h0") for i in range(3)]
    rows += [(400, None, None), (401, "", "h0"), (402, "  ", "h0"), (403, body(900), "h4"), (5, rows[5][1], "h2")]
    frame = spark.createDataFrame([(d, t, "en", h, len(t or "")) for d, t, h in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, 1, 0) for d, *_ in rows if d % 2], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert {"documents", "benchmark", "labels"} <= set(TABLES)
    return frame, item


def test_stages_against_plain_versions(spark, tmp_path):
    docs, item = planted(tmp_path, spark)
    folder, stages = str(tmp_path), dict(pipeline.STAGES)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]

    # Only label 1 is known, so everything stays; odd rows too.
    kept = stages["quality_filter"](spark, docs, folder)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))

    out = stages["line_dedup"](spark, docs, folder).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(plain_boilerplate(rows, 0.05, 3), key=str)
    assert all(r.n_chars == len(r.text) for r in out if r.text is not None)
    assert not any(r.text and "menu home" in r.text for r in out)

    out = stages["near_dedup"](spark, docs, folder).collect()
    prints = {i: plain_print(t, 3) for i, (_, _, t) in enumerate(rows)}
    groups = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, g in groups.items():
        first[g] = min(first.get(g, 1 << 60), rows[i][0])
    assert sorted(r.doc_id for r in out) == sorted(first.values())
    assert sum(r.text == rows[5][2] for r in out) == 1

    out = stages["decontamination"](spark, docs, folder).collect()
    clean = [d for d, _, t in rows if not plain_hits(t, [(1, item)], 10)[1]]
    assert sorted(r.doc_id for r in out) == sorted(clean) and not {300, 301, 302} & set(clean)

    packed = stages["best_fit_packing"](spark, docs, folder).collect()
    check_packing(packed, 2048)
    assert {r.doc_id for r in packed} == {d for d, *_ in rows}


def test_whole_pipeline_on_planted_rows(spark, tmp_path):
    docs, item = planted(tmp_path, spark)
    out = {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert not {300, 301, 302} & out and not set(range(100, 108)) & out
    assert set(range(8, 60)) - {7} <= out | {7}


def test_very_long_conversation(spark):
    said = "said " * 300_000
    turns = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", said) for k in range(4)],
                                  "conv_id long, turn int, role string, text string")
    row = chat.formatted(turns).first()
    assert len(row.formatted) > 4 * len(said)
    assert [t for _, t in chat.parsed(row.formatted)] == [said] * 4
    assert [row.formatted[s.start:s.end] for s in row.loss] == [said] * 2
    assert re.search("### user: said", row.formatted[:40])


def test_pipeline_keeps_columns(spark, tmp_path):
    docs, _ = planted(tmp_path, spark)
    wide = docs.withColumns({"hits": F.lit("x"), "own": F.lit(1)})
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, wide, str(tmp_path)).columns == wide.columns, name
