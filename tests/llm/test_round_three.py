"""Whitening, language identification and ranked lexical search against plain versions."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firnline.llm import language, lexical, whitening
from firnline.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.01"


# --- whitening -----------------------------------------------------------------------------------------------

def plain_covariance(rows):
    x = np.floor(1024 * np.array(rows, dtype=float)) + 100_000
    centred = x - x.mean(axis=0)
    return x, centred, centred.T @ centred / len(x)


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if r is None else [None if c is None else float(c) for c in r], "x", 3)
                                  for i, r in rows], T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("whitened", T.StringType()), T.StructField("component", T.IntegerType())]))


@pytest.mark.parametrize("make", [
    lambda g: g.standard_normal((400, 24)),
    lambda g: g.standard_normal((300, 24)) * np.logspace(0, -9, 24),
    lambda g: g.standard_normal((6, 24)),
    lambda g: np.repeat(np.eye(10), 3, axis=0),
    lambda g: np.hstack([g.standard_normal((200, 5))] * 2 + [np.ones((200, 3))]),
    lambda g: 4 * g.standard_normal((5, 24))[g.integers(0, 5, 500)] + 0.01 * g.standard_normal((500, 24)),
    lambda g: np.vstack([np.eye(16), -np.eye(16)]),
])
def test_solver_is_accurate(make):
    rows = make(np.random.default_rng(4))
    centred = rows - rows.mean(axis=0)
    r = np.linalg.qr(centred, mode="r")
    r = np.vstack([r, np.zeros((max(0, rows.shape[1] - len(r)), rows.shape[1]))])
    model = whitening.solved(r, len(rows), (0,) * rows.shape[1], 8)
    exact = np.linalg.svd(centred, compute_uv=False)[:len(model.values)] ** 2 / len(rows)
    assert np.abs(model.values / exact - 1).max() < 1e-10
    v = centred.T @ centred / len(rows)
    assert np.abs(v @ model.vectors - model.vectors * model.values).max() < 1e-13 * exact[0]
    assert np.abs(model.vectors.T @ model.vectors - np.eye(len(model.values))).max() < 1e-12
    assert abs(model.trace / np.trace(v) - 1) < 1e-12


def test_dqds_splits_zeros_and_grading():
    rng = np.random.default_rng(1)
    for a, b in [(np.array([3.0, 0.0, 2.0]), np.array([1.0, 1.0])), (np.logspace(0, -12, 20), np.logspace(0, -12, 20)[1:]),
                 (np.ones(7), np.zeros(6)), (rng.standard_normal(30), rng.standard_normal(29)), (np.zeros(3), np.zeros(2))]:
        exact = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
        assert np.allclose(np.sqrt(whitening.dqds(a, b)), exact, rtol=1e-12, atol=1e-14 * max(1, exact[0]))


def test_whitening_query(spark):
    found = QUERIES["op11_whitening"](spark, SMALL).toPandas()
    stored = duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet' order by vec_id").fetchall()
    x, centred, v = plain_covariance([r[1] for r in stored])
    values, axes = (m[..., ::-1] for m in np.linalg.eigh(v))
    n, whole = len(x), x.astype(object).astype(int)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    assert len(found) == 8 * n and (found.n == n).all() and found.identity_error.max() < 1e-10
    for k in range(8):
        of = found[found.component == k + 1].sort_values("vec_id")
        assert of.deviation.tolist() == deviation.tolist()
        plain = centred @ axes[:, k] / math.sqrt(values[k])
        ours = of.whitened.to_numpy()
        assert np.abs(ours * np.sign(ours @ plain) - plain).max() < 1e-9
        assert np.abs(of.explained / (values[k] / np.trace(v)) - 1).max() < 1e-10


def test_whitening_odd_rows(spark):
    g = np.random.default_rng(2)
    good = [(i, g.standard_normal(4)) for i in range(40)]
    odd = [(50, None), (51, [1, None, 2, 3]), (52, [1, float("nan"), 0, 0]), (53, [float("inf"), 0, 0, 0]), (54, []),
           (55, [1, 2]), (56, [1e20, 0, 0, 0])]
    table = vectors(spark, good + odd + [good[0], (None, good[1][1])])
    rows = whitening.whitened(table).collect()
    kept = [np.float32(r) for _, r in good] + [np.float32(good[0][1]), np.float32(good[1][1])]
    _, _, v = plain_covariance(kept)
    assert len(rows) == 42 * 4 and {r.n for r in rows} == {42} and sum(r.vec_id is None for r in rows) == 4
    first = {r.component: r.explained for r in rows}
    assert np.allclose([first[k] for k in range(1, 5)], np.linalg.eigvalsh(v)[::-1] / np.trace(v))
    assert len({(r.component, r.whitened) for r in rows if r.vec_id == 0}) == 4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3])
def test_whitening_nothing_to_do(spark, rows):
    assert whitening.whitened(vectors(spark, rows)).count() == 0


def test_triangles_fold_in_rounds(spark):
    rows = whitening.whole_numbers(vectors(spark, [(i, r) for i, r in enumerate(np.random.default_rng(3).standard_normal((90, 3)))])
                                   .repartition(23))
    n, sums = whitening.totals(rows)
    by_two, at_once = (whitening.triangle(rows, n, sums, fan) for fan in (2, 64))
    assert np.allclose(by_two.T @ by_two, at_once.T @ at_once, rtol=1e-12)


def test_exact_beyond_64_bits():
    x = np.array([[1 << 40, -(1 << 40)], [5, 7]])
    sums = np.array([(1 << 40) + 5, 7 - (1 << 40)], dtype=object)
    rows = 1 << 35
    plain = [sum((rows * int(c) - int(s)) ** 2 for c, s in zip(r, sums)) for r in x]
    assert whitening.square_sums(whitening.exact_deviations(x, rows, sums)) == plain


# --- language ------------------------------------------------------------------------------------------------

def test_gradient_is_the_slope():
    net = language.initial(["a", "b", "c"], 4, 0, np.float64)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    live = (np.arange(7)[:, None] < np.array([7, 5, 7, 3, 6])).astype(float)
    label = np.array([0, 1, 2, 1, 0])
    _, grads = language.loss_and_gradient(net, x, live, label)
    for name, values in net.p.items():
        for i in rng.choice(values.size, min(6, values.size), replace=False):
            at = np.unravel_index(i, values.shape)
            old, step, sides = values[at], 1e-6, []
            for sign in (1, -1):
                values[at] = old + sign * step
                sides.append(language.loss_and_gradient(net, x, live, label)[0])
            values[at] = old
            assert abs((sides[0] - sides[1]) / (2 * step) - grads[name][at]) < 1e-8, name


def plain_scores(net, raw, window):
    """Byte after byte, with the usual formulas."""
    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    pieces = -(-len(raw) // window)
    size = -(-len(raw) // pieces)
    total = np.zeros(len(net.languages))
    for a in range(0, len(raw), size):
        piece, states = raw[a:a + size], {}
        for d in "01":
            e, u, c = (net.p[k + d].astype(float) for k in "euc")
            n, h = len(u), np.zeros(len(u))
            for t in range(len(piece)) if d == "0" else reversed(range(len(piece))):
                given, state = e[piece[t]], h @ u
                z, r = (sigmoid(given[i * n:(i + 1) * n] + state[i * n:(i + 1) * n]) for i in (0, 1))
                h = z * h + (1 - z) * np.tanh(given[2 * n:] + r * (state[2 * n:] + c))
                states[d, t] = h
        for t in range(len(piece)):
            s = states["0", t] @ net.p["w0"] + states["1", t] @ net.p["w1"] + net.p["bias"]
            total += np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    return total / len(raw)


def test_scores_against_a_plain_pass():
    net = language.initial(["a", "b", "c"], 5, 3)
    texts = [b"x", b"", "ä long and winding text ".encode() * 4, b"0123456789abcdef", bytes(range(256))]
    lengths = np.array([len(t) for t in texts])
    made = language.document_scores(net, np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths,
                                    window=16, batch=3)
    assert not made[1].any()
    for text, ours in zip(texts, made):
        if text:
            assert np.allclose(ours, plain_scores(net, text, 16), atol=1e-5)


def test_language_query(spark):
    found = {r.doc_id: r for r in QUERIES["op12_language"](spark, SMALL).collect()}
    stored = duckdb.sql(f"select doc_id, lang, text from '{SMALL}/documents.parquet'").fetchall()
    assert len(found) == len(stored)
    held = [(r[1], found[r[0]].lang_pred) for r in stored if found[r[0]].held_out]
    assert all(found[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in stored)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert sum(a == b for a, b in held) > 0.97 * len(held)


def test_language_odd_rows(spark, odd, documents):
    spanish, german = "el perro come en la casa ñ ", "der Hund frißt über dem Haus "
    rows = [(i, t * 9, lang) for i, (t, lang) in enumerate([(spanish, "es"), (german, "de")] * 20)]
    learned = (spark.createDataFrame(rows, "doc_id long, text string, lang string")
               .unionByName(odd.select("doc_id", "text", "lang")))
    net = language.fit(learned, steps=40)
    assert net.languages == ["de", "es"]
    asked = documents([(1, None), (2, ""), (3, "12 !? \n"), (4, german * 20_000), (5, spanish), (5, spanish), (None, german)])
    told = [(r.doc_id, r.told.lang, r.told.score) for r in
            asked.select("doc_id", language.predicted(asked, net).alias("told")).collect()]
    assert [(i, lang) for i, lang, _ in told] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "es"), (5, "es"),
                                                  (None, "de")]
    assert told[4] == told[5] and all(0 <= s <= 1 for *_, s in told)


def test_language_without_labels(spark, odd):
    assert language.fit(odd) is None
    assert {r[0] for r in odd.select(language.predicted(odd, None)["lang"]).collect()} == {"und"}
    one = spark.createDataFrame([(1, "ab", "x")], "doc_id long, text string, lang string")
    net = language.fit(one, steps=2)
    assert one.select(language.predicted(one, net).alias("t")).first().t == ("x", 1.0)
    assert one.limit(0).select(language.predicted(one, net).alias("t")).count() == 0


# --- ranked lexical search -----------------------------------------------------------------------------------

def plain_ranking(docs, items, k=10):
    def split(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)

    bags = [(d, Counter(split(t))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(split(t))
    out = []
    for i, words in asked.items():
        scored = []
        for d, b in bags:
            if d is None or not b:
                continue
            m = 10 + (90 * b.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * b[w]) // (1000 * b[w] + 8 * m))
                    for w in words if w in b)
            if s > 0:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, rank int")


@pytest.mark.parametrize("options", [{}, {"broadcast_terms": 0}, {"shard_rows": 3, "item_block": 2}, {"k": 2}])
def test_ranking_against_a_plain_one(spark, documents, options):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)] + ["É", "日本", "a1"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 12)))) for i in rng.permutation(60)]
    docs += [(100 + i, "w1, w2! W1 alike") for i in range(30)] + [(3, docs[0][1]), (None, "w1 w5"), (900, None), (901, " -- "),
                                                                   (902, "w3 " * 5000)]
    items = [(1, "w1 W2 É"), (2, "日本; a1 w5 w5"), (2, "w7"), (3, None), (4, "nowhere"), (None, "w1"), (5, " ".join(words))]
    made = lexical.ranked(documents(docs), benchmark(spark, items), **options)
    assert made.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, made.collect())) == plain_ranking(docs, items, options.get("k", 10))


def test_ranking_empty(spark, documents, odd):
    none = benchmark(spark, [])
    assert lexical.ranked(odd, none).count() == 0
    assert lexical.ranked(documents([]), benchmark(spark, [(1, "one")])).count() == 0


def test_ranking_same_hash_is_compared():
    ends = np.array([0, 2, 4, 6, 8])
    of, first = lexical._classes(np.arange(4), np.array([5, 5, 6, 5]), np.array([1, 2] * 4), np.array([1, 1, 1, 2, 1, 1, 1, 1]), ends)
    assert of.tolist() == [0, 1, 2, 0] and first.tolist() == [0, 1, 2]


def test_ranking_twin(spark):
    from compare import database, difference

    assert difference(QUERIES["op13_lexical"](spark, SMALL), database(SMALL), SQL["op13_lexical"]) is None


def test_hot_class_is_cut_before_the_shuffle(spark, documents):
    docs = documents([(i, "one two three") for i in range(500)] + [(1000, "two")])
    made = lexical.ranked(docs, benchmark(spark, [(1, "one two")]))
    assert [r.doc_id for r in made.orderBy("rank").collect()] == list(range(10))
    assert "WindowGroupLimit" in made._jdf.queryExecution().executedPlan().toString()
    assert made.filter(F.col("score") <= 0).count() == 0
