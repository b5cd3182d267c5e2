"""Operators that count, join or deal over the whole corpus, against plain versions."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from firnline.llm import backoff, chat, lines, packing, quality, queries, simhash, topk

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def grouped(rows, value):
    return sorted((repr(k), v) for k, v in collections.Counter(value(r) for r in rows).items())


# Top-k

@pytest.mark.parametrize("shard_rows,block_rows", [(1000, 1000), (40, 7)])
def test_topk_against_all_pairs(spark, shard_rows, block_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(150)]
    rows += [(200 + i, [0.5, 0.5, -0.5, 1.0]) for i in range(60)] + [(200, [0.5, 0.5, -0.5, 1.0])]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (304, [2.0, 2.0]), (None, [1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, score string")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 5, 64, shard_rows, block_rows).drop("query_key").collect()
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(64 * float(np.float32(x))) for x in v] + [0] * (4 - len(v))
    want = []
    for q in whole:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:5]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_topk_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(df, F.lit(True)).count() == 0
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


# Lines

def test_lines_small(documents):
    pages = [(i, f"menu\nown {i}\n\n menu ", "a") for i in range(10)]
    copies = [(100 + i, "copied page\nsecond", "a") for i in range(500)]
    rest = [(700, None, "a"), (701, "", None), (702, "menu", "b"), (703, "menu\nmenu", None), (3, "menu\nown 3\n\n menu ", "a")]
    docs = documents(pages + copies + rest)
    for limit in (0, 100):  # joined on salted hosts, and broadcast
        out = lines.without_boilerplate(docs, broadcast=limit)
        assert out.columns == docs.columns
        got = {(r.doc_id, r.source): r.text for r in out.collect()}
        assert out.count() == docs.count()
        assert got[3, "a"] == "own 3\n" and got[100, "a"] == "copied page\nsecond"
        assert got[700, "a"] is None and got[701, None] == "" and got[702, "b"] == "menu" and got[703, None] == "menu\nmenu"
    assert lines.without_boilerplate(docs.limit(0)).count() == 0


# Language model

def plain_scores(texts, order, alpha):
    docs = [t.split() if t else [] for t in texts]
    grams = lambda d, k: [tuple(d[i: i + k]) for i in range(len(d) - k + 1)]
    totals = {k: collections.Counter(g for d in docs for g in grams(d, k)) for k in range(1, order + 1)}
    size, out = sum(map(len, docs)), []
    for d in docs:
        own = {k: collections.Counter(grams(d, k)) for k in totals}
        count = lambda g: totals[len(g)][g] - own[len(g)][g]
        score = 0.0
        for i in range(len(d)):
            k = min(order, i + 1)
            while k > 1 and count(tuple(d[i - k + 1: i + 1])) <= 0:
                score, k = score + math.log(alpha), k - 1
            g = tuple(d[i - k + 1: i + 1])
            score += math.log(count(g) / count(g[:-1])) if k > 1 else math.log(max(1, count(g)) / max(1, size - len(d)))
        out.append((len(d), round(score, 6)))
    return out


@pytest.mark.parametrize("order,chars", [(1, 10**6), (2, 50), (3, 400)])
def test_backoff_against_dictionaries(documents, order, chars):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "zz", "zz"]
    got = backoff.scored(documents(list(enumerate(texts))), order, 0.4, chars).collect()
    want = plain_scores(texts, order, 0.4)
    assert sorted((r.doc_id, r.n_words, round(r.log_score, 6)) for r in got) == [(i, *w) for i, w in enumerate(want)]


def test_backoff_odd(odd):
    assert backoff.scored(odd).count() == odd.count()
    assert backoff.scored(odd.limit(0)).count() == 0


def test_backoff_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    import re

    texts = [" ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    split = [t.split(" ") if t else [] for t in texts]
    unsplit = [" ".join(w.replace(" ", "_") for w in d) for d in split]
    want = plain_scores(unsplit, backoff.ORDER, backoff.ALPHA)
    got = queries.op5_backoff(spark, SMALL).orderBy("doc_id").collect()
    for r, (n, score) in zip(got, want, strict=True):
        assert r.n_words == n and math.isclose(r.log_score, score, rel_tol=1e-6, abs_tol=1e-4)


# Packing

def check_packing(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def test_sweep_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([1, 7, 16, 64])
        lengths = [min(capacity, int(rng.expovariate(0.15)) + 1) for _ in range(rng.randint(0, 120))]
        steps, opened = packing.sweep(collections.Counter(lengths), capacity)
        assert opened == plain_best_fit(lengths, capacity)
        assert sum(b - a for _, a, b, _, _ in steps) == len(lengths)


@pytest.mark.parametrize("capacity", [8, 2048])
def test_packing_odd(odd, capacity, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    cut = packing.pieces(odd, VOCABULARY, capacity)
    rows = packing.packed(cut, capacity).collect()
    used = check_packing(rows, capacity)
    assert used == plain_best_fit([r.length for r in rows], capacity)
    encode = packing.encoder(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for doc in (1, 2, 4, 7):
        pieces = sorted((r.piece, r.start, r.ids) for r in rows if r.doc_id == doc)
        assert [i for p in pieces for i in p[2]] == [*encode(texts[doc]), 0]
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert all(len(p[2]) == capacity for p in pieces[1:])
    assert sum(r.doc_id == 5 and r.piece == 0 for r in rows) == 2
    assert packing.packed(packing.pieces(odd.limit(0), VOCABULARY)).count() == 0


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(VOCABULARY), packing.encoder(VOCABULARY)
    rng = random.Random(6)
    texts = ["<|endoftext|> a <|endoftext|", "   \n\n  x", " " * 3000, "a" * 5000, "I'll don't 1234 日本語 \U0001F600 é́", "  x\x00"]
    texts += ["".join(rng.choice("ab1 '.\n\té日<|>") for _ in range(200)) for _ in range(500)]
    for t in texts:
        assert encode(t) == plain.encode(t, add_special_tokens=False).ids


def test_packing_query(spark):
    rows = queries.op6_packing(spark, SMALL).collect()
    check_packing(rows, 2048)
    encode = packing.encoder(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    seen = collections.Counter()
    for r in rows:
        ids = [*encode(texts[r.doc_id]), 0][r.start: r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r.doc_id] += r.length
    assert seen == {d: len(encode(t)) + 1 for d, t in texts.items()}


# Chat

def test_chat_round_trip(spark):
    rng = random.Random(7)
    texts = ["", "\\", "\\\\", "### a: b</turn>\n", "\\### Assistant: </turn> ok", "####", "</turn", "é日\U0001F600:"]
    rows = [(c, t, rng.choice(["user", "assistant", "ass:istant\\"]), rng.choice(texts) + rng.choice(texts))
            for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, None, None), (None, None, "user", "first"), (30, 0, "assistant", None), (31, 1, "user", "x"), (31, 1, "user", "x")]
    rows += [(40, t, "assistant", "hot") for t in range(5000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        assert chat.parsed(got[c].formatted) == turns
        assert [chat.unescaped(got[c].formatted[s.start: s.end]) for s in got[c].loss] == [t for r, t in turns if r == "assistant"]
    assert chat.formatted(df.limit(0)).count() == 0


def test_chat_query(spark):
    rows = queries.with_probe(spark.read.parquet(f"{SMALL}/conversations.parquet")).orderBy("conv_id", "turn").collect()
    turns, loss = collections.defaultdict(str), collections.defaultdict(str)
    for r in rows:
        turns[r.conv_id] += f"{r.role}\n{r.text or ''}\n"
        loss[r.conv_id] += (r.text or "") if r.role == "assistant" else ""
    got = queries.op7_chat(spark, SMALL).collect()
    assert {r.conv_id for r in got} == set(turns) and -7 in turns
    for r in got:
        assert r.turns_sha256 == hashlib.sha256(turns[r.conv_id].encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss[r.conv_id]), hashlib.sha256(loss[r.conv_id].encode()).hexdigest())


# SimHash

def plain_print(text, shingle):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(shingle, len(words))
    made = [xxhash.xxh64_intdigest(" ".join(words[i: i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in made) > len(made))


def plain_components(prints, linked):
    root = {d: d for d in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if linked(prints[a], prints[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: top(d) for d in ids}


def test_simhash_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {d: plain_print(t, 3) for d, t in texts.items()}
    want = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    got = queries.op8_simhash(spark, SMALL).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("bits,group", [(2, 10_000), (2, 5), (3, 9), (2, 1)])
def test_trie_join_against_all_pairs(spark, bits, group):
    rng = random.Random(8)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:
        for _ in range(12):
            prints.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits + 2))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(p), i) for i, p in enumerate(sorted(prints))], "print long, label long")
    want = plain_components(dict(enumerate(sorted(prints))), lambda a, b: (a ^ b).bit_count() <= bits)
    found = {r.print: r.label for r in simhash.components(simhash.links(frame.select("print"), bits, group), frame).collect()}
    assert {i: found.get(signed(p), i) for i, p in enumerate(sorted(prints))} == want


def test_long_chain_of_links(spark):
    frame = spark.createDataFrame([(i, 1000 - i) for i in range(300)], "print long, label long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(299)], "a long, b long")
    assert {r.label for r in simhash.components(edges, frame).collect()} == {701}


def test_simhash_odd(odd):
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(odd).collect())
    assert got == [(0, 5), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 5), (6, 5), (7, 7)]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    lone = odd.filter("doc_id is null")
    assert [r.component_id for r in simhash.near_duplicates(lone).collect()] == [None]


def test_hot_trie_nodes_are_cut_deeper(spark):
    """Clusters under one prefix: no group holds more than a few times ``group``, and no link is lost."""
    rng, group = random.Random(9), 20
    prints = sorted({(0xABCDEF << 40) ^ sum(1 << b for b in rng.sample(range(40), rng.randint(0, 3))) for _ in range(600)}
                    | {(0xABCDEF << 40) ^ rng.getrandbits(20) for _ in range(600)} | {rng.getrandbits(63) for _ in range(50)})
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "print long, label long")
    made = simhash.links(frame.select("print"), 2, group)
    want = plain_components(dict(enumerate(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    found = {r.label: r.label for r in frame.collect()}
    for r in simhash.components(made, frame).join(frame.withColumnRenamed("label", "own"), "print").collect():
        found[r.own] = r.label
    assert found == want


def test_one_of_each(spark, odd, documents):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7]
    words = [f"w{i}" for i in range(400)]
    near = [(i, " ".join(words[:i] + ["changed"] + words[i + 1:])) for i in range(20, 320, 5)]
    far = [(500 + i, " ".join(f"v{i}{j}" for j in range(200))) for i in range(10)]
    rows = [(900, " ".join(words)), *near, *far, (600, None), (450, " ".join(words)), (450, " ".join(words)), (None, far[0][1])]
    prints = {i: plain_print(t, 3) for i, (_, t) in enumerate(rows)}
    groups = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    want = sorted(min(rows[i][0] or 1 << 60 for i in groups if groups[i] == g) for g in set(groups.values()))
    assert len(want) < 40  # many of the near copies are within two bits of another
    assert sorted(r.doc_id for r in simhash.one_of_each(documents(rows)).collect()) == want


# Quality

def test_quality_query_learns(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op9_quality(spark, folder).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(p for y, _, p in held if y) / len(good) > 0.98
    assert sum(not p for y, _, p in held if not y) / len(bad) > 0.9


def test_quality_reads_text_alone(spark, odd):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (6, 1), (7, 0), (None, 1)], "doc_id long, quality int")
    weights = quality.fit(odd, labels, "quality", bits=10, shard_rows=2)
    got = odd.withColumn("score", quality.score(odd, weights)).collect()
    assert len(got) == odd.count() and len({r.score for r in got if r.text == "one two three"}) == 1
    none = quality.fit(odd, labels.limit(0), "quality", bits=8)
    assert {r.s for r in odd.select(quality.score(odd, none).alias("s")).collect()} == {0.5}
    assert odd.limit(0).select(quality.score(odd, weights)).count() == 0
