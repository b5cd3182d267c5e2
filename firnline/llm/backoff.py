"""LM scoring: stupid-backoff scores from n-gram counts over the whole corpus.

The score of a word is count(n-gram) / count(context) for the longest n-gram that occurs, times ``alpha`` for each
order given up; below a unigram that never occurs stands one occurrence. A document's own n-grams are taken off all
counts, so that a text isn't likely just because it was counted; unseen n-grams then back off as in held-out text.

The relations are held in packed form: an n-gram is a 56-bit hash, and what is shuffled are sorted arrays of distinct
hashes with their counts, not a row per n-gram. Documents are dealt into batches by a hash. Each batch explodes its
n-grams and sends, for each hash range, its distinct ones with their counts: so a frequent n-gram is one entry per
batch. A range adds up its entries, which makes it one partition of the count table, and answers each
batch with what the others counted, mostly nothing. Each batch then sums the logarithms per document. Batches and ranges follow the corpus and stay near ``batch_chars``.

Cases: null and wordless texts have no words and score 0; repeated rows are documents of their own; an empty table
gives an empty result; null ids are carried; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import text_of
from firnline.session import stage

ORDER = 3
ALPHA = 0.4
BATCH_CHARS = 8_000_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bits of an n-gram's key; two different ones share a key once in 2 ** KEY_BITS / (n-grams of the corpus).
KEY_BITS = 56


class Words(dict):
    """Hash of each word seen, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def grams(texts, order: int, words: Words) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of a batch of texts, word after word: the keys of the uni-, bi-, ... grams that end there, the number of the text
    each word is in, and its place in it. A gram of order k counts only from place k - 1 on."""
    found = [WORD.findall(t) for t in texts]
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    one = np.fromiter(map(words.__getitem__, itertools.chain.from_iterable(found)), dtype=np.uint64, count=int(sizes.sum()))
    doc = np.repeat(np.arange(len(found), dtype=np.int32), sizes)
    place = np.arange(len(one)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, further = [scrambled(one)], scrambled(one + MIX)
    for k in range(1, order):
        longer = np.zeros_like(one)
        longer[1:] = scrambled(out[-1][:-1] * np.uint64(2 * k + 1) + further[1:])
        out.append(longer)
    return [g >> np.uint64(64 - KEY_BITS) for g in out], doc, place


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal rows begins in sorted columns."""
    if not len(columns[0]):
        return np.empty(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def packed(sorted_values: np.ndarray) -> bytes:
    """Differences of sorted hashes, byte by byte, which the shuffle's compression can shorten."""
    return np.diff(sorted_values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1),
                     dtype=np.uint64)


def packed_counts(counts: np.ndarray, usual: int) -> bytes:
    """Counts of which most are ``usual``: their number, a bit for each that isn't, and those as numbers of eight bytes."""
    other = counts != usual
    return (np.array([len(counts)], "<u8").tobytes() + np.packbits(other).tobytes()
            + counts[other].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked_counts(data: bytes, usual: int) -> np.ndarray:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    upto = 8 + (n + 7) // 8
    counts = np.full(n, usual, dtype=np.int64)
    counts[np.unpackbits(np.frombuffer(data[8:upto], np.uint8), count=n).astype(bool)] = np.ascontiguousarray(
        np.frombuffer(data[upto:], np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
    return counts


def scored(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) per document, natural logarithms."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    chars = rows.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    batches = max(1, -(-chars // batch_chars))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))
    bounds = np.array([k * (1 << KEY_BITS) // batches for k in range(batches)], dtype=np.uint64)

    def exploded(group: pa.Table):
        """All n-grams of a batch in one array, the orders one after the other, and the word each ends at."""
        keys, doc, place = grams((t.as_py() for t in group["text"]), order, Words())
        ends = [np.flatnonzero(place >= k) for k in range(order)]
        return np.concatenate([g[e] for g, e in zip(keys, ends)]), ends, doc, place

    def ask(group: pa.Table) -> pa.Table:
        ordered = np.sort(exploded(group)[0])
        begin = runs(ordered)
        keys, counts = ordered[begin], np.diff(begin, append=len(ordered))
        cuts = np.append(np.searchsorted(keys, bounds), len(keys))
        parts = [k for k in range(batches) if cuts[k] < cuts[k + 1]]
        return pa.table({
            "part": pa.array(parts, pa.int32()), "batch": pa.array([group["batch"][0].as_py()] * len(parts), pa.int32()),
            "keys": pa.array([packed(keys[cuts[k]: cuts[k + 1]]) for k in parts], pa.binary()),
            "counts": pa.array([packed_counts(counts[cuts[k]: cuts[k + 1]], 1) for k in parts], pa.binary())})

    def answer(group: pa.Table) -> pa.Table:
        asked = [unpacked(x) for x in group["keys"].to_pylist()]
        counts = np.concatenate([unpacked_counts(x, 1) for x in group["counts"].to_pylist()])
        keys = np.concatenate(asked)
        # Sorted pieces one after the other: a stable sort merges them.
        by_key = np.argsort(keys, kind="stable")
        begin = runs(keys[by_key])
        totals = np.add.reduceat(counts[by_key], begin)
        others = np.empty(len(keys), dtype=np.int64)
        others[by_key] = np.repeat(totals, np.diff(begin, append=len(keys)))
        others -= counts
        ends = np.cumsum([len(x) for x in asked])
        return pa.table({
            "part": group["part"], "batch": group["batch"],
            "others": pa.array([packed_counts(others[b - len(x): b], 0) for x, b in zip(asked, ends)], pa.binary())})

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("doc_id", pa.int64()), ("n_words", pa.int64()),
                                                             ("log_part", pa.float64()), ("n_single", pa.int64()))})
        keys, ends, doc, place = exploded(group)
        by_key = np.argsort(keys, kind="stable")
        ordered = keys[by_key]
        begin = runs(ordered)
        sizes = np.diff(begin, append=len(ordered))
        answers = answers.sort_by("part")
        others = (np.concatenate([unpacked_counts(x, 0) for x in answers["others"].to_pylist()])
                  if answers.num_rows else np.empty(0, np.int64))
        if len(others) != len(begin):
            raise ValueError(f"{len(others)} counts for {len(begin)} n-grams")
        # A document's own occurrences of an n-gram stand together, since the sort keeps their order.
        mine = runs(ordered, np.concatenate([doc[e] for e in ends])[by_key])
        left = np.empty(len(keys), dtype=np.int64)
        left[by_key] = np.repeat(others + sizes, sizes) - np.repeat(np.diff(mine, append=len(ordered)), np.diff(mine, append=len(ordered)))
        counts, at = [], 0
        for e in ends:  # by the word the n-gram ends at
            of_order = np.zeros(len(doc), dtype=np.int64)
            of_order[e] = left[at: at + len(e)]
            counts.append(of_order)
            at += len(e)
        value, lost, waiting = np.zeros(len(doc)), np.zeros(len(doc)), np.ones(len(doc), dtype=bool)
        for k in range(order, 1, -1):
            reaches = place >= k - 1
            spots = np.flatnonzero(waiting & reaches & (counts[k - 1] > 0))
            value[spots] = np.log(counts[k - 1][spots] / counts[k - 2][spots - 1])
            waiting[spots] = False
            lost += waiting & reaches
        value[waiting] = np.log(np.maximum(counts[0][waiting], 1))
        rows = group.num_rows
        part = np.bincount(doc, value + lost * math.log(alpha), rows)
        return pa.table({"doc_id": group["doc_id"].cast(pa.int64()), "n_words": pa.array(np.bincount(doc, minlength=rows), pa.int64()),
                         "log_part": pa.array(part, pa.float64()),
                         "n_single": pa.array(np.bincount(doc[waiting], minlength=rows), pa.int64())})

    answers = (dealt.groupBy("batch").applyInArrow(ask, "part int, batch int, keys binary, counts binary")
               .groupBy("part").applyInArrow(answer, "part int, batch int, others binary"))
    parts = stage(dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
                  .applyInArrow(score, "doc_id long, n_words long, log_part double, n_single long"), "scored")
    total = parts.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    others = F.greatest(F.lit(total) - F.col("n_words"), F.lit(1))
    log_score = F.col("log_part") - F.col("n_single") * F.log(others.cast("double"))
    return parts.select("doc_id", "n_words", log_score.alias("log_score"),
                        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).otherwise(F.lit(0.0))
                        .alias("mean_log_score"))
