"""Ranked lexical search over classes of equal bags.

A document counts for a set of items only through the words it shares with them and its length factor ``m``.
Texts are therefore cut down to the items' vocabulary, a bag of (term, times) each; documents with one bag and one ``m``
form a class. Rows meet by a hash of both, and what is under one hash is compared in full before it is one class. A class is
scored once for all items, and its members follow by ascending id.

* Vocabulary: the distinct terms of the items, numbered in a stored table. Up to ``BROADCAST_TERMS`` terms it is
  broadcast and every text is counted in place; a larger one meets the texts' distinct terms in a join.
* Of a class only the ``k`` smallest ids can be in an answer, and a window limit drops the others before anything is
  shuffled, so a bag that a third of all documents share is no large group.
* Classes go to shards by their hash, about ``SHARD_ROWS`` rows each; items go in blocks to every shard. A shard
  turns its bags into postings, adds up a block's items and returns ``k`` documents an item.

``score = sum(w * ((1000000000 * tf) div (1000 * tf + 8 * m)))`` over the item's terms, all 64-bit integers but for the
logarithm in ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``; ``m = 10 + (90 * n * N) div L``. N counts documents with a term, L all
terms, n a document's, df the documents that hold the term.

Cases: null and empty texts have no terms and count nowhere; a null id is counted in N, L and df but never returned; every
row is a document, so a repeated row is returned as often as it occurs; equal scores go by ascending id; rows that
repeat an item's id add their terms to it, once each; items with no id or no term have no answer; empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.llm.common import bounded_batches, per_batch, text_of
from firnline.session import stage

K = 10
SHARD_ROWS = 16_384
ITEM_BLOCK = 4_096
#: Terms that every worker may hold in memory, some 50 MB of them.
BROADCAST_TERMS = 500_000
BAG = "struct<n:bigint,vids:array<bigint>,tfs:array<bigint>>"
FOUND = "item_id long, doc_id long, score long"

# Bytes that belong to no term become blanks, A-Z become a-z; all bytes of other characters stay.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split()


def terms(text: str | Column) -> Column:
    """The same as a column of strings."""
    folded = F.translate(text_of(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))


def vocabulary_of(items: DataFrame) -> DataFrame:
    """(term, vid): the items' distinct terms, numbered. Stored, so that the numbers stay."""
    distinct = items.select(F.explode(terms("text")).alias("term")).distinct()
    return stage(distinct.select("term", F.monotonically_increasing_id().alias("vid")), "vocabulary")


def _bags_in_place(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(
        {r["term"].encode("utf-8", "surrogatepass"): r["vid"] for r in vocabulary.toLocalIterator()})

    def make():
        vids = known.value

        def act(texts: pa.Array) -> pa.Array:
            lengths, ids, times, sizes = [], [], [], []
            for text in texts.to_pylist():
                words = terms_of(text)
                bag = sorted((vids[w], c) for w, c in Counter(words).items() if w in vids)
                lengths.append(len(words))
                sizes.append(len(bag))
                ids.extend(v for v, _ in bag)
                times.extend(c for _, c in bag)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            return pa.StructArray.from_arrays(
                [pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], ["n", "vids", "tfs"])

        return act

    return docs.select("doc_id", per_batch(make, BAG)(text_of("text")).alias("bag")).select("doc_id", "bag.*")


def _bags_by_join(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    def make():
        def act(texts: pa.Array) -> pa.Array:
            counted = [Counter(terms_of(t)) for t in texts.to_pylist()]
            return pa.array([{"n": c.total(), "bag": [{"term": w.decode("utf-8", "surrogatepass"), "tf": f}
                                                      for w, f in c.items()]} for c in counted],
                            pa.struct([("n", pa.int64()), ("bag", pa.list_(pa.struct(
                                [("term", pa.string()), ("tf", pa.int64())])))]))

        return act

    kind = "struct<n:bigint,bag:array<struct<term:string,tf:bigint>>>"
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                             per_batch(make, kind)(text_of("text")).alias("c")).select("row", "doc_id", "c.*"), "counted")
    # A row's group is its own distinct terms; a term that many rows hold is split by the join itself.
    bags = (rows.select("row", F.explode("bag").alias("b")).select("row", "b.term", "b.tf").join(vocabulary, "term")
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("vid", "tf"))).alias("bag")))
    none = F.array().cast("array<struct<vid:bigint,tf:bigint>>")
    return (rows.drop("bag").join(bags, "row", "left").withColumn("bag", F.coalesce("bag", none))
            .select("doc_id", "n", F.col("bag.vid").alias("vids"), F.col("bag.tf").alias("tfs")))


def bags(docs: DataFrame, vocabulary: DataFrame, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(doc_id, n, vids, tfs): every row's number of terms and its bag in the vocabulary, by term number."""
    small = vocabulary.count() <= broadcast_terms
    return (_bags_in_place if small else _bags_by_join)(docs, vocabulary)


def _classes(doc_ids: np.ndarray, ms: np.ndarray, vids: np.ndarray, tfs: np.ndarray, ends: np.ndarray):
    """Class of every row, and the first row of every class. Bags are compared byte by byte."""
    known: dict[tuple, int] = {}
    first: list[int] = []
    of = np.empty(len(doc_ids), dtype=np.int64)
    for i in range(len(doc_ids)):
        a, b = ends[i], ends[i + 1]
        key = (int(ms[i]), vids[a:b].tobytes(), tfs[a:b].tobytes())
        of[i] = known.setdefault(key, len(first))
        if of[i] == len(first):
            first.append(i)
    return of, np.array(first, dtype=np.int64)


def _ranked(docs: pa.Table, items: pa.Table, k: int) -> pa.Table:
    """The k best documents of a shard for every item of a block."""
    empty = pa.table({"item_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.int64())})
    if not len(docs) or not len(items):
        return empty
    docs = docs.sort_by("doc_id").combine_chunks()
    doc_ids, ms = docs["doc_id"].to_numpy(), docs["m"].to_numpy()
    bag_vids, bag_tfs = (docs[c].combine_chunks() for c in ("vids", "tfs"))
    vids, tfs = bag_vids.flatten().to_numpy(), bag_tfs.flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(bag_vids.value_lengths().to_numpy())])
    of, first = _classes(doc_ids, ms, vids, tfs, ends)
    members = np.split(doc_ids[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of))[:-1])

    # Postings of the classes: by term, the classes that hold it and what one unit of weight gives there.
    sizes = (ends[1:] - ends[:-1])[first]
    at = np.repeat(ends[first] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    owner = np.repeat(np.arange(len(first)), sizes)
    tf = tfs[at]
    gain = (1_000_000_000 * tf) // (1000 * tf + 8 * ms[first][owner])
    order = np.argsort(vids[at], kind="stable")
    owner, gain = owner[order], gain[order]
    known, starts = np.unique(vids[at][order], return_index=True)
    stops = np.append(starts[1:], len(order))

    least = doc_ids[first]  # rows come by ascending id, so a class's first row has its smallest
    out_items, out_docs, out_scores = [], [], []
    for item in items.to_pylist():
        score = np.zeros(len(first), dtype=np.int64)
        for t in item["terms"]:
            i = np.searchsorted(known, t["vid"])
            if i < len(known) and known[i] == t["vid"]:
                span = slice(starts[i], stops[i])
                score[owner[span]] += t["w"] * gain[span]
        floor = max(1, np.partition(score, -k)[-k]) if len(score) > k else 1
        best = np.flatnonzero(score >= floor)
        # The k best documents are members of the k classes that come first by score and smallest id.
        best = best[np.lexsort((least[best], -score[best]))][:k]
        answers = sorted((-int(score[c]), int(d)) for c in best for d in members[c][:k])[:k]
        out_items += [item["item_id"]] * len(answers)
        out_docs += [d for _, d in answers]
        out_scores += [-s for s, _ in answers]
    return pa.table({"item_id": pa.array(out_items, pa.int64()), "doc_id": pa.array(out_docs, pa.int64()),
                     "score": pa.array(out_scores, pa.int64())})


def ranked(docs: DataFrame, items: DataFrame, k: int = K, broadcast_terms: int = BROADCAST_TERMS,
           shard_rows: int = SHARD_ROWS, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    bounded_batches(docs.sparkSession)
    asked = items.filter(F.col("item_id").isNotNull())
    vocabulary = vocabulary_of(asked)
    counted = stage(bags(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vocabulary, broadcast_terms),
                    "bags")
    facts = counted.agg(F.count_if(F.col("n") > 0).alias("rows"), F.sum("n").alias("terms"),
                        F.count_if((F.size("vids") > 0) & F.col("doc_id").isNotNull()).alias("held")).first()
    holding = counted.select(F.explode("vids").alias("vid")).groupBy("vid").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * facts["rows"] + 2.0)) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
    weighted = vocabulary.join(holding, "vid").select("term", "vid", weight.cast("long").alias("w"))
    held_terms = asked.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms("text")).alias("term")).distinct()
    questions = held_terms.join(weighted, "term").groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("vid", "w"))).alias("terms"))

    blocks = max(1, -(-items.count() // item_block))
    shards = max(1, -(-facts["held"] // shard_rows))
    m = F.expr(f"10L + (90L * n * {facts['rows']}L) div {max(1, facts['terms'] or 0)}L")
    rows = (counted.filter((F.size("vids") > 0) & F.col("doc_id").isNotNull()).withColumn("m", m)
            .withColumn("h", F.xxhash64("m", "vids", "tfs")))
    alike = Window.partitionBy("h", "m", "vids", "tfs").orderBy("doc_id")
    kept = rows.withColumn("place", F.row_number().over(alike)).filter(F.col("place") <= k)
    dealt = kept.select("doc_id", "m", "vids", "tfs", F.pmod("h", F.lit(shards).cast("long")).alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    sent = questions.select("item_id", "terms", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def search(docs_part: pa.Table, items_part: pa.Table) -> pa.Table:
        return _ranked(docs_part, items_part, k)

    found = (dealt.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(search, FOUND))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
