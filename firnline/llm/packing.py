"""Best-fit packing of tokenised documents into sequences of a fixed capacity, in bulk-synchronous sweeps.

Documents become token ids and an end id, and longer ones are cut into full pieces behind a shorter first one. Full pieces are
sequences of their own. For the rest, documents and gaps are range-sorted into classes of one length; the
classes, at most ``capacity`` of each, are all that a sweep has to know. A sweep sends the documents of a class, the
longest class first, to their successor gap (the smallest that is large enough). Where more documents want a gap than
there are, ranks decide: the document of rank k in its class takes the k-th gap of the class; the others go on to
the next gap, or, with none left, open as few sequences as will hold them. Then the gaps are updated and the sweep is
repeated. That is best-fit decreasing, and its outcome is a list of rank intervals whose length depends
on the capacity, not on the number of documents. Spark does what grows: it counts the classes, ranks every piece
inside its class without gathering a class anywhere, and looks each (class, rank) up in the intervals.

Cases: null text is the empty text, one piece of the end id; ties are ranked in any order, which changes which of two
equal pieces goes where, not the packing's size; repeated rows are packed like any other; an empty table gives an
empty result; null ids are carried; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firnline.llm.common import bounded_batches, give_back, text_of, worker_cache
from firnline.session import stage

CAPACITY = 2048
END = 0
#: Rows of a class that one task ranks.
RANKED = 50_000
SPECIAL = "<|endoftext|>"
#: Tokens gathered before a batch of pieces is written.
HELD = 500_000
PIECES = "uid long, doc_id long, piece int, start long, length int, ids array<int>"


def encoder(vocabulary: str):
    """Text to ids, by the vocabulary file's own rules; kept for the life of the worker.

    The ranked form of the vocabulary, if it lies beside the file, gives the same ids several times faster.
    """
    cache = worker_cache()
    if vocabulary not in cache:
        def plain(text: str) -> list[int]:
            key = (vocabulary, "whole")
            if key not in cache:  # read only where it is needed: it takes several times the memory
                from tokenizers import Tokenizer

                cache[key] = Tokenizer.from_file(vocabulary)
            return cache[key].encode(text, add_special_tokens=False).ids

        try:
            import public_tokenizers
            import tiktoken

            with open(vocabulary.removesuffix(".json") + ".tiktoken", "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={SPECIAL: len(ranks)})
            # Long runs of one kind of character can overflow the pattern's stack; they take the plain way.
            cache[vocabulary] = lambda t: fast.encode(t, allowed_special={SPECIAL}) if len(t) < 500_000 else plain(t)
        except (ImportError, OSError):
            cache[vocabulary] = plain
    return cache[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: a row number of its own (uid), its place in the document, and its ids. Stored once."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        uid = TaskContext.get().partitionId() << 40
        schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])

        def batch(rows):
            doc, piece, start, ids = zip(*rows)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + len(rows))), pa.array(doc, pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends), values)],
                schema=schema)

        rows, held = [], 0
        for given in batches:
            for doc, text in zip(given.column(0).to_pylist(), given.column(1)):
                ids = np.array([*encode(text.as_py()), END], dtype=np.int32)
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc, k, a, ids[a:b]))
                held += len(ids)
                if held > HELD:
                    yield batch(rows)
                    uid += len(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)
        del rows, encode
        give_back()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return stage(chosen.mapInArrow(cut, PIECES), "pieces")


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (uid, length) with ``rank``, from 0 inside each length.

    A length is split into parts by a hash; a part's first rank is the sum of the parts before it.
    """
    parts = max(1, total // RANKED)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
              .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("uid"))
    return (dealt.withColumn("inside", inside).join(firsts, ["length", "part"])
            .select("uid", "length", (F.col("first") + F.col("inside") - 1).alias("rank")))


def sweep(classes: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rank intervals (length, first rank, end rank, first sequence, offset) and the number of sequences.

    Sequences of one history are one group: (first sequence, how many), found by their gap.
    """
    gaps: list[int] = []  # sorted sizes of the gaps there are
    groups: dict[int, list[tuple[int, int]]] = {}
    out, opened = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in groups:
                bisect.insort(gaps, gap)
                groups[gap] = []
            groups[gap].append((first, count))

    for length in sorted(classes, reverse=True):
        rank, end = 0, classes[length]
        while rank < end:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                count = -(-(end - rank) // (capacity // length))
                put(capacity, opened, count)
                opened += count
                continue
            gap = gaps[at]
            first, count = groups[gap].pop()
            if not groups[gap]:
                del groups[gap]
                gaps.pop(at)
            taken = min(count, end - rank)
            out.append((length, rank, rank + taken, first, capacity - gap))
            put(gap - length, first, taken)
            put(gap, first + taken, count - taken)
            rank += taken
    return out, opened


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) for the stored pieces ``cut``: full ones first, then the packed rest."""
    spark = cut.sparkSession
    # At most ``capacity`` rows, whatever the input.
    classes = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(classes.values())
    numbered = ranked(cut.select("uid", "length"), total)
    found, _ = sweep(classes, capacity)
    # One array of intervals per length: bounded by the capacity, so it may be sent to every task.
    per_length: dict[int, list] = {}
    for length, a, b, sequence, offset in found:
        per_length.setdefault(length, []).append((a, b, sequence, offset))
    rows = [(length, *interval) for length, got in per_length.items() for interval in got]
    table = spark.createDataFrame(rows, "length int, low long, high long, first long, offset long") if rows else \
        spark.createDataFrame([], "length int, low long, high long, first long, offset long")
    by_length = table.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("low", "high", "first", "offset"))).alias("steps"))
    hit = F.element_at(F.filter("steps", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"])), 1)
    return (numbered.join(F.broadcast(by_length), "length").withColumn("hit", hit)
            .select("uid", (F.col("hit.first") + F.col("rank") - F.col("hit.low")).alias("sequence_id"),
                    F.col("hit.offset").alias("offset")))


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset; columns that are not asked for are not read."""
    return cut.join(place(cut, capacity), "uid").drop("uid")
