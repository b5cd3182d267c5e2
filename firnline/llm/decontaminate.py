"""Benchmark decontamination: one Aho-Corasick automaton over the test items, one scan of each text.

Texts and items are lower-cased (A-Z only) and split into words. The patterns are the windows of
``window`` consecutive item words (an item of fewer words is one window), written with one blank
around each word. A document is scanned in the same form; the word it stopped at gives the place in
the original text. Documents never move: the scan is a column on their own partitions.

Cases: null or wordless text has no words and no hits; an item without words gives no window; an item
without id marks words but is not listed; repeated rows and equal items count once per item id and
once per document row; extra columns ride along, and a column named like the result is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from firnline.llm.common import per_batch, text_of
from firnline.session import stage

WINDOW = 10
#: Windows held by one automaton (about 60 nodes of 60 bytes each). A larger benchmark is scanned in blocks.
BLOCK_WINDOWS = 20_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HITS = ("struct<n_words:bigint,n_hit:bigint,items:array<bigint>,"
        "runs:array<struct<first:int,last:int>>,spans:array<struct<start:int,end:int>>>")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(pattern, item_id): the distinct windows of the items, words joined with blanks."""
    words = F.regexp_extract_all(F.translate(text_of("text"), UPPER, LOWER), F.lit(WORD), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    patterns = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    return (benchmark.select(F.col("item_id").cast("long").alias("item_id"), words.alias("words"))
            .filter(F.size("words") > 0)
            .select("item_id", F.explode(patterns).alias("pattern")).distinct())


def automaton_of(rows: list[tuple[str, int | None]]) -> ahocorasick.Automaton:
    items: dict[str, list[int]] = defaultdict(list)
    for pattern, item in rows:
        items[pattern].extend([] if item is None else [item])
    made = ahocorasick.Automaton()
    for pattern, found in items.items():
        made.add_word(f" {pattern} ", (pattern.count(" ") + 1, found))
    if items:
        made.make_automaton()
    return made


def scan(text: str, automaton: ahocorasick.Automaton, before: dict | None = None) -> dict:
    """The hit words, spans and items of one text; ``before`` has the runs and items of earlier blocks."""
    folded = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    words = re.findall(WORD, folded)
    runs = [(r["first"], r["last"]) for r in before["runs"]] if before else []
    items = set(before["items"]) if before else set()
    if words and len(automaton):
        ends = None
        for end, (n, found) in automaton.iter(f" {' '.join(words)} "):
            if ends is None:
                ends = {e: i for i, e in enumerate(accumulate(len(w) + 1 for w in words))}
            runs.append((ends[end] - n + 1, ends[end]))
            items.update(found)
    merged: list[list[int]] = []
    for first, last in sorted(runs):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    spans = []
    if merged:
        places = [m.span() for m in re.finditer(WORD, folded)]
        spans = [{"start": places[a][0], "end": places[b][1]} for a, b in merged]
    return {"n_words": len(words), "n_hit": sum(b - a + 1 for a, b in merged), "items": sorted(items),
            "runs": [{"first": a, "last": b} for a, b in merged], "spans": spans}


def with_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, column: str = "hits",
              text: str | Column = "text", block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with ``column``: words, hit words, their runs and spans (code points), and the item ids."""
    spark = docs.sparkSession
    kind = spark.createDataFrame([], f"a {HITS}").schema[0].dataType
    arrow = to_arrow_type(kind)
    patterns = stage(windows(benchmark, window), "windows")
    blocks = max(1, -(-patterns.count() // block))
    out = docs
    for k in range(blocks):
        part = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k) if blocks > 1 else patterns
        sent = spark.sparkContext.broadcast([(r["pattern"], r["item_id"]) for r in part.collect()])

        def make(sent=sent):
            automaton = automaton_of(sent.value)

            def act(x: pa.Array) -> pa.Array:
                return pa.array([scan(r["text"], automaton, r["before"]) for r in x.to_pylist()], arrow)

            return act

        before = F.col(column) if k else F.lit(None).cast(HITS)
        given = F.struct(text_of(text).alias("text"), before.alias("before"))
        out = out.withColumn(column, per_batch(make, HITS)(given))
        if k + 1 < blocks:
            out = stage(out, "scanned")
    return out
