"""SimHash near-duplicates: fingerprints, and a self-join of a binary trie of them.

A fingerprint bit is set if it is set in over half the XXH64 values (seed 42) of the text's word shingles.
Equal fingerprints are one entry, so groups of copies count once. The sorted distinct fingerprints are a binary
trie: a node is a range that shares a prefix. The join walks node pairs together from the root, adds up the
differing bits of their prefixes, and prunes a pair when they exceed the budget; small ranges are compared directly.

The top levels are walked while the work is dealt out: a fingerprint is sent to every pair of top nodes within the
budget that holds its own node, and each pair of nodes is one group. The first cut follows the number of fingerprints;
nodes that hold more than ``HOT`` times ``group`` of them are cut ``STEP`` levels deeper, with the pairs they are in, until
none is left, so that a cluster under one prefix is no single group. Within two bits of one lie at most
64 * 63 / 2 + 64 distinct fingerprints; at more bits nearly all pairs of a group of near copies are close. Pairs are
therefore read in chunks and dropped: a task holds one chunk and a forest, and each group returns the forest.

Components come from rounds of smallest neighbours and jumps over links of links, stored after each round.

Cases: null and wordless texts have fingerprint zero and link with each other; fewer words than a shingle are one
shingle; repeated rows share their fingerprint; null ids are carried and never name a component with other ids
in it; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import per_batch, text_of
from firnline.session import release, stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE, BITS = 3, 2
GROUP = 16_000
#: Node pairs compared at once, which bounds the memory of a task.
CHUNK = 1 << 18
#: A node above HOT groups is cut this many levels deeper.
HOT, STEP = 4, 6
NO_ID = (1 << 63) - 1


def fingerprint_of(text: str, shingle: int) -> int:
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
    if not words:
        return 0
    parts = [w.encode("utf-8", "surrogatepass") for w in words]
    joined, n = b" ".join(parts), len(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1:].tolist())),
                         dtype="<u8", count=n - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        block = hashes[at: at + 8192]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column = "text", shingle: int = SHINGLE) -> Column:
    """Column: the 64-bit fingerprint as a signed long."""
    def make():
        def act(texts: pa.Array) -> pa.Array:
            made = np.fromiter((fingerprint_of(t, shingle) for t in texts.to_pylist()), dtype=np.uint64, count=len(texts))
            return pa.array(made.view(np.int64))

        return act

    return per_batch(make, "long")(text_of(text))


def fingerprint_text(c: str) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def trie_pairs(a: np.ndarray, b: np.ndarray, same: bool, bits: int, leaf: int = 24):
    """Index pairs (i, j) of the sorted arrays within ``bits``.

    A breadth of node pairs is walked level by level: each side's range is cut where the next bit turns.
    Breadths beyond ``CHUNK`` pairs are walked in parts, one after the other.
    """
    waiting = [(0, np.array([[0, len(a), 0, len(b), 0]], dtype=np.int64))]
    while waiting:
        depth, nodes = waiting.pop()
        if len(nodes) > CHUNK:
            half = len(nodes) // 2
            waiting += [(depth, nodes[:half]), (depth, nodes[half:])]
            continue
        sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        small = (sizes <= leaf) if depth < 64 else np.ones(len(nodes), dtype=bool)
        done, nodes = nodes[small], nodes[~small]
        while len(done):  # compare the ranges of small pairs directly
            size = (done[:, 1] - done[:, 0]) * (done[:, 3] - done[:, 2])
            upto = max(1, int(np.searchsorted(np.cumsum(size), CHUNK)))
            part, size, done = done[:upto], size[:upto], done[upto:]
            which = np.repeat(np.arange(len(part)), size)
            k = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            width = (part[:, 3] - part[:, 2])[which]
            i, j = part[which, 0] + k // width, part[which, 2] + k % width
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            x = a[i] ^ b[j]
            keep = np.bitwise_count(x) <= bits
            yield i[keep], j[keep]
        if not len(nodes):
            continue
        bit = np.uint64(63 - depth)

        def cut(values, lo, hi):
            """Where the bit turns to one inside each range of the sorted values."""
            first = values[lo]
            mark = ((first >> bit) | np.uint64(1)) << bit
            return np.clip(np.searchsorted(values, mark), lo, hi)

        ca, cb = cut(a, nodes[:, 0], nodes[:, 1]), cut(b, nodes[:, 2], nodes[:, 3])
        children = []
        for left_a, left_b in ((1, 1), (0, 0), (1, 0), (0, 1)):
            child = np.column_stack([
                nodes[:, 0] if left_a else ca, ca if left_a else nodes[:, 1],
                nodes[:, 2] if left_b else cb, cb if left_b else nodes[:, 3],
                nodes[:, 4] + (left_a != left_b)])
            keep = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 4] <= bits)
            if same:  # of a node with itself each pair of halves once
                keep &= (child[:, 0] <= child[:, 2]) & (child[:, 0] < child[:, 3])
            children.append(child[keep])
        waiting.append((depth + 1, np.concatenate(children)))


def forest(n: int, pairs, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs a spanning forest, at most n - 1 of them; of each chunk of pairs the closest come first.

    Chunks are dropped as they are read: what is held is one chunk, the forest and each entry's root.
    """
    root = np.arange(n)
    kept_i, kept_j = [], []
    for i, j in pairs:
        if not len(i):
            continue
        while True:  # roots of roots, until each entry names its own
            above = root[root]
            if np.array_equal(above, root):
                break
            root = above
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        order = np.argsort(np.bitwise_count(values[i] ^ values[j]), kind="stable")
        for p, q in zip(i[order].tolist(), j[order].tolist()):
            x, y = p, q
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[max(x, y)] = min(x, y)
                kept_i.append(p)
                kept_j.append(q)
    return np.array(kept_i, dtype=np.int64), np.array(kept_j, dtype=np.int64)


def masks(width: int, budget: int) -> list[int]:
    out = [0]
    for _ in range(budget):
        out = sorted({m | 1 << b for m in out for b in range(width)} | set(out))
    return out


def deeper(rows: DataFrame, depth: int, step: int, bits: int) -> DataFrame:
    """(print, flip, own, node) at ``depth + step`` levels, from (print, flip) at ``depth``.

    A pair of nodes is named by its lower prefix (node) and the bits flipped between the two; a fingerprint is in the
    pair of its own node and that node flipped.
    """
    every = F.explode(F.array(*[F.lit(m).cast("long") for m in masks(step, min(step, bits))]))
    own = F.shiftrightunsigned("print", 64 - depth - step) if depth + step else F.lit(0).cast("long")
    return (rows.select("print", "flip", every.alias("mask"))
            .filter(F.bit_count("flip") + F.bit_count("mask") <= bits)
            .select("print", F.shiftleft("flip", step).bitwiseOR(F.col("mask")).alias("flip"), own.alias("own"))
            .withColumn("node", F.least("own", F.col("own").bitwiseXOR(F.col("flip")))))


def links(prints: DataFrame, bits: int = BITS, group: int = GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``print``) within ``bits``, a forest per group."""
    depth = min(64, max(0, math.ceil(math.log2(max(1, prints.count()) / group))))
    rows = deeper(prints.select("print", F.lit(0).cast("long").alias("flip")), 0, depth, bits)
    settled = []
    while True:
        # Every fingerprint of a node is in the pair of that node with itself, once.
        hot = stage(rows.filter(F.col("flip") == 0).groupBy("own").agg(F.count("*").alias("n"))
                    .filter(F.col("n") > HOT * group).select("own"), "hot")
        if depth == 64 or hot.isEmpty():
            settled.append(rows.withColumn("depth", F.lit(depth)))
            break
        marked = (rows.withColumn("other", F.col("own").bitwiseXOR(F.col("flip")))
                  .join(hot.withColumn("here", F.lit(True)), "own", "left")
                  .join(hot.select(F.col("own").alias("other"), F.lit(True).alias("there")), "other", "left"))
        cool = F.col("here").isNull() & F.col("there").isNull()
        settled.append(marked.filter(cool).select("print", "flip", "own", "node", F.lit(depth).alias("depth")))
        step = min(STEP, 64 - depth)
        rows = stage(deeper(marked.filter(~cool), depth, step, bits), "deeper")
        depth += step
    dealt = settled[0]
    for part in settled[1:]:
        dealt = dealt.unionByName(part)

    def join(rows: pa.Table) -> pa.Table:
        flip, node, levels = (rows[c][0].as_py() for c in ("flip", "node", "depth"))
        values = np.sort(rows["print"].to_numpy().view(np.uint64))
        if flip:
            here = values >> np.uint64(64 - levels) == np.uint64(node & (1 << 64) - 1)
            a, b = values[here], values[~here]
            values = np.concatenate([a, b])
            pairs = ((i, j + len(a)) for i, j in trie_pairs(a, b, False, bits))
        else:
            pairs = trie_pairs(values, values, True, bits)
        i, j = forest(len(values), pairs, values)
        return pa.table({"a": pa.array(values[i].view(np.int64)), "b": pa.array(values[j].view(np.int64))})

    return (dealt.select("print", "flip", "node", "depth").groupBy("depth", "flip", "node").applyInArrow(join, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(print, label, owner): the smallest ``label`` (long) each node of (print, label) can reach over (a, b), and whose it is.

    Nodes without a link are left out. Each round every node takes the smallest label among its neighbours and
    itself, and the linked nodes are then relinked to the node that gave it (a jump), until nothing changes.
    """
    both = stage(edges.union(edges.select("b", "a")).distinct(), "edges")
    linked = both.select(F.col("a").alias("node")).distinct()
    state = held = stage(linked.join(nodes.select(F.col("print").alias("node"), F.struct("label", "print").alias("best")), "node"),
                  "labels")
    while True:
        # The best entry a node knows names the node it came from: its neighbours', then that node's own.
        near = (both.join(state.select(F.col("node").alias("b"), "best"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("best").alias("near")))
        stepped = (state.join(near, "node", "left")
                   .select("node", F.least("best", F.coalesce("near", "best")).alias("step"), "best"))
        jumped = (stepped.join(state.select(F.col("node").alias("via"), F.col("best").alias("far")),
                               F.col("step.print") == F.col("via"), "left")
                  .select("node", F.least("step", F.coalesce("far", "step")).alias("best"),
                          (F.least("step", F.coalesce("far", "step")) != F.col("best")).alias("changed")))
        written = stage(jumped, "labels")
        release(held)  # the round before is done with
        held, state = written, written.drop("changed")
        if written.filter("changed").isEmpty():
            return state.select(F.col("node").alias("print"), F.col("best.label").alias("label"),
                                F.col("best.print").alias("owner"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, print, component_id): the smallest doc_id that links of close fingerprints reach."""
    made = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint("text", shingle).alias("print")),
                 "fingerprints")
    firsts = stage(made.groupBy("print").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("label")), "firsts")
    found = components(links(firsts, bits), firsts)
    per_print = firsts.join(found.select("print", F.col("label").alias("reached")), "print", "left").select(
        "print", F.nullif(F.coalesce("reached", "label"), F.lit(NO_ID)).alias("component_id"))
    # One row per fingerprint on the right: a hot fingerprint's rows can be split by the engine.
    return made.join(per_print, "print", "left").select("doc_id", "print", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: the smallest id, of rows equal in that any one.

    Rows with null ids come after all others.
    """
    own = "__firnline_"
    keyed = docs.withColumns({own + "print": fingerprint("text", shingle),
                              own + "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                              own + "row": F.monotonically_increasing_id()})
    keyed = stage(keyed, "keyed")
    firsts = stage(keyed.groupBy(F.col(own + "print").alias("print"))
                   .agg(F.min(F.struct(own + "id", own + "row")).alias("first"), F.count("*").alias("rows")), "firsts")
    nodes = firsts.select("print", F.col(f"first.{own}id").alias("label"))
    found = components(links(nodes.select("print"), bits), nodes).select("print", "owner")
    # Only fingerprints that are repeated or linked decide anything: for each the row that stays, or none.
    marks = stage(firsts.join(found, "print", "left").filter((F.col("rows") > 1) | F.col("owner").isNotNull())
                  .select(F.col("print").alias(own + "print"), F.lit(True).alias(own + "marked"),
                          F.when(F.coalesce("owner", "print") == F.col("print"), F.col(f"first.{own}row"))
                          .alias(own + "keep")), "marks")
    joined = keyed.join(small(marks), own + "print", "left")
    stays = F.col(own + "marked").isNull() | F.coalesce(F.col(own + "keep") == F.col(own + "row"), F.lit(False))
    return joined.filter(stays).select(*[F.col(f"`{c}`") for c in docs.columns])


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` (a stored table of a few numbers a row), broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df
