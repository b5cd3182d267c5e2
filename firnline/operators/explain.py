"""How much each feature moved a forest's probability, and the words for it.

The attribution is the Shapley value of the tree's conditional expectation, weighting branches by
the training rows that took them. For one leaf with value v, let o be 1 or 0 as a feature's path
tests hold or fail and r the share of rows that pass them; features not tested have o = r = 1. A
feature's share is v (o - r) times the integral over s in 0..1 of the product, over the other
features, of (1 - s) r + s o. That is a polynomial of degree six for seven features, so four Gauss
nodes give it exactly.

A row matters to a leaf only by which of its seven tests hold: 128 patterns. Each leaf's shares are worked out once
for every pattern; a row is then one pattern and one look-up a leaf. Patterns come from a table by the place of the row's value
among a block's thresholds. Leaves are broadcast, in parts of a checked size; rows stay in their partitions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions import measure
from firnline.functions.text import fixed, signed, title_case
from firnline.operators.ranking import smallest_per_key
from firnline.session import stage

#: Leaves sent to every worker at once, 176 bytes each; more go in further passes over the rows.
LEAVES_PER_PASS = 250_000
#: Leaves whose pattern table is held at once: 512 × 128 patterns × 7 shares × 8 bytes = 3.7 MB.
LEAVES_PER_TABLE = 512
#: Rows a table is used for before the next one is made.
ROWS_PER_TABLE = 65_536


def forest_nodes(path: str, spark) -> DataFrame:
    """Node table of a saved forest: one row per node with split, children and class counts."""
    nodes = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    stats = node["impurityStats"]
    return nodes.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.aggregate(stats, F.lit(0.0), lambda a, b: a + b).alias("rows"),
        F.when(stats[0] + stats[1] > 0, stats[1] / (stats[0] + stats[1])).alias("value"),
    )


def leaves(nodes: DataFrame, depth: int) -> DataFrame:
    """One row per leaf: its tree, value, and per feature the interval (low, high] its path allows
    and the share of rows that follow those tests.

    Walks the trees level by level with joins, ``depth`` of them at most.
    """
    count = len(fv.FEATURES)
    every = F.sequence(F.lit(0), F.lit(count - 1))
    inner = nodes.filter(F.col("left") >= 0)
    steps = nodes.select("tree", "id", F.col("rows").alias("child_rows"))

    def branch(child: str, is_left: bool) -> DataFrame:
        return inner.select(
            "tree", F.col("id").alias("parent"), F.col(child).alias("id"),
            F.col("feature").alias("on"), "threshold", "rows", F.lit(is_left).alias("is_left"),
        )

    edges = branch("left", True).unionByName(branch("right", False)).join(
        steps, ["tree", "id"]
    )
    reached = nodes.filter(F.col("id") == 0).select(
        "tree", "id",
        F.transform(every, lambda _: F.lit(float("-inf"))).alias("low"),
        F.transform(every, lambda _: F.lit(float("inf"))).alias("high"),
        F.transform(every, lambda _: F.lit(1.0)).alias("share"),
    )
    at = F.col("on") + 1

    def put(old: str, new: Column) -> Column:
        """The array with the tested feature's entry replaced; a leaf has no test, so no change."""
        return F.transform(
            old, lambda v, i: F.when(F.coalesce(i == F.col("on"), F.lit(False)), new).otherwise(v)
        )

    for _ in range(depth):
        # A leaf meets no edge and stays as it is.
        walked = reached.withColumnRenamed("id", "parent").join(edges, ["tree", "parent"], "left")
        reached = walked.select(
            "tree", F.coalesce("id", "parent").alias("id"),
            F.when(F.col("is_left"), F.col("low")).otherwise(
                put("low", F.greatest(F.try_element_at("low", at), F.col("threshold")))
            ).alias("low"),
            F.when(~F.col("is_left"), F.col("high")).otherwise(
                put("high", F.least(F.try_element_at("high", at), F.col("threshold")))
            ).alias("high"),
            put("share", F.try_element_at("share", at) * F.col("child_rows") / F.col("rows"))
            .alias("share"),
        )
    ends = nodes.filter(F.col("left") < 0).select("tree", "id", "value")
    return reached.join(ends, ["tree", "id"])


def pattern_shares(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaves, patterns, features): each leaf's Shapley shares for every pattern of held tests, bit i for feature i."""
    count = share.shape[1]
    holds = (np.arange(1 << count)[:, None] >> np.arange(count) & 1).astype(float)
    nodes, weights = np.polynomial.legendre.leggauss(count // 2 + 1)
    nodes, weights = (nodes + 1.0) / 2.0, weights / 2.0
    inner = np.zeros((len(share), len(holds), count))
    for s, w in zip(nodes, weights):
        mixed = (1.0 - s) * share[:, None, :] + s * holds
        # The product of all other features: those before times those after.
        before, after = np.ones_like(mixed), np.ones_like(mixed)
        for i in range(1, count):
            before[:, :, i] = before[:, :, i - 1] * mixed[:, :, i - 1]
            after[:, :, -1 - i] = after[:, :, -i] * mixed[:, :, -i]
        inner += w * before * after
    return (holds - share[:, None, :]) * inner * value[:, None, None]


def pattern_tables(low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per feature the block's thresholds, and by a value's place among them the pattern bit of every leaf."""
    made = []
    for i in range(low.shape[1]):
        bounds = np.unique(np.concatenate([low[:, i], high[:, i]]))
        # A value with `place` thresholds below it is above the first `place` of them and at most the next.
        place = np.arange(len(bounds) + 1)[:, None]
        above = np.searchsorted(bounds, low[:, i]) < place
        upto = place <= np.searchsorted(bounds, high[:, i])
        made.append((bounds, ((above & upto).astype(np.uint8) << i)))
    return made


def shapley(x: np.ndarray, low: np.ndarray, high: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values of rows ``x`` summed over leaves; a row of ``low``, ``high`` and ``share`` per leaf."""
    total, count = np.zeros_like(x), x.shape[1]
    for first in range(0, len(value), LEAVES_PER_TABLE):
        part = slice(first, first + LEAVES_PER_TABLE)
        shares = pattern_shares(share[part], value[part]).reshape(-1, count)
        tables = pattern_tables(low[part], high[part])
        places = [np.searchsorted(bounds, x[:, i]) for i, (bounds, _) in enumerate(tables)]
        at = np.arange(len(value[part])) << count
        # A few hundred rows at a time, so that what is looked up stays in the cache.
        for begin in range(0, len(x), 256):
            rows = slice(begin, begin + 256)
            pattern = tables[0][1][places[0][rows]]
            for place, (_, bits) in zip(places[1:], tables[1:]):
                pattern |= bits[place[rows]]
            for r, looked in enumerate(at + pattern):
                total[begin + r] += shares[looked].sum(axis=0)
    return total


def base_value(leaf_table: DataFrame, trees: int) -> DataFrame:
    """The forest's mean prediction over its own training rows."""
    reach = F.aggregate("share", F.lit(1.0), lambda a, b: a * b)
    return leaf_table.agg((F.sum(F.col("value") * reach) / trees).alias("base_value"))


def contributions(scored: DataFrame, leaf_table: DataFrame, trees: int, key: str) -> DataFrame:
    """Long table (key, feature, value, shap_value) for rows with all features; ``key`` is unique.

    ``leaf_table`` should be stored. Leaves are broadcast, at most ``LEAVES_PER_PASS`` at once; each pass adds what its
    leaves give to every row, where the row is. Rows are never shuffled.
    """
    columns = list(fv.FEATURES)
    shares = [f"__s{i}" for i in range(len(columns))]
    spark = scored.sparkSession
    passes = max(1, math.ceil(leaf_table.count() / LEAVES_PER_PASS))
    current = scored.select(F.col(f"`{key}`").alias("__key"), *[F.col(c).cast("double").alias(c) for c in columns],
                            *[F.lit(0.0).alias(s) for s in shares])
    schema = f"__key {dict(current.dtypes)['__key']}, " + ", ".join(f"{c} double" for c in [*columns, *shares])

    def adds(sent):
        def add(batches):
            leaves = sent.value

            def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
                rows = pa.Table.from_batches(held).combine_chunks()
                x, old = (np.column_stack([rows[c].to_numpy() for c in names]) for names in (columns, shares))
                for i, got in enumerate((old + shapley(x, *leaves)).T):
                    rows = rows.set_column(rows.schema.get_field_index(shares[i]), shares[i], pa.array(got))
                return rows.to_batches()[0]

            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(map(len, held)) >= ROWS_PER_TABLE:
                    yield done(held)
                    held = []
            if sum(map(len, held)):
                yield done(held)

        return add

    for number in range(passes):
        mine = leaf_table.filter(F.pmod(F.xxhash64("tree", "id"), F.lit(passes)) == number)
        # At most about LEAVES_PER_PASS rows of 22 numbers.
        rows = mine.select("low", "high", "share", (F.col("value") / trees).alias("leaf")).toArrow()
        boxes = [np.asarray(rows[c].combine_chunks().flatten(), dtype=float).reshape(-1, len(columns))
                 for c in ("low", "high", "share")]
        sent = spark.sparkContext.broadcast((*boxes, np.asarray(rows["leaf"], dtype=float)))
        current = current.mapInArrow(adds(sent), schema)
        if number + 1 < passes:
            current = stage(current, "explained-part")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(s).alias("shap_value"))
            for c, s in zip(columns, shares)
        ]
    )
    return current.select(F.col("__key").alias(key), F.inline(cells))


def explain(model: PipelineModel, model_path: str, scored: DataFrame, key: str):
    """Contributions of ``scored`` under a pipeline saved at ``model_path``, with the base value.

    The leaf table is staged: the contributions and the base value both read it.
    """
    forest = model.stages[-1]
    depth = max(t.depth for t in forest.trees)
    saved = f"{model_path}/stages/{len(model.stages) - 1}_*"
    table = stage(leaves(forest_nodes(saved, scored.sparkSession), depth), "leaves")
    base = base_value(table, forest.getNumTrees).scalar()
    # Few bytes but much work a row: spread over the cores.
    rows = scored.select(f"`{key}`", *fv.FEATURES).repartition(scored.sparkSession.sparkContext.defaultParallelism)
    return contributions(rows, table, forest.getNumTrees, key).withColumn("base_value", base)


def with_impact(contribs: DataFrame) -> DataFrame:
    shap = F.col("shap_value")
    return contribs.withColumns(
        {
            "impact": F.when(shap > 0, fv.IMPACT_UP).otherwise(fv.IMPACT_DOWN),
            "abs_shap": F.abs(shap),
        }
    )


def global_importance(contribs: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature."""
    return contribs.groupBy("feature").agg(
        F.avg(F.abs("shap_value")).alias("mean_shap")
    ).orderBy(F.desc("mean_shap"))


def waterfall(contribs: DataFrame, key: str, base: Column) -> DataFrame:
    """Running sum from the base value to the prediction, smallest contribution first.

    A key has one row per feature.
    """
    order = W.partitionBy(key).orderBy(F.abs("shap_value"), "feature").rowsBetween(
        W.unboundedPreceding, 0
    )
    after = base + F.sum("shap_value").over(order)
    return contribs.select(
        key, "feature", "shap_value",
        (after - F.col("shap_value")).alias("start"), after.alias("end"),
    )


def ranked(contribs: DataFrame, key: str, top: int = 3) -> DataFrame:
    """The largest contributions of each sign per key; a zero is in neither list."""
    return smallest_per_key(
        contribs.filter(F.col("shap_value") != 0).withColumn(
            "direction", F.signum("shap_value").cast("int")
        ),
        [key, "direction"], [F.abs("shap_value").desc(), "feature"], top, rank="rank",
    )


def _note(direction: int) -> Column:
    feature, value = F.col("feature"), F.col("value")
    chain = None
    for name, bound, words in (fv.RAISING_NOTES if direction > 0 else fv.LOWERING_NOTES):
        hit = (feature == name) & ((value > bound) if direction > 0 else (value < bound))
        chain = F.when(hit, words) if chain is None else chain.when(hit, words)
    return chain.otherwise("")


def texts(contribs: DataFrame, predictions: DataFrame, key: str, threshold: float) -> DataFrame:
    """(key, text): the explanation of each prediction in words.

    ``predictions`` has ``key`` and ``prediction``. At most three lines per sign are gathered.
    """
    up = F.col("direction") > 0
    line = F.concat(
        F.when(up, "  🔺 ").otherwise("  🔻 "), title_case(F.col("feature")), F.lit(": "),
        fixed(F.col("value"), 1), F.when(up, _note(1)).otherwise(_note(-1)), F.lit(" ["),
        F.when(up, signed(F.col("shap_value"), 2)).otherwise(fixed(F.col("shap_value"), 2)),
        F.lit("]\n"),
    )
    lines = ranked(contribs, key).select(
        key, "direction", F.struct("rank", line.alias("line")).alias("entry")
    )

    def gathered(direction: int, title: str) -> Column:
        entries = F.array_sort(
            F.collect_list(F.when(F.col("direction") == direction, F.col("entry")))
        )
        body = F.array_join(F.transform(entries, lambda e: e["line"]), "")
        return F.when(F.size(entries) > 0, F.concat(F.lit(f"\n**{title}:**\n"), body)).otherwise("")

    factors = lines.groupBy(key).agg(
        gathered(1, "Factors INCREASING risk").alias("raising"),
        gathered(-1, "Factors DECREASING risk").alias("lowering"),
    )
    p, t = F.col("prediction"), F.lit(threshold)
    level = measure.risk_level(p, t)
    icon = F.create_map(*[F.lit(x) for pair in fv.RISK_ICONS.items() for x in pair])
    head = F.concat(
        F.lit("\n"), F.try_element_at(icon, level), F.lit(" **AVALANCHE RISK: "), level, F.lit(" ("),
        fixed(p * 100.0, 0), F.lit("%)**\n(Decision threshold: "), fixed(t, 2), F.lit(")\n"),
    )
    advice = F.concat(
        F.lit("\n**Recommendation:**\n"),
        F.when(
            level == fv.RISK_HIGH,
            F.concat(F.lit(f"{fv.ADVICE_HIGH}\n  Model is "), fixed((p / t - 1.0) * 100.0, 0),
                     F.lit("% above safety threshold.")),
        ).when(
            level == fv.RISK_MODERATE,
            F.lit(f"{fv.ADVICE_MODERATE}\n  Conditions approaching unsafe levels."),
        ).otherwise(
            F.concat(F.lit(f"{fv.ADVICE_LOW}\n  "), fixed((t - p) / t * 100.0, 0),
                     F.lit("% below danger threshold.")),
        ),
    )
    return predictions.join(factors, key, "left").select(
        key,
        F.concat(
            head, F.coalesce("raising", F.lit("")), F.coalesce("lowering", F.lit("")), advice
        ).alias("text"),
    )
