"""Mixing sources to target weights, by fitting each source's budget as a subset sum.

Documents are counted by source and exact length.  A source's budget is first met length by length in
proportion; what remains, some ten thousand words, is fitted by a bounded-knapsack dynamic programme
over the documents left.  That decides how many documents of each length the mix takes once more; which ones is
decided by a seeded hash, within groups of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisleworks.llm.shared import WORD_PATTERN, lookup, stored

#: Weights of the sources in code-point order, repeated.
WEIGHTS = (3, 1, 2)
#: Words of the mix for each word of the corpus, and how often a source may be used.
SHARE, MOST = 1.5, 2
#: Words of a budget that the dynamic programme fits, over all lengths.
RESERVE = 65536
SEED = 20240

_PLAN = "src string, size long, extra long, times int"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(src, source_size, target) of each source of ``sizes`` (src, size).

    Sources in code-point order, NULL last, get the weights in turn; ``share`` of all words is dealt by weight, and
    what goes beyond ``MOST`` times a source's words is dealt again until no source is above.  That is: every source
    gets the smaller of its bound and level * weight, where the level uses the budget up.
    """
    totals = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("src").isNull(), F.col("src").cast("binary"))) - 1
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    filled = ranked.withColumn("bound", MOST * F.col("source_size")).withColumn("fill", F.col("bound") / F.col("weight"))
    # With sources in the order in which they fill up, the level at which one more would fill is known from sums.
    order = Window.orderBy("fill", "place")
    everything = Window.partitionBy()
    level = (
        filled.withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("open"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(everything))
    )
    reached = F.coalesce(F.least(F.col("bound").cast("double"), F.col("level") * F.col("weight")), F.col("bound").cast("double"))
    return level.select("src", "source_size", F.greatest(reached, F.lit(0.0)).alias("target"))


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take (at most ``counts``) so that their words come nearest ``budget``.

    >>> fit_counts(np.array([3, 5]), np.array([2, 2]), 11).tolist()
    [2, 1]
    """
    taken = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    share = max(0, budget - RESERVE) / total
    wanted = used = 0.0
    for at in np.argsort(-sizes, kind="stable"):
        if sizes[at]:
            wanted += share * counts[at] * sizes[at]
            taken[at] = min(counts[at], max(0, int((wanted - used) // sizes[at])))
            used += int(taken[at] * sizes[at])
    left = budget - int((taken * sizes).sum())
    spare = counts - taken
    usable = [at for at in np.argsort(-spare, kind="stable") if 0 < sizes[at] and spare[at] > 0 and sizes[at] <= 2 * left]
    if not usable:
        return taken
    # No sum is nearer than the nearest multiple of the lengths' common divisor; once that is reached, more lengths are idle.
    unit = int(np.gcd.reduce(sizes[usable]))
    nearest = min(left % unit, -left % unit)
    # For each sum, the step that first reached it (-1 for none); a length's copies are dealt in powers of two.
    limit = left + max(int(sizes[at]) for at in usable)
    first = np.full(limit + 1, -1, np.int64)
    first[0] = 0
    steps: list[tuple[int, int]] = [(0, 0)]
    for at in usable:
        if (first[max(0, left - nearest) : left + nearest + 1 : max(1, 2 * nearest)] >= 0).any():
            break
        copies, part = min(int(spare[at]), limit // int(sizes[at])), 1
        while copies > 0:
            part = min(part, copies)
            words = part * int(sizes[at])
            first[words:][(first[:-words] >= 0) & (first[words:] < 0)] = len(steps)
            steps.append((at, part))
            copies, part = copies - part, part * 2
    reached = np.flatnonzero(first >= 0)
    goal = int(reached[np.argmin(np.abs(reached - left))])  # of two as near, the smaller
    while goal:
        at, part = steps[first[goal]]
        taken[at] += part
        goal -= part * int(sizes[at])
    return taken


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """For one source's lengths: documents to take once more than the rest, and how often the rest is taken."""
    group = group.sort_values("size")  # rows arrive in any order, and reruns must agree
    sizes, counts = group["size"].to_numpy(np.int64), group["docs"].to_numpy(np.int64)
    budget, own = int(math.floor(group["target"].iloc[0] + 0.5)), int((sizes * counts).sum())
    times = min(budget // own, MOST) if own else 0
    extra = fit_counts(sizes, counts, budget - times * own) if times < MOST else np.zeros(len(sizes), np.int64)
    return pd.DataFrame({"src": group["src"], "size": sizes, "extra": extra, "times": times})


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mixed_rows(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, taken): ``docs`` (doc_id, text, source, ...) as structs; all rows.

    taken is 0, size or 2 * size: the words the mix takes of a document, repeats counted.  Each source's taken words
    come as near its target as its documents' lengths allow.  A document is chosen by a hash of the seed, its
    doc_id and its text, so reruns agree; rows repeated in full are taken alike, which may pass the target by
    their words.  NULL texts and texts without words have size 0 and taken 0; a NULL source is a source.  Other
    columns may have any name.  An empty table gives an empty result.
    """
    # The row travels as one column, so that no name of it can clash.
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.col("row.source").cast("string").alias("src"),
        _size(F.col("row.text").cast("string")).alias("size"),
        F.xxhash64(F.lit(seed), F.col("row.doc_id").cast("string"), F.col("row.text").cast("string")).alias("draw"),
    )
    drawn = stored(rows.select("src", "size", "draw"), "drawn")
    lengths = stored(drawn.groupBy("src", "size").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    aims = stored(targets(lengths.select("src", (F.col("size") * F.col("docs")).alias("size"))), "targets")
    same = lambda a, b: a["src"].eqNullSafe(b["src"])
    planned = stored(
        lengths.join(aims, same(lengths, aims)).drop(aims["src"])
        .groupBy("src").applyInPandas(_plan, _PLAN)
        .alias("p").join(lengths.alias("l"), F.expr("p.src <=> l.src and p.size = l.size"))
        .join(aims.alias("a"), F.expr("p.src <=> a.src"))
        .select(F.xxhash64(F.col("p.src").isNull(), "p.src", "p.size").alias("group"), "p.extra", "p.times", "l.docs",
                "a.source_size", "a.target"),
        "plan",
    )
    cut = _cuts(drawn, planned)
    keyed = rows.withColumn("group", F.xxhash64(F.col("src").isNull(), "src", "size"))
    found = lookup(keyed, planned.join(cut, "group", "left"), ["group"], F.col("draw"), "inner", salts=8)
    more = (F.col("draw") <= F.col("last")).cast("int")
    taken = F.when(F.col("size") > 0, F.col("size") * (F.col("times") + F.coalesce(more, F.lit(0)))).otherwise(0)
    return found.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _cuts(drawn: DataFrame, planned: DataFrame) -> DataFrame:
    """(group, last): the largest draw taken once more, so that just ``extra`` documents of the group are.

    Draws of a group of n documents are cut into about sqrt(n) ranges.  Counts per range find the one in which the
    last document lies, and only that range's documents are ranked: no task sees more than about sqrt(n) rows of a group.
    """
    parts = F.ceil(F.sqrt("docs")).cast("long")
    # The draw's upper 31 bits as a share of their range, times the number of parts.
    upper = F.shiftright("draw", 33) + F.lit(2**30)
    ranged = lookup(
        drawn.select(F.xxhash64(F.col("src").isNull(), "src", "size").alias("group"), "draw"),
        planned.filter("extra > 0 and extra < docs").select("group", "extra", "docs"),
        ["group"], F.col("draw"), "inner", salts=8,
    ).withColumn("range", F.shiftright(upper * parts, 31))
    counted = ranged.groupBy("group", "range", "extra").agg(F.count(F.lit(1)).alias("here"))
    running = Window.partitionBy("group").orderBy("range")
    edge = (
        counted.withColumn("upto", F.sum("here").over(running))
        .withColumn("rank", F.col("extra") - (F.col("upto") - F.col("here")))
        .filter("rank > 0 and rank <= here")
        .select("group", "range", "rank")
    )
    ranks = Window.partitionBy("group", "range").orderBy("draw")
    last = (
        ranged.join(edge, ["group", "range"])
        .withColumn("place", F.row_number().over(ranks))
        .filter("place = rank").select("group", F.col("draw").alias("last"))
    )
    everything = planned.filter("extra >= docs and extra > 0").select("group", F.lit(2**63 - 1).cast("long").alias("last"))
    return stored(last.unionByName(everything), "cuts")


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and taken after its columns; those it had of these names are replaced."""
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return mixed_rows(docs, seed).select(*kept, "size", "source_size", "target", "taken")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with the columns of ``docs``."""
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return (
        mixed_rows(docs, seed).filter("taken > 0")
        .select("row", F.explode(F.sequence(F.lit(1), times)).alias("copy"))
        .select("row.*")
    )
