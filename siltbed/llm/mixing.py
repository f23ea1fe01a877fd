"""Mixing sources to target weights: a hierarchical token budget and seeded epochs, natively.

Weights stand on the nodes of a tree such as domain, language, source. A node hands its budget to its
children by weight; a child that cannot use its share (its texts, over all allowed epochs, hold too
few tokens) takes what it can and its siblings share the rest. As a node's limit is the sum over
its leaves, a shortage is settled among siblings first and reaches the parent's siblings only when
all siblings are full. Each leaf then takes whole epochs and a prefix of one more, in an order drawn
from the seed, the epoch and the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import distinct_name, work_table

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3  # hexadecimal digits of the order key: 4096 buckets per leaf


def count_words(text: Column) -> Column:
    """Words of a text: maximal runs without blanks; NULL has none."""
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(blank, r"[\x20\x09-\x0D]+", "")).cast("long")


def filled(children: DataFrame, level: Sequence[str], node: str) -> DataFrame:
    """Share the parent's ``_budget`` among its children (``node``) by ``_weight``, up to ``_limit``.

    Children fill in the order of limit per weight: one is full if its limit, times the weight of
    all that are not yet full, is at most its weight times what is left. The others share what the
    full ones leave. Amounts are whole tokens, rounded down, and the tokens lost by rounding go one
    each to the children that have room, in the order of the name.
    """
    within = Window.partitionBy(*level)
    by_room = within.orderBy(F.col("_limit") / F.col("_weight"), F.col(node).asc_nulls_first())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        children.withColumn("_total", F.least("_budget", F.sum("_limit").over(within)))
        .withColumn("_used", F.coalesce(F.sum("_limit").over(before), F.lit(0)))
        .withColumn("_rest", F.sum("_weight").over(after))
        .withColumn("_full", F.col("_limit") * F.col("_rest") <= F.col("_weight") * (F.col("_total") - F.col("_used")))
        .withColumn("_full_limit", F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0)).over(within))
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_weight")).otherwise(0)).over(within))
    )
    open_share = F.expr("(_weight * (_total - _full_limit)) div _open")
    given = ranked.withColumn("_given", F.when(F.col("_full"), F.col("_limit")).otherwise(F.least(open_share, "_limit")))
    given = given.withColumn("_lost", F.col("_total") - F.sum("_given").over(within))
    room = (F.col("_given") < F.col("_limit")).cast("long")
    by_name = within.orderBy(F.desc(room), F.col(node).asc_nulls_first())
    return given.withColumn(
        "_budget", F.col("_given") + ((room == 1) & (F.row_number().over(by_name) <= F.col("_lost"))).cast("long")
    ).drop("_total", "_used", "_rest", "_full", "_full_limit", "_open", "_given", "_lost")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], budget: int, epochs: int) -> DataFrame:
    """Token budget of every leaf; ``leaves`` has the levels, ``tokens`` and whole-number weights ``w_<level>``."""
    parents = None
    for depth, node in enumerate(levels):
        at = list(levels[: depth + 1])
        children = leaves.groupBy(*at).agg(
            F.sum(F.col("tokens") * epochs).alias("_limit"), F.max(f"w_{node}").cast("long").alias("_weight")
        ).filter(F.col("_weight") > 0)
        if parents is None:
            children = children.withColumn("_budget", F.lit(budget).cast("long"))
        else:
            children = children.join(parents, list(levels[:depth]))
        parents = filled(children, list(levels[:depth]), node).select(*at, "_budget")
    return parents


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key.cast("string")).cast("binary"))


def mix_plan(
    rows: DataFrame, levels: Sequence[str], weights: Sequence[Column], budget_share: float,
    epochs: int = 2, seed: int = 17,
) -> DataFrame:
    """Per leaf: ``tokens``, ``budget``, ``full`` epochs, and the cut of the epoch after them.

    ``rows`` has the levels, ``_key`` and ``_tokens``. Rows of the cut epoch whose (order key, key)
    is below (``cut_hash``, ``cut_key``) belong to the leaf's prefix: the rows, in that order, before
    which less than the rest of the budget has been taken; NULL takes none.
    """
    leaves = work_table(
        rows.groupBy(*levels).agg(F.sum("_tokens").alias("tokens"))
        .withColumns({f"w_{n}": w.cast("long") for n, w in zip(levels, weights, strict=True)}),
        "mix-leaves",
    )
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    planned = leaf_budgets(leaves, levels, int(total * budget_share), epochs)
    plan = work_table(
        leaves.join(planned, list(levels), "left").select(
            *levels, "tokens", F.coalesce("_budget", F.lit(0)).alias("budget")
        ).withColumn("full", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")),
        "mix-plan",
    )
    drawn = rows.join(plan.filter("rest > 0").select(*levels, "full", "rest"), list(levels)).select(
        *levels, "rest", "_tokens", "_key", order_key(seed, F.col("full"), F.col("_key")).alias("_order")
    ).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    # The cut lies in one of 4096 buckets of the order; only that bucket's rows are put in order.
    sums = drawn.groupBy(*levels, "rest", "_bucket").agg(F.sum("_tokens").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*levels).orderBy("_bucket")) - F.col("_sum")
    cut_bucket = sums.withColumn("_before", before).filter(
        (F.col("_before") < F.col("rest")) & (F.col("_before") + F.col("_sum") >= F.col("rest"))
    ).select(*levels, "_bucket", "_before")
    cut_bucket = work_table(cut_bucket, "mix-buckets")
    ties = drawn.join(cut_bucket, [*levels, "_bucket"]).groupBy(*levels, "rest", "_before", "_order", "_key").agg(
        F.sum("_tokens").alias("_sum")
    )
    in_order = Window.partitionBy(*levels).orderBy("_order", "_key")
    taken = ties.withColumn("_taken", F.col("_before") + F.sum("_sum").over(in_order) - F.col("_sum"))
    cuts = taken.filter("_taken < rest").groupBy(*levels).agg(
        F.max(F.struct("_order", "_key")).alias("_cut")
    ).select(*levels, F.col("_cut._order").alias("cut_hash"), F.col("_cut._key").alias("cut_key"))
    return work_table(plan.join(cuts, list(levels), "left"), "mix-cuts")


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: Sequence[Column], budget_share: float,
    key: str = "doc_id", text: str = "text", epochs: int = 2, seed: int = 17,
) -> DataFrame:
    """``docs`` with ``n_tokens`` (words), the levels as ``mix_<level>`` and ``copies``, the epochs that take the row.

    ``weights`` are whole numbers as columns over the levels, in the order of the levels. The budget
    is ``budget_share`` of all words; a leaf of weight 0 gets nothing, a NULL level is a leaf of its
    own, and rows with equal keys go in or out together. A row with a NULL key sorts as an empty key.
    Texts without words are taken like any other, at no cost. Other columns pass through; columns
    of the new names are refused. Only sums per leaf and bucket are shuffled; the texts are not, as
    long as the plan (one row per leaf) is below the broadcast threshold, and joined by leaf beyond.
    """
    names = {f"mix_{n}": c for n, c in levels.items()}
    clash = {"n_tokens", "copies", *names} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"The rows already have columns {sorted(clash)}")
    at = list(names)
    own = distinct_name(docs, "_mix_key")
    tagged = docs.withColumns({n: F.coalesce(c.cast("string"), F.lit("")) for n, c in names.items()})
    tagged = tagged.withColumn("n_tokens", count_words(F.col(text)))
    tagged = tagged.withColumn(own, F.coalesce(F.col(key).cast("string"), F.lit("")))
    slim = work_table(tagged.select(*at, F.col(own).alias("_key"), F.col("n_tokens").alias("_tokens")), "mix-rows")
    plan = mix_plan(slim, at, weights, budget_share, epochs, seed)
    joined = tagged.join(plan.select(*at, "full", "cut_hash", "cut_key"), at)
    order = order_key(seed, F.col("full"), F.col(own))
    in_prefix = (order < F.col("cut_hash")) | ((order == F.col("cut_hash")) & (F.col(own) <= F.col("cut_key")))
    copies = F.col("full") + F.coalesce(in_prefix, F.lit(False)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], "n_tokens", *at, copies.cast("long").alias("copies"))


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The chosen rows themselves, each as often as epochs take it."""
    return mixed.filter("copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    ).select(*[F.col(f"`{c}`") for c in columns])
