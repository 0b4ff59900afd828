"""Hierarchical budgeting over a tree of domains, languages and sources, in DataFrame functions only.

The token budget flows down the tree by weight. A child never gets more than it has times ``max_epochs``; what it cannot take goes
to its siblings, and only what all siblings cannot take goes back to the ancestors' other branches. A leaf's allotment is read from
seeded epochs: whole passes over the leaf, then the prefix of the next pass whose tokens fit. Each pass has its own order, by md5 of
seed, epoch, doc_id and md5 of the text.

Nulls: a null domain, language or source is a branch of its own (empty name); a null text has no tokens and sits in every pass that
reaches its place; a null doc_id orders by its text. Repeated rows are counted and ordered one by one; equal ones are interchangeable.
Weights below 1 count as 0; branches without a weight get ``default_weight``. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from treelab.llm.shared import settle

LEVELS = ["domain", "lang", "source"]
#: Fixed pattern of a word; its count is the number of tokens of a text.
WORD = r"[^ \t\n\x0B\f\r]+"
#: Leading hex digits of the order key that name a slice of a leaf.
SLICE_DIGITS = 3


def domain_of_source() -> Column:
    """Domain of a source where documents name none: the number at the end of its name modulo 4."""
    return F.concat(F.lit("dom"), F.expr(r"cast(try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) as int) % 4 as string)"))


def leaf_rows(docs: DataFrame, domain: Column) -> DataFrame:
    """doc_id, the three levels, n_tokens and the text's digest, for every row."""
    levels = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(LEVELS, [domain, F.col("lang"), F.col("source")], strict=True)]
    body = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *levels, F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_tokens"), F.md5(body).alias("body_md5"))


def order_key(seed: int, epoch: Column) -> Column:
    """Hex key by which a leaf is read in an epoch (from 0)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "body_md5"))


def weight_of(level: str, weights: Mapping[str, int], default: int) -> Column:
    """Weight of a branch by its name."""
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(out)
    return F.greatest(out, F.lit(0)).cast("long")


def fill(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Shares ``budget`` of each parent among its children by ``weight`` up to ``cap``; adds ``share``.

    Children are taken by cap over weight: while one's fair part of what is left reaches its cap, it is full; the others divide
    the rest by weight, rounded down. Children without weight get nothing.
    """
    big = lambda c: c.cast("decimal(38,0)")
    order = [(F.col("cap") / F.greatest(F.col("weight"), F.lit(1))).asc(), F.col(child).asc()]
    group = W.partitionBy(*parents, F.col("weight") > 0)
    at = group.orderBy(*order)
    before = F.coalesce(F.sum("cap").over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(at.rowsBetween(0, W.unboundedFollowing))
    ranked = children.withColumns({"before": before, "left": left}) \
        .withColumn("full", (F.col("weight") > 0) & (big(F.col("cap")) * F.col("left") <= big(F.greatest(F.col("budget") - F.col("before"), F.lit(0))) * F.col("weight")))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))
    open_weight = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), F.lit(0))
    part = F.expr("(cast(greatest(budget - taken, 0) as decimal(19,0)) * cast(weight as decimal(18,0))) div cast(greatest(open_weight, 1) as decimal(18,0))")
    return ranked.withColumns({"taken": taken, "open_weight": open_weight}) \
        .withColumn("share", F.when(F.col("weight") <= 0, F.lit(0).cast("long")).when(F.col("full"), F.col("cap")).otherwise(part)) \
        .drop("before", "left", "full", "taken", "open_weight")


def leaf_plan(leaves: DataFrame, budget_share: float, max_epochs: int, weights: Mapping[str, Mapping[str, int]], default_weight: int) -> DataFrame:
    """Per leaf: its tokens, allotment, whole passes and the tokens of the last, partial pass. ``leaves``: levels and n_tokens."""
    caps = leaves.withColumn("cap", F.col("n_tokens") * max_epochs)
    total = F.sum("n_tokens").over(W.partitionBy())
    nodes = caps.groupBy("domain").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("cap").alias("cap")) \
        .withColumn("budget", F.floor(total * F.lit(budget_share)).cast("long"))
    shares = None
    for depth, level in enumerate(LEVELS):
        parents = LEVELS[:depth]
        if depth:
            nodes = caps.groupBy(*LEVELS[: depth + 1]).agg(F.sum("n_tokens").alias("n_tokens"), F.sum("cap").alias("cap")) \
                .join(shares.select(*parents, F.col("share").alias("budget")), parents)
        shares = fill(nodes.withColumn("weight", weight_of(level, weights.get(level, {}), default_weight)), parents, level)
    has = F.greatest(F.col("n_tokens"), F.lit(1))
    return shares.select(*LEVELS, "n_tokens", F.col("share").alias("allotted")) \
        .withColumn("passes", F.expr("allotted div greatest(n_tokens, 1)")).withColumn("rest", F.col("allotted") % has)


def decide(docs: DataFrame, budget_share: float, max_epochs: int, weights: Mapping[str, Mapping[str, int]], seed: int,
           default_weight: int, domain: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Narrow rows with their place, the plan of the leaves with the slice where each allotment ends, and the rows of those slices.

    Leaves are cut into 4,096 slices of their order; sums of slices find the slice in which the allotment ends, and only the rows
    of that slice are ordered. So no leaf is ever in one task, however many rows it has.
    """
    rows = settle(leaf_rows(docs, domain), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))
    plan = settle(leaf_plan(leaves, budget_share, max_epochs, weights, default_weight), "mix-plan").drop("n_tokens", "allotted")
    keyed = placed(rows.join(plan, LEVELS), seed).drop("body_md5")
    sums = keyed.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("slice_tokens"), F.first("rest").alias("rest"))
    running = F.sum("slice_tokens").over(W.partitionBy(*LEVELS).orderBy("slice"))
    edges = sums.withColumn("upto", running).where(F.col("upto") > F.col("rest")).groupBy(*LEVELS).agg(
        F.min("slice").alias("edge"), F.min_by(F.col("upto") - F.col("slice_tokens"), "slice").alias("done"))
    plan = settle(plan.join(edges, LEVELS, "left"), "mix-edges")
    marked = keyed.drop("passes", "rest").join(plan, LEVELS)
    at = W.partitionBy(*LEVELS).orderBy("place", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)
    cut = marked.where(F.col("slice") == F.col("edge")) \
        .withColumn("extra", (F.col("rest") > 0) & (F.col("done") + F.sum("n_tokens").over(at) <= F.col("rest")))
    return marked, plan, cut


def placed(rows: DataFrame, seed: int) -> DataFrame:
    return rows.withColumn("place", order_key(seed, F.col("passes"))).withColumn("slice", F.substring("place", 1, SLICE_DIGITS))


def outside(marked: DataFrame) -> DataFrame:
    """The rows outside the slices where allotments end, with their copies: those before are in the last, partial pass."""
    extra = (F.col("rest") > 0) & (F.col("slice") < F.col("edge"))
    return marked.where(F.col("edge").isNull() | (F.col("slice") != F.col("edge"))) \
        .withColumn("copies", F.col("passes") + F.coalesce(extra, F.lit(False)).cast("long"))


def select(docs: DataFrame, budget_share: float, max_epochs: int, weights: Mapping[str, Mapping[str, int]], seed: int = 17,
           default_weight: int = 1, domain: Column | None = None) -> DataFrame:
    """doc_id, levels, n_tokens, copies: how often the mixture reads each row (rows it never reads are left out)."""
    marked, _, cut = decide(docs, budget_share, max_epochs, weights, seed, default_weight, domain_of_source() if domain is None else domain)
    inside = cut.withColumn("copies", F.col("passes") + F.col("extra").cast("long")).drop("extra")
    return outside(marked).unionByName(inside).where("copies > 0").select("doc_id", *LEVELS, "n_tokens", "copies")


def mixed(docs: DataFrame, budget_share: float, max_epochs: int, weights: Mapping[str, Mapping[str, int]], seed: int = 17,
          default_weight: int = 1, domain: Column | None = None) -> DataFrame:
    """``docs``, all columns, each row as often as the mixture reads it. Texts are not shuffled but for the slices where allotments end."""
    domain = domain_of_source() if domain is None else domain
    _, plan, cut = decide(docs, budget_share, max_epochs, weights, seed, default_weight, domain)
    levels = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(LEVELS, [domain, F.col("lang"), F.col("source")], strict=True)]
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", *levels, F.md5(F.coalesce("text", F.lit(""))).alias("body_md5"))
    marked = placed(keyed.join(plan, LEVELS), seed)
    chosen = cut.groupBy(*LEVELS, "place").agg(F.sum(F.col("extra").cast("long")).alias("n_extra"))
    inside = marked.where(F.col("slice") == F.col("edge")).join(chosen, [*LEVELS, "place"]) \
        .withColumn("nth", F.row_number().over(W.partitionBy(*LEVELS, "place").orderBy("doc_id"))) \
        .withColumn("copies", F.col("passes") + (F.col("nth") <= F.col("n_extra")).cast("long"))
    both = outside(marked).select("row", "copies").unionByName(inside.select("row", "copies"))
    return both.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
