"""Mixing sources to target weights: token budgets through a tree, then a prefix of seeded epochs per leaf.

Everything here is DataFrame functions; amounts are whole numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import NO_ID, doc_key, spool, whole_text

#: Documents of a leaf that are put in order in one task.
SLICE_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"
_BIG = "decimal(38,0)"

#: Production setting: the tree, the weights of its nodes and the size of the mix.
LEVELS = ("domain", "lang", "source")
WEIGHTS: Sequence[Mapping[str, int]] = ({"hub": 1, "web": 3}, {"en": 5, "de": 2, "fr": 2, "es": 1}, {})
BUDGET_PERCENT = 60
EPOCHS = 2
SEED = 17


def domain_of(source: str = "source") -> Column:
    """The production domain of a source: the one that gives a third of all rows, and the others."""
    return F.when(F.col(source) == "src0", "hub").otherwise("web")


def n_tokens(text: str = "text") -> Column:
    """Tokens of a text: its words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    value = F.lit(1)
    for name, weight in weights.items():
        value = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(value)
    return value.cast(_BIG)


def share_budget(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Give each child of a node its part of the node's budget, and what siblings cannot use.

    ``nodes`` has the parents' columns, ``child``, ``weight``, ``capacity``
    and the parent's ``budget``, not above the children's capacities. In the
    order of capacity per weight, a child whose capacity does not exceed its
    part of what is left is filled up and the rest goes to the others by
    weight; the first that is not full ends this. Parts are rounded down. A
    shortage thus stays among siblings, and no more than a node can use ever
    reaches it, so that ancestors have passed on the rest before.
    """
    order = Window.partitionBy(*parents).orderBy((F.col("capacity").cast("double") / F.col("weight")), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast(_BIG)
    return (
        nodes.withColumn("left_budget", (F.col("budget") - F.coalesce(F.sum("capacity").over(before), zero)).cast(_BIG))
        .withColumn("left_weight", F.sum("weight").over(after).cast(_BIG))
        .withColumn("fills", F.col("capacity") * F.col("left_weight") <= F.col("left_budget") * F.col("weight"))
        .withColumn("open", F.max(F.when(~F.col("fills"), 1).otherwise(0)).over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("stop_budget", F.max(F.when(~F.col("fills"), F.col("left_budget"))).over(Window.partitionBy(*parents)))
        .withColumn("stop_weight", F.max(F.when(~F.col("fills"), F.col("left_weight"))).over(Window.partitionBy(*parents)))
        .withColumn(
            "share",
            F.when(F.col("open") == 0, F.col("capacity"))
            .otherwise(F.expr("stop_budget * weight div stop_weight"))
            .cast("long"),
        )
        .drop("left_budget", "left_weight", "fills", "open", "stop_budget", "stop_weight")
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str, int]], percent: int, epochs: int
) -> DataFrame:
    """The token budget of each leaf; ``leaves`` has the levels and their ``tokens``.

    The whole budget is ``percent`` of all tokens. A leaf can give its tokens
    ``epochs`` times, a node what its leaves can. Nulls are a name of their
    own. A name without a weight weighs 1.
    """
    nodes = leaves.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("\x00null")).alias(c) for c in levels),
        F.col("tokens").cast(_BIG).alias("tokens"),
    )
    nodes = nodes.withColumn("capacity", (F.col("tokens") * epochs).cast(_BIG))
    total = nodes.agg((F.sum("tokens") * percent).cast(_BIG).alias("t")).select(F.expr("t div 100").cast(_BIG).alias("budget"))
    budgets, parents = total, []
    for level, weight in zip(levels, weights):
        path = [*parents, level]
        children = (
            nodes.groupBy(*path).agg(F.sum("capacity").cast(_BIG).alias("capacity"))
            .withColumn("weight", _weight(level, weight))
        )
        if parents:
            children = children.join(budgets, parents)
        else:  # the budget is one row
            children = children.withColumn("budget", F.lit(None).cast(_BIG))
            children = children.drop("budget").join(F.broadcast(budgets), how="left")
        shared = share_budget(children, parents or [F.lit(0)], level)
        budgets = shared.select(*path, F.col("share").cast(_BIG).alias("budget"))
        parents = path
    return budgets.select(*levels, F.col("budget").cast("long").alias("budget"))


def _order(seed: int) -> Column:
    """A document's place in an epoch: the digest of seed, epoch and id."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def choose(
    docs: DataFrame,
    levels: Sequence[str] = LEVELS,
    weights: Sequence[Mapping[str, int]] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mix: a row for each document and epoch it is taken in.

    ``docs`` has doc_id, the levels and ``tokens`` (and may have ``copy``, which tells equal ids apart). Returns doc_id, the levels
    (null as it was), epoch (from 0), tokens, start (the leaf's tokens before
    it in that epoch) and taken (its tokens that count: all, or for the last
    document what is left of the budget). A leaf's budget takes whole epochs,
    then the beginning of the next one; each epoch has an order of its own.
    Documents without tokens are never taken. Equal ids are ordered by
    tokens; an empty table gives no rows.

    A leaf may hold most of all documents, so an epoch's order is cut into
    slices by its first digits: sums of slices tell where each begins, and
    only inside a slice are documents put in order.
    """
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")).alias(c) for c in levels]
    more = ["copy"] if "copy" in docs.columns else []
    rows = spool(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, "tokens", *more).where("tokens > 0"), "mix")
    leaves = spool(rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    budgets = leaf_budgets(leaves, levels, weights, percent, epochs)
    plan = spool(
        leaves.join(budgets, list(levels))
        .withColumn("slices", F.ceil(F.col("docs") / SLICE_ROWS).cast("long"))
        .select(*levels, "tokens", "budget", "slices")
        .withColumnRenamed("tokens", "leaf_tokens"),
        "budgets",
    )
    taken = plan.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn(
        "goal", F.least(F.col("leaf_tokens"), F.col("budget") - F.col("epoch") * F.col("leaf_tokens"))
    ).where("goal > 0")
    ordered = (
        rows.join(taken, list(levels))
        .withColumn("place", _order(seed))
        .withColumn("slice", F.expr("conv(substr(place, 1, 8), 16, 10)").cast("long") * F.col("slices") / F.lit(1 << 32))
        .withColumn("slice", F.floor("slice"))
    )
    part = [*levels, "epoch", "slice"]
    whole = Window.partitionBy(*levels, "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = ordered.groupBy(*part).agg(F.sum("tokens").alias("in_slice")).select(
        *part, F.coalesce(F.sum("in_slice").over(whole), F.lit(0)).alias("begin")
    )
    inside = Window.partitionBy(*part).orderBy("place", "doc_id", "tokens", *more).rowsBetween(Window.unboundedPreceding, -1)
    names = [F.when(F.col(c) != "\x00null", F.col(c)).alias(c) for c in levels]
    return (
        ordered.join(begins, part)
        .where("begin < goal")
        .withColumn("start", F.col("begin") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .where("start < goal")
        .select("doc_id", *more, *names, "epoch", "tokens", "start", F.least("tokens", F.col("goal") - F.col("start")).alias("taken"))
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the production mix, whole and with all their columns, a row for each epoch.

    The document at the end of a leaf's budget stays whole. Rows with equal id
    and text are taken together.
    """
    chosen = choose(
        docs.select("doc_id", domain_of().alias("domain"), "lang", "source", n_tokens().alias("tokens"), F.xxhash64(whole_text()).alias("copy"))
    ).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "copy", "epoch").distinct()
    taken = {c.lower() for c in docs.columns}
    key, copy = (next(n for n in (f"{p}{i}" for i in range(len(taken) + 1)) if n not in taken) for p in "kc")
    chosen = chosen.select(F.col("key").alias(key), F.col("copy").alias(copy))
    return docs.withColumns({key: doc_key(), copy: F.xxhash64(whole_text())}).join(chosen, [key, copy]).select(*docs.columns)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production mix of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return choose(docs.select("doc_id", domain_of().alias("domain"), "lang", "source", n_tokens().alias("tokens")))


def _cases(column: str, weights: Mapping[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"CASE {column} {whens} ELSE 1 END" if whens else "1"


def _level_sql(name: str, path: Sequence[str], weights: Mapping[str, int]) -> str:
    """One level of the same computation in DuckDB: shares of ``name`` from the level above."""
    cols, parents = ", ".join(path), ", ".join(path[:-1])
    part = f"PARTITION BY {parents} " if parents else ""
    join = f"JOIN {name}_up USING ({parents})" if parents else f"CROSS JOIN {name}_up"
    return f"""
    {name}_in AS (SELECT {cols}, sum(capacity)::HUGEINT AS capacity, ({_cases(path[-1], weights)})::HUGEINT AS weight
      FROM leaves GROUP BY {cols}),
    {name}_a AS (SELECT i.*, budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb,
        sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lw
      FROM {name}_in i {join} WINDOW w AS ({part}ORDER BY capacity::DOUBLE / weight, {path[-1]})),
    {name}_b AS (SELECT *, capacity * lw <= lb * weight AS fills FROM {name}_a),
    {name}_c AS (SELECT *, max(CASE WHEN fills THEN 0 ELSE 1 END) OVER
        ({part}ORDER BY capacity::DOUBLE / weight, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opened,
        max(CASE WHEN NOT fills THEN lb END) OVER ({part}) AS sb, max(CASE WHEN NOT fills THEN lw END) OVER ({part}) AS sw
      FROM {name}_b),
    {name} AS (SELECT {cols}, (CASE WHEN opened = 0 THEN capacity ELSE (sb * weight) // sw END)::HUGEINT AS budget FROM {name}_c)"""


def oracle_sql() -> str:
    """The production mix in DuckDB."""
    levels = []
    for depth, (level, weights) in enumerate(zip(LEVELS, WEIGHTS)):
        name = f"l{depth}"
        above = "SELECT (sum(tokens) * %d)::HUGEINT // 100 AS budget FROM rows_" % BUDGET_PERCENT if not depth else f"SELECT * FROM l{depth - 1}"
        levels.append(f"{name}_up AS ({above})," + _level_sql(name, LEVELS[: depth + 1], weights))
    cols = ", ".join(LEVELS)
    return f"""
    WITH rows_ AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 'hub' ELSE 'web' END AS domain, lang, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
    leaves AS (SELECT {cols}, sum(tokens)::HUGEINT * {EPOCHS} AS capacity FROM rows_ WHERE tokens > 0 GROUP BY {cols}),
    {", ".join(levels)},
    goals AS (SELECT {cols}, epoch, least(capacity // {EPOCHS}, budget - epoch * (capacity // {EPOCHS})) AS goal
      FROM leaves JOIN l{len(LEVELS) - 1} USING ({cols}) CROSS JOIN (SELECT unnest(range({EPOCHS})) AS epoch)),
    placed AS (SELECT doc_id, {cols}, epoch, tokens, goal, coalesce(sum(tokens) OVER (PARTITION BY {cols}, epoch
        ORDER BY md5('{SEED}:' || epoch || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM rows_ JOIN goals USING ({cols}) WHERE tokens > 0 AND goal > 0)
    SELECT doc_id, {cols}, epoch::INTEGER AS epoch, tokens, start::BIGINT AS start, least(tokens, goal - start)::BIGINT AS taken
    FROM placed WHERE start < goal"""
