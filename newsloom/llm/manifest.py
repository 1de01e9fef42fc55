"""Merkle manifest of a table: a tree per group, a tree over the groups' roots, and a proof for every row.

Everything here is DataFrame functions. Digests are lower-case hex text of
sha256, and a node is the digest of its children's digests one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import spool
from newsloom.operators.joins import lookup_join

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
#: Nodes of a level that are put together in one row: the greatest power of the arity up to this.
BLOCK_NODES = 1024
HEX = 64
_TAMPER_DIVISOR = 7


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """Digest of a row: of each field ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    parts = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order_by: str = "doc_id",
    tampered: dict[str, Column] | None = None,
    arity: int = ARITY,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """Leaves, roots and proofs of all rows.

    Within each value of ``group`` leaves ascend by ``order_by``; every
    ``arity`` consecutive nodes become one until one is left, the group's
    subroot. The subroots, in the order of the group's values, become the root
    in the same way. Returns for each row ``order_by``, ``leaf``, ``tampered``
    (the leaf with the columns of ``tampered`` in place of its own where that
    gives another one, else null), ``pos`` and ``proof`` in the group's tree,
    ``subroot``, ``group_pos`` and ``group_proof`` in the tree over it, and
    ``root``. A proof has one entry per level: the digests of the other nodes
    of the run, left to right, empty for a node that is alone in its run.

    Nulls sort first and are fields like others; null values of ``group`` are
    one group. Rows with equal ``order_by`` are ordered by leaf, and equal rows
    all stay. Texts may have any length, also none. An empty table gives no
    rows, and other columns of the table are not looked at.
    """
    tampered = tampered or {}
    changed = leaf_digest([tampered.get(f, f) for f in fields])
    own = leaf_digest(fields)
    leaves = spool(
        docs.select(
            F.col(order_by).alias("id"),
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
            own.alias("digest"),
            (F.when(_touched(tampered), changed) if tampered else F.lit(None).cast("string")).alias("other"),
        ),
        "leaves",
    )
    rows, subroots = _trees(leaves, ["id", "other"], arity, block_nodes)
    groups = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), F.col("root").alias("digest"))
    tops, roots = _trees(groups, ["id"], arity, block_nodes)
    above = tops.select(
        F.col("id").alias("grp"), F.col("digest").alias("subroot"), F.col("pos").alias("group_pos"),
        F.col("proof").alias("group_proof"), "grp_root",
    )
    return lookup_join(rows.drop("grp_root"), spool(above.withColumnRenamed("grp_root", "root"), "subroots"), ["grp"], "inner").select(
        F.col("id").alias(order_by), F.col("digest").alias("leaf"), F.col("other").alias("tampered"),
        "pos", "proof", "subroot", "group_pos", "group_proof", "root",
    )


def _touched(tampered: dict[str, Column]) -> Column:
    """Whether any replaced column differs from the table's own."""
    from functools import reduce

    return reduce(lambda a, b: a | b, [~value.eqNullSafe(F.col(name)) for name, value in tampered.items()])


def fold(proof: Column, start: Column, pos: Column, arity: int = ARITY) -> Column:
    """The digest that a leaf's digest and its proof lead to."""

    def up(state: Column, entry: Column) -> Column:
        left = (state["pos"] % arity).cast("int") * HEX
        joined = F.concat(F.substr(entry, F.lit(1), left), state["digest"], F.substr(entry, left + 1))
        return F.struct(F.sha2(joined, 256).alias("digest"), F.floor(state["pos"] / arity).cast("long").alias("pos"))

    first = F.struct(start.alias("digest"), pos.cast("long").alias("pos"))
    return F.aggregate(proof, first, up, lambda state: state["digest"])


def _trees(leaves: DataFrame, payload: list[str], arity: int, block_nodes: int) -> tuple[DataFrame, DataFrame]:
    """The trees over the leaves (``grp``, ``id``, ``digest``...) of each ``grp``.

    Returns the leaves with ``pos``, ``proof`` and ``grp_root``, and the root of each ``grp``.
    """
    placed = _placed(leaves)
    most = placed.agg(F.max("total")).first()[0] or 0
    depth = 0
    while arity**depth < most:
        depth += 1
    nodes, roots = _nodes(placed, payload, depth, arity, block_nodes)
    roots = spool(roots, "roots")
    proofs = _jump(nodes, depth, arity)
    return lookup_join(proofs, roots.withColumnRenamed("root", "grp_root"), ["grp"], "inner"), roots


def _placed(leaves: DataFrame) -> DataFrame:
    """Add ``pos``, the place of each leaf in its group from 0, and ``total``, the group's leaves.

    Leaves are cut into ranges and sorted there; only one row per range and group is put in order.
    """
    order = ["grp", F.col("id").asc_nulls_first(), "digest", "line"]
    cut = spool(
        leaves.withColumn("line", F.monotonically_increasing_id())  # deals equal rows to several ranges
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("line")
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("row", 33)),
        "ranges",
    )
    whole = Window.partitionBy("grp")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy("grp", "part")
        .agg(F.count("*").alias("n"), F.min("row").alias("first"))
        .select(
            "grp", "part", "first",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(whole).alias("total"),
        )
    )
    placed = lookup_join(cut, spool(starts, "starts"), ["grp", "part"], "inner")
    return placed.withColumn("pos", F.col("start") + F.col("row") - F.col("first")).drop("part", "row", "first", "start")


def _nodes(
    placed: DataFrame, payload: list[str], depth: int, arity: int, block_nodes: int
) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots, with the digests next to them, and the roots.

    A block of consecutive nodes builds several levels in its row, so a tree
    takes one shuffle for each ``block_nodes`` it is wide, not one per level.
    """
    high = 1
    while arity ** (high + 1) <= block_nodes:
        high += 1
    tiers, roots, base = [], [], 0
    below = placed.withColumn("payload", F.struct(*payload)).select("grp", "pos", "total", "digest", "payload")
    while True:
        blocks = _blocks(below, arity, high, base == 0)
        blocks = spool(blocks, f"tree-{base}")
        width = F.ceil(F.col("total") / F.lit(float(arity**high))).cast("long")
        top = F.element_at("levels", -1)
        tiers.append(_explode(blocks, arity, high, base))
        roots.append(blocks.where((F.size(top) == 1) & (width == 1)).select("grp", F.element_at(top, 1).alias("root")))
        base += high
        if base >= depth:
            break
        below = blocks.where(width > 1).select(
            "grp", F.col("block").alias("pos"), width.alias("total"), F.element_at(top, 1).alias("digest")
        )
    nodes, found = tiers[0], roots[0]
    for more, root in zip(tiers[1:], roots[1:]):
        nodes, found = nodes.unionByName(more, allowMissingColumns=True), found.unionByName(root)
    return spool(nodes, "nodes"), found


def _blocks(nodes: DataFrame, arity: int, high: int, leaves: bool) -> DataFrame:
    """Consecutive nodes in one row with ``levels``: their digests, those of the nodes above, up to ``high`` levels up.

    Fewer where the whole level has one node already.
    """

    def grow(levels: Column, step: Column) -> Column:
        last = F.element_at(levels, -1)
        above = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(last) - 1) / arity).cast("int")),
            lambda i: F.sha2(F.array_join(F.slice(last, i * arity + 1, F.lit(arity)), ""), 256),
        )
        return F.when(F.col("total") > F.pow(F.lit(float(arity)), step - 1), F.concat(levels, F.array(above))).otherwise(levels)

    kept = ["pos", "digest"] + (["payload"] if leaves else [])
    grouped = nodes.groupBy("grp", F.floor(F.col("pos") / arity**high).cast("long").alias("block")).agg(
        F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct(*kept))).alias("found")
    )
    levels = F.aggregate(F.sequence(F.lit(1), F.lit(high)), F.array(F.col("found.digest")), grow)
    return grouped.select("grp", "block", "total", *([F.col("found.payload").alias("payload")] if leaves else []), levels.alias("levels"))


def _explode(blocks: DataFrame, arity: int, high: int, base: int) -> DataFrame:
    """One row for each node of the blocks that has a node above, and for each leaf: its place and its entry of proofs."""
    levels = blocks.select("*", F.posexplode("levels").alias("level", "digests")).where(F.col("level") < high)
    if base:
        levels = levels.where(F.col("level") < F.size("levels") - 1)
    else:
        levels = levels.where((F.col("level") < F.size("levels") - 1) | (F.col("level") == 0))
    i = F.col("i")
    low = i - i % arity
    others = F.concat(F.slice("digests", low + 1, i - low), F.slice("digests", i + 2, low + arity - i - 1))
    alone = F.size("levels") == 1
    nodes = levels.select("*", F.posexplode("digests").alias("i", "digest"))
    place = F.col("block") * F.pow(F.lit(float(arity)), high - F.col("level")).cast("long") + i
    entry = F.array_join(others, "")
    out = nodes.select(
        "grp", (F.col("level") + base).alias("level"), place.alias("pos"),
        F.when(alone, F.array().cast("array<string>")).otherwise(F.array(entry)).alias("proof"),
        *([F.when(F.col("level") == 0, F.col("digest")).alias("digest"),
           F.when(F.col("level") == 0, F.get("payload", i)).alias("payload")] if base == 0 else []),
    )
    return out


def _jump(nodes: DataFrame, depth: int, arity: int) -> DataFrame:
    """The proofs of all leaves by pointer jumping.

    Every node holds the entries towards its ancestor ``step`` levels up. In a
    round the nodes of every second of those levels join their ancestors'
    segments to their own, which doubles the step; the others are not needed
    any more. A node whose ancestor is the root, or lies above it, has none to
    join. No ancestor has more than ``arity ** step`` nodes below it, and
    there are fewer ancestors by the same factor.
    """
    step = 1
    while step < depth:
        lower = nodes.where(F.col("level") % (2 * step) == 0)
        upper = nodes.where(F.col("level") % (2 * step) == step).select(
            "grp", (F.col("level") - step).alias("level"), F.col("pos").alias("up"), F.col("proof").alias("rest")
        )
        joined = lower.withColumn("up", F.floor(F.col("pos") / arity**step).cast("long")).join(upper, ["grp", "level", "up"], "left")
        nodes = spool(
            joined.select(
                "grp", "level", "pos", F.concat("proof", F.coalesce("rest", F.array().cast("array<string>"))).alias("proof"),
                "digest", "payload",
            ),
            f"jump-{step}",
        )
        step *= 2
    return nodes.where(F.col("level") == 0).select("grp", "pos", "proof", "digest", "payload.*")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with a seventh of them tampered with when they are verified."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chosen = F.crc32(F.col("doc_id").cast("string")) % _TAMPER_DIVISOR == 0
    tampered = {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    made = manifest(docs, tampered=tampered)
    subroot = fold(F.col("proof"), F.coalesce("tampered", "leaf"), F.col("pos"))
    folded = made.withColumn("folded_root", fold(F.col("group_proof"), subroot, F.col("group_pos")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.concat("proof", "group_proof"), ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle_sql() -> str:
    """The same manifest level by level; the checksum of an id is taken bit by bit."""
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf, other = (
        "sha256(" + " || ".join(field.format(c) for c in (*FIELDS[:3], n_chars, *FIELDS[4:])) + ")"
        for n_chars in ("n_chars", "(n_chars + 1)")
    )
    bits = (
        "list_transform(range(8 * strlen(CAST(doc_id AS VARCHAR))),"
        " lambda i: (ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER)) & 1)"
    )
    crc = (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, CAST({bits} AS BIGINT[])),"
        " lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384)), 4294967295)"
    )
    return f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, {leaf} AS leaf,
               CASE WHEN {crc} % 7 = 0 AND doc_id IS NOT NULL AND n_chars IS NOT NULL THEN {other} END AS other,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp
        FROM documents),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    tree AS (
        SELECT grp, 0 AS level, pos, leaf AS digest FROM placed
        UNION ALL
        SELECT grp, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM tree) WHERE n > 1 GROUP BY grp, level, pos // 2),
    tops AS (
        SELECT grp, level AS height, digest AS subroot FROM tree
        QUALIFY row_number() OVER (PARTITION BY grp ORDER BY level DESC) = 1),
    crown AS (
        SELECT 0 AS level, grp AS pos, subroot AS digest FROM tops
        UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER () AS n FROM crown) WHERE n > 1 GROUP BY level, pos // 2),
    top AS (SELECT level AS height, digest AS root FROM crown ORDER BY level DESC LIMIT 1),
    steps AS (
        SELECT p.grp, p.pos, level.i AS step, t.digest, (p.pos >> level.i) & 1 AS side
        FROM placed p JOIN tops USING (grp), LATERAL (SELECT unnest(range(height)) AS i) level
        LEFT JOIN tree t ON t.grp = p.grp AND t.level = level.i AND t.pos = xor(p.pos >> level.i, 1)
        UNION ALL
        SELECT p.grp, p.pos, tops.height + level.i, c.digest, (p.grp >> level.i) & 1
        FROM placed p JOIN tops USING (grp), top, LATERAL (SELECT unnest(range(top.height)) AS i) level
        LEFT JOIN crown c ON c.level = level.i AND c.pos = xor(p.grp >> level.i, 1)),
    folds AS (
        SELECT grp, pos, 0 AS step, coalesce(other, leaf) AS digest FROM placed
        UNION ALL
        SELECT f.grp, f.pos, f.step + 1,
               sha256(CASE s.side WHEN 1 THEN coalesce(s.digest, '') || f.digest ELSE f.digest || coalesce(s.digest, '') END)
        FROM folds f JOIN steps s USING (grp, pos, step)),
    folded AS (
        SELECT grp, pos, digest AS folded_root FROM folds
        QUALIFY row_number() OVER (PARTITION BY grp, pos ORDER BY step DESC) = 1),
    proofs AS (
        SELECT grp, pos, sha256(coalesce(string_agg(digest, '' ORDER BY step), '')) AS proof_sha256
        FROM placed LEFT JOIN steps USING (grp, pos) GROUP BY grp, pos)
    SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
    FROM placed JOIN tops USING (grp) JOIN proofs USING (grp, pos) JOIN folded USING (grp, pos), top"""
