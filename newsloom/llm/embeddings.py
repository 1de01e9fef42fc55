"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one vector per group kept."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import spool
from newsloom.llm.links import components

LEAST_COSINE = 0.93
#: Vectors in a block; a product of two blocks is one unit of work.
BLOCK_ROWS = 1024
#: Vectors of a label that its cells are fitted on at most, and cells at most.
SAMPLE_ROWS = 8_192
MOST_CELLS = 128
ROUNDS = 6
_KEY = ["label", "dim"]


def spherical_kmeans(unit: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors; starts from evenly spaced rows, so it always ends the same way."""
    centroids = unit[np.linspace(0, len(unit) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        near = (unit @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, unit)
        norms = np.linalg.norm(sums, axis=1)
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def _unit(vectors) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(1, keepdims=True)  # so that no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that can have links: a label, and a vector of finite numbers that is not zero."""
    finite = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return vectors.where(f"label IS NOT NULL AND {finite} AND exists(embedding, x -> x != 0)").withColumn(
        "dim", F.size("embedding")
    )


def _cells(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Centroids of each label and length that has more than one block."""
    large = counts.where(F.col("n") > BLOCK_ROWS).withColumn(
        "cells", F.least(F.lit(MOST_CELLS), F.ceil(F.col("n") / BLOCK_ROWS)).cast("int")
    )
    chosen = (
        rows.join(large, _KEY)
        .where(F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / SAMPLE_ROWS)) == 0)
        .select(*_KEY, "cells", "rid", "embedding")
    )

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rid")
        unit = _unit(part["embedding"])
        found = spherical_kmeans(unit, min(int(part["cells"].iloc[0]), len(unit)))
        return pd.DataFrame(
            {"label": part["label"].iloc[0], "dim": part["dim"].iloc[0], "centroids": [found.tobytes()]}
        )

    return chosen.groupBy(*_KEY).applyInPandas(train, f"{_types(rows)}, centroids binary")


def _types(rows: DataFrame) -> str:
    return f"label {rows.schema['label'].dataType.simpleString()}, dim int"


def _assign(rows: DataFrame, counts: DataFrame, centroids: DataFrame) -> DataFrame:
    """The cell of each row; parts of a label of bounded size see its centroids."""
    parts = counts.withColumn("parts", F.ceil(F.col("n") / (8 * BLOCK_ROWS)).cast("int")).select(*_KEY, "parts")
    dealt = rows.join(parts, _KEY).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")).drop("parts")
    wanted = centroids.join(parts, _KEY).select(*_KEY, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "centroids")

    def nearest(part: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        part = part[["rid", "label", "dim", "embedding"]].assign(cell=0)
        if len(cells) and len(part):
            found = np.frombuffer(cells["centroids"].iloc[0]).reshape(-1, int(part["dim"].iloc[0]))
            part["cell"] = (_unit(part["embedding"]) @ found.T).argmax(1)
        return part

    key = [*_KEY, "part"]
    return dealt.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInPandas(
        nearest, f"rid long, {_types(rows)}, embedding array<double>, cell int"
    )


def _blocks(assigned: DataFrame) -> DataFrame:
    """Each cell cut into blocks: packed ids and unit vectors, the mean direction and the greatest angle to it."""
    key = [*_KEY, "cell"]
    sizes = assigned.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("subs"))
    dealt = assigned.join(sizes, key).withColumn("sub", F.pmod(F.xxhash64("rid"), F.col("subs")).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rid")
        unit = _unit(part["embedding"])
        mean = unit.sum(0)
        norm = np.linalg.norm(mean)
        mean = mean / norm if norm > 0 else unit[0]
        radius = float(np.arccos(np.clip(unit @ mean, -1, 1)).max())
        return pd.DataFrame(
            {
                "label": part["label"].iloc[0],
                "dim": part["dim"].iloc[0],
                "cell": part["cell"].iloc[0],
                "sub": part["sub"].iloc[0],
                "rids": [part["rid"].to_numpy(np.int64).tobytes()],
                "unit": [unit.tobytes()],
                "mean": [mean],
                "radius": [radius],
            }
        )

    schema = f"{_types(assigned)}, cell int, sub int, rids binary, unit binary, mean array<double>, radius double"
    return dealt.groupBy(*key, "sub").applyInPandas(pack, schema)


def _close_blocks(blocks: DataFrame, least: float) -> DataFrame:
    """Pairs of blocks of a label that may hold a link: by the triangle inequality of angles."""
    meta = blocks.select(*_KEY, "cell", "sub", "mean", "radius")
    other = meta.select(*_KEY, *(F.col(c).alias(f"{c}2") for c in ("cell", "sub", "mean", "radius")))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.expr("aggregate(zip_with(mean, mean2, (x, y) -> x * y), 0D, (a, x) -> a + x)"))))
    return (
        meta.join(other, _KEY)
        .where("cell < cell2 OR (cell = cell2 AND sub <= sub2)")
        .where(angle <= F.col("radius") + F.col("radius2") + math.acos(least) + 1e-6)
        .select(*_KEY, "cell", "sub", "cell2", "sub2", F.xxhash64(*_KEY, "cell", "sub", "cell2", "sub2").alias("pair"))
    )


def linked_within(rids_a, unit_a, rids_b, unit_b, least: float) -> pd.DataFrame:
    """Links between two blocks (or in one): per row how many, and the least row it reaches there."""
    same = rids_a is rids_b
    hit = unit_a @ unit_b.T >= least
    if same:
        hit &= hit.T
        np.fill_diagonal(hit, False)
    if not hit.any():
        return pd.DataFrame({"rid": [], "n": [], "root": []}).astype("int64")
    a, b = np.nonzero(hit)
    rids = rids_a if same else np.concatenate([rids_a, rids_b])
    b = b if same else b + len(rids_a)
    root = rids.copy()
    while True:  # each row takes the least id of its links until nothing changes
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (before == root).all():
            break
    degree = np.bincount(a, minlength=len(rids)) + (0 if same else np.bincount(b, minlength=len(rids)))
    own = degree > 0
    return pd.DataFrame({"rid": rids[own], "n": degree[own], "root": root[own]})


def link_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """n_links, component_id and kept of every row (vec_id, embedding, label).

    Only vectors of one label and one length are compared, each cosine in
    double precision; two are linked from ``least`` on. A null label, a null or
    zero vector, and one with null or non-finite numbers link with nothing.
    Vectors are dealt to the nearest centroid of their label and cells are cut
    into blocks; all pairs of blocks are multiplied whose mean directions are
    near enough for a link, so no link is lost at a cell's border. Repeated
    rows are vectors of their own; among equal ids with the least id all are
    kept. A null id is no component's id unless all of its members have none.
    """
    rows = spool(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
        ).withColumn("rid", F.monotonically_increasing_id()),
        "vectors",
    )
    usable = _usable(rows).select("rid", "label", "dim", "embedding")
    counts = spool(usable.groupBy(*_KEY).agg(F.count("*").alias("n")), "labels")
    blocks = spool(_blocks(spool(_assign(usable, counts, _cells(usable, counts)), "cells")), "blocks")
    pairs = _close_blocks(blocks, least)
    payload = [*_KEY, "cell", "sub"]
    first = pairs.select("pair", *payload, F.lit(0).alias("side"))
    second = pairs.where("cell != cell2 OR sub != sub2").select(
        "pair", *_KEY, F.col("cell2").alias("cell"), F.col("sub2").alias("sub"), F.lit(1).alias("side")
    )
    sides = first.unionByName(second).join(blocks.select(*payload, "rids", "unit"), payload).select("pair", "side", "dim", "rids", "unit")

    def multiply(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("side")
        dim = int(part["dim"].iloc[0])
        rids = [np.frombuffer(x, dtype=np.int64) for x in part["rids"]]
        unit = [np.frombuffer(x).reshape(-1, dim) for x in part["unit"]]
        return linked_within(rids[0], unit[0], rids[-1], unit[-1], least)

    found = spool(sides.groupBy("pair").applyInPandas(multiply, "rid long, n long, root long"), "found")
    degrees = found.groupBy("rid").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    members = rows.select("rid", "vec_id").join(degrees, "rid", "left").join(roots.withColumnRenamed("id", "rid"), "rid", "left")
    members = spool(members.withColumn("root", F.coalesce("root", "rid")), "members")
    names = members.where("n_links > 0").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return (
        members.join(names, "root", "left")
        .withColumn("component_id", F.coalesce("component_id", "vec_id"))
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked from a cosine of 0.93 within their label."""
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
