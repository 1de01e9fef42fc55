"""Near-duplicate documents: ProbMinHash of weighted word shingles, bands, verification, groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import batches, doc_key, hash_words, key_to_id, mix, rolling, spool, whole_text
from newsloom.llm.links import components

SHINGLE = 5
LEAST_SIMILARITY = 0.8
ROWS, BANDS = 4, 24
REGISTERS = ROWS * BANDS
#: Members of a bucket up to which all pairs of different groups are verified at once.
SMALL_BUCKET = 64
#: Texts that are compared with one text in one task.
CHUNK = 200
#: Texts and distinct shingles of one side of a block, whose pairs are compared in one task.
BLOCK_TEXTS, BLOCK_SHINGLES = 400, 1_000_000
BATCH_BYTES = 4 << 20

_STEPS = np.asarray([b for b in range(REGISTERS) if np.gcd(b, REGISTERS) == 1], dtype=np.uint64)
_SEED = np.uint64(0x2545F4914F6CDD1D)


def shingles(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: document, hash, count; and a hash of each text's words.

    A text with fewer than five words has all its words as one shingle, one
    without words has none.
    """
    words = hash_words(column)
    docs, sizes = words.docs, np.diff(words.first)
    windows = rolling(words.hashes, SHINGLE)
    n = len(windows)
    at = np.flatnonzero(docs[:n] == docs[SHINGLE - 1 :][:n]) if n else np.zeros(0, dtype=int)
    owner, value = docs[at], windows[at]
    whole = np.asarray(
        [xxhash.xxh64_intdigest(words.hashes[a:b].tobytes()) for a, b in zip(words.first[:-1], words.first[1:])], dtype=np.uint64
    )
    second = np.asarray(
        [xxhash.xxh64_intdigest(words.hashes[a:b].tobytes(), seed=1) for a, b in zip(words.first[:-1], words.first[1:])],
        dtype=np.uint64,
    )
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    owner, value = np.concatenate([owner, short]), np.concatenate([value, whole[short]])
    keys = mix(value + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    new = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])[: len(order)])
    counts = np.diff(np.append(new, len(order)))
    first = order[new]
    return owner[first], value[first], counts, np.stack([whole, second], axis=1)


def probminhash(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """For each text the shingle that arrives first at each register; 0 for a text without shingles.

    A shingle arrives at all registers one after the other, in an order and
    at times that its hash fixes: the waiting times are exponential, at a rate
    of its weight, slower as fewer registers are left. Two texts agree in a
    register with their probability Jaccard similarity. A shingle stops as
    soon as its next arrival comes after the last of the text's registers was
    taken, so most of them arrive once.
    """
    times = np.full(texts * registers, np.inf)
    taken = np.zeros(texts * registers, dtype=np.uint64)
    path = mix(value ^ _SEED)
    step = _STEPS[(path % np.uint64(len(_STEPS))).astype(np.int64)] if registers == REGISTERS else np.ones(len(path), np.uint64)
    start = (path >> np.uint64(32)) % np.uint64(registers)
    base, at = owner.astype(np.int64) * registers, np.zeros(len(value))
    for arrival in range(registers):
        draw = mix(value + np.uint64((arrival + 1) * 0xD1B54A32D192ED03 % 2**64))
        uniform = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        at = at - np.log1p(-uniform) / weight * (registers / (registers - arrival))
        cell = base + ((start + np.uint64(arrival) * step) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(times, cell, at)
        won = times[cell] == at
        taken[cell[won]] = value[won]
        last = times.reshape(texts, registers).max(1)
        go = at < last[base // registers]
        if not go.any():
            break
        value, weight, step, start, base, at = value[go], weight[go], step[go], start[go], base[go], at[go]
    return taken.reshape(texts, registers)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash of each band: registers that lie far from each other, and the band's number."""
    rows = signatures.reshape(len(signatures), -1, bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    for i in range(rows.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key


def similarity(hash_a, count_a, hash_b, count_b) -> float:
    """Probability Jaccard similarity of two multisets; the Jaccard similarity if no shingle repeats."""
    _, at_a, at_b = np.intersect1d(hash_a, hash_b, assume_unique=True, return_indices=True)
    if not len(at_a):
        return 0.0
    x, y = count_a[at_a].astype(float), count_b[at_b].astype(float)
    only_a, only_b = float(count_a.sum()) - x.sum(), float(count_b.sum()) - y.sum()
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, side="right")
    below, above = np.append(0, np.cumsum(x)), np.append(np.cumsum(y[::-1])[::-1], 0)
    return float((1 / ((only_a + below[upto]) / x + (only_b + above[upto]) / y)).sum())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("key"), F.xxhash64(whole_text()).alias("copy"), whole_text().alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """key, copy, two hashes of the words, and the band keys (none for a text without words)."""

    def sign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", BATCH_BYTES):
            n = table.num_rows
            owner, value, count, whole = shingles(table["text"])
            keys = band_keys(probminhash(owner, value, count.astype(float), n)).view(np.int64)
            has = np.bincount(owner, minlength=n) > 0
            offsets = np.append(0, np.cumsum(np.where(has, BANDS, 0))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    table["key"].combine_chunks(),
                    table["copy"].combine_chunks(),
                    pa.array(whole[:, 0].copy().view(np.int64)),
                    pa.array(whole[:, 1].copy().view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[has].reshape(-1))),
                ],
                names=["key", "copy", "whole", "whole2", "bands"],
            )

    return _texts(docs).mapInArrow(sign, "key long, copy long, whole long, whole2 long, bands array<long>")


def _shingle_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sorted shingle hashes, their counts and their number for the texts of ``nodes`` (node, key, copy)."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "text", BATCH_BYTES):
            owner, value, count, _ = shingles(table["text"])
            order = np.lexsort((value, owner))
            owner, value, count = owner[order], value[order], count[order].astype(np.uint32)
            ends = np.searchsorted(owner, np.arange(table.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    table["node"].combine_chunks(),
                    pa.array([value[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    pa.array([count[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    pa.array(np.diff(ends).astype(np.int64)),
                ],
                names=["node", "hashes", "counts", "size"],
            )

    texts = _texts(docs).join(nodes, ["key", "copy"]).select("node", "text")
    return texts.mapInArrow(cut, "node long, hashes binary, counts binary, size long").dropDuplicates(["node"])


def verify(pairs: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that are similar; texts compared with one text come in groups of bounded size."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = pairs.join(sizes, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
    members = dealt.select("a", "chunk", F.col("b").alias("node"))
    heads = dealt.select("a", "chunk").distinct().withColumn("node", F.col("a"))
    sides = members.unionByName(heads).join(table, "node")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        nodes = part["node"].tolist()
        head = int(part["a"].iloc[0])
        hashes = [np.frombuffer(x, dtype=np.uint64) for x in part["hashes"]]
        counts = [np.frombuffer(x, dtype=np.uint32) for x in part["counts"]]
        at = nodes.index(head)
        near = [
            node
            for node, h, c in zip(nodes, hashes, counts)
            if node != head and similarity(hashes[at], counts[at], h, c) >= least - 1e-12
        ]
        return pd.DataFrame({"a": [head] * len(near), "b": near}).astype("int64")

    return sides.groupBy("a", "chunk").applyInPandas(compare, "a long, b long")


def _blocks(members: DataFrame, nodes: DataFrame, table: DataFrame, across: bool = True) -> DataFrame:
    """Members of buckets (bucket, band, node, root) dealt to blocks of two parts, with their bands and shingles.

    A part holds texts and shingles of bounded number. The members of a
    bucket's largest group form parts that meet all parts of the others but
    not each other, so a text beside very many of one group costs one
    comparison for each of them. Without ``across`` all parts meet each other.
    """
    sized = members.select("bucket", "band", "node", "root").join(table.select("node", "size"), "node")
    counts = sized.groupBy("bucket", "root").agg(F.count("*").alias("texts"))
    largest = counts.groupBy("bucket").agg(F.max(F.struct("texts", "root"))["root"].alias("largest"))
    sized = sized.join(largest, "bucket").withColumn("free", F.col("root") != F.col("largest") if across else F.lit(True))
    n_parts = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    sides = sized.groupBy("bucket", "free").agg(n_parts.alias("parts"))
    sides = sides.groupBy("bucket").agg(
        F.sum(F.when(F.col("free"), F.col("parts")).otherwise(0)).alias("own"),
        F.sum(F.when(F.col("free"), 0).otherwise(F.col("parts"))).alias("rest"),
    )
    part = "IF(free, pmod(xxhash64(node), greatest(own, 1)), own + pmod(xxhash64(node), greatest(rest, 1)))"
    meets = "transform(sequence(0, IF(free, own + rest, own) - 1), x -> struct(least(x, part) AS low, greatest(x, part) AS high))"
    dealt = sized.join(sides, "bucket").withColumn("part", F.expr(part)).withColumn("block", F.explode(F.expr(meets)))
    dealt = dealt.select("bucket", "band", "node", "root", "part", "block.low", "block.high")
    return dealt.join(nodes.select("node", "bands"), "node").join(table, "node")


def similar_in_block(part: pd.DataFrame, least: float, across: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Places in the sorted block of a text and of those similar to it.

    A pair is compared in the first band it shares only. With ``across`` texts
    of one group are not compared, and groups that are linked become one.
    """
    part = part.sort_values(["part", "node"], ignore_index=True)
    own, root, bands, band = part["part"].to_numpy(), part["root"].to_numpy().copy(), np.stack(part["bands"]), int(part["band"].iat[0])
    hashes = [np.frombuffer(x, dtype=np.uint64) for x in part["hashes"]]
    counts = [np.frombuffer(x, dtype=np.uint32) for x in part["counts"]]
    first = np.append(0, np.cumsum([len(h) for h in hashes]))
    values, ids = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.concatenate(counts).astype(np.int64)
    total = np.add.reduceat(count, first[:-1])
    mark = np.zeros(len(values), dtype=np.int64)
    split = int((own == part["low"].iat[0]).sum())
    for i in range(split):
        low = i + 1 if split == len(own) else split
        asked = ~(bands[low:, :band] == bands[i, :band]).any(1)
        if across:
            asked &= root[low:] != root[i]
        if not asked.any():
            continue
        mine = slice(first[i], first[i + 1])
        mark[ids[mine]] = count[mine]
        x, y, starts = mark[ids[first[low] :]], count[first[low] :], first[low:-1] - first[low]
        mark[ids[mine]] = 0
        common = np.add.reduceat((x > 0).astype(np.int64), starts)
        score = common / (total[i] + total[low:] - common)  # right if no common shingle repeats
        repeats = asked & (np.add.reduceat(((x > 0) & (x + y > 2)).astype(np.int64), starts) > 0)
        if repeats.any():
            score[repeats] = 0
            most = np.add.reduceat(np.minimum(x / total[i], y / np.repeat(total[low:], np.diff(first[low:]))), starts)
            for j in np.flatnonzero(repeats & (most >= least - 1e-9)):
                score[j] = similarity(hashes[i], counts[i], hashes[low + j], counts[low + j])
        near = low + np.flatnonzero(asked & (score >= least - 1e-12))
        if across:  # one link for each other group
            near = near[np.unique(root[near], return_index=True)[1]]
            root[np.isin(root, root[near])] = root[i]
        if len(near):
            yield i, near


def _links_across(members: DataFrame, nodes: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Links between all groups of a bucket that have a similar pair, every pair of their members being compared."""

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        node = part.sort_values(["part", "node"])["node"].to_numpy()
        pairs = [(node[i], node[j]) for i, near in similar_in_block(part, least, True) for j in near]
        return pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")

    return _blocks(members, nodes, table).groupBy("bucket", "low", "high").applyInPandas(compare, "a long, b long")


def every_link(members: DataFrame, nodes: DataFrame, table: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Links that join all groups, and how many texts each text (node) is similar to, of all that share a bucket with it.

    Every pair is compared once, in the first band it shares: in small buckets
    pair by pair, in large ones block by block. A block gives each text's
    number of links and the first text of its group there, not the pairs.
    """
    own = members.where(F.col("n") <= SMALL_BUCKET).join(nodes.select("node", "bands"), "node")
    other = own.select("bucket", F.col("node").alias("b"), F.col("bands").alias("others"))
    pairs = (
        own.select("bucket", "band", F.col("node").alias("a"), "bands").join(other, "bucket")
        .where("a < b AND NOT arrays_overlap(slice(bands, 1, band), slice(others, 1, band))")
        .select("a", "b")
    )
    found = spool(verify(spool(pairs, "pairs"), table, least), "links")

    def count(part: pd.DataFrame) -> pd.DataFrame:
        node = part.sort_values(["part", "node"])["node"].to_numpy()
        n, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        for i, near in similar_in_block(part, least, False):
            n[i] += len(near)
            n[near] += 1
            joined = np.unique(np.append(root[near], root[i]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
        own = n > 0
        return pd.DataFrame({"node": node[own], "count": n[own], "root": node[root[own]]})

    large = members.where(F.col("n") > SMALL_BUCKET).withColumn("root", F.col("node"))
    blocks = _blocks(large, nodes, table, across=False).groupBy("bucket", "low", "high")
    blocks = spool(blocks.applyInPandas(count, "node long, count long, root long"), "counts")
    ends = [found.select(F.col(c).alias("node"), F.lit(1).cast("long").alias("count")) for c in ("a", "b")]
    counts = blocks.select("node", "count").unionByName(ends[0]).unionByName(ends[1])
    links = found.unionByName(blocks.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    return links, counts.groupBy("node").agg(F.sum("count").alias("count"))


def _open_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of buckets that still hold several groups: bucket, band, node, n, score and the group's root."""
    roots = components(links).select(F.col("id").alias("node"), "root")
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    still = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return spool(named.join(still.select("bucket"), "bucket"), "open")


def _star(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Each bucket's hub with the bucket's members of other groups."""
    best = F.max(F.struct("score", (-F.col("node")).alias("node"), "root")).alias("hub")
    hubs = hubs.groupBy("bucket").agg(best).select("bucket", (-F.col("hub.node")).alias("a"), F.col("hub.root").alias("root_a"))
    return members.join(hubs, "bucket").where("node != a AND root != root_a").select("a", F.col("node").alias("b"), "bucket", "root_a")


def _cross_pairs(members: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that are in different groups."""
    other = members.select("bucket", F.col("node").alias("b"), F.col("root").alias("root_b"))
    return (
        members.select("bucket", F.col("node").alias("a"), "root").join(other, "bucket")
        .where("a < b AND root != root_b").select("a", "b")
    )


def _finer(members: DataFrame) -> DataFrame:
    """Buckets of texts that share two bands, the next one or the seventh after each."""
    own = members.groupBy("node", "score", "root").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "bucket"))).alias("own")
    )
    keys = F.concat(
        *(
            F.expr(f"transform(filter(map_keys(own), i -> own[{after}] IS NOT NULL), i -> xxhash64(own[i], own[{after}]))")
            for after in (f"(i + 1) % {BANDS}", f"(i + 7) % {BANDS}")
        )
    )
    return own.select("node", "score", "root", F.explode(keys).alias("bucket"))


def link_texts(docs: DataFrame, least: float = LEAST_SIMILARITY, degrees: bool = True) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Texts with their node, each linked node's number of links (if ``degrees``), and its root.

    Texts with the same words are one node. With ``degrees`` all pairs of a
    bucket are compared, once each (``every_link``); without, as many as the
    groups need (``_group_links``). Either way every pair that shares a bucket is in
    one group or was found not similar.
    """
    texts = spool(signatures(docs), "signatures")
    classes = texts.groupBy("whole", "whole2").agg(F.min(F.struct("key", "copy")).alias("first"), F.min("bands").alias("bands"))
    nodes = spool(
        classes.withColumn("node", F.monotonically_increasing_id()).select("node", "whole", "whole2", "first.*", "bands"), "nodes"
    )
    members = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = spool(members.join(shared, "bucket"), "members")
    scores = members.groupBy("node").agg(F.sum("n").alias("score"))
    table = spool(_shingle_table(docs, nodes.join(scores, "node").select("node", "key", "copy")), "shingles")
    if degrees:
        links, counted = every_link(members, nodes, table, least)
    else:
        links, counted = _group_links(spool(members.join(scores, "node"), "scored"), nodes, table, least), None
    return texts.join(nodes.select("node", "whole", "whole2", F.col("key").alias("class")), ["whole", "whole2"]), counted, components(links)


def _group_links(members: DataFrame, nodes: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Links that join all groups, with fewer comparisons than all pairs of a bucket.

    In every bucket the members are
    verified against its hub, the member that shares most buckets with
    others, as the origin of many copies does; so a bucket takes one
    comparison a member, however many similar texts share it. Then, while
    links are found: in buckets where several groups are left, all pairs of
    different groups are verified if the bucket is small; in a larger one a
    hub of another group than the first one's is compared with all members,
    and so are the hubs of the finer buckets of texts that share two bands.
    At last, in the larger buckets that still hold several groups, all pairs of
    different groups are compared, block by block.
    """
    alone = members.withColumn("root", F.col("node"))
    tested = spool(_once(_star(alone, alone)), "star")
    links = spool(verify(tested, table, least), "links")
    while True:  # each time on merges groups, so this ends
        rest = _open_members(members, links)
        large = rest.where(F.col("n") > SMALL_BUCKET)
        others = _star(large, large).select("bucket", F.col("b").alias("node")).join(large, ["bucket", "node"])
        finer = _finer(large)
        pairs = (
            _cross_pairs(rest.where(F.col("n") <= SMALL_BUCKET))
            .unionByName(_star(large, others).select("a", "b"))
            .unionByName(_star(finer, finer).select("a", "b"))
        )
        pairs = spool(_once(pairs).join(tested, ["low", "high"], "left_anti"), "pairs")
        found = spool(verify(pairs, table, least), "links")
        if found.isEmpty():
            break
        links, tested = links.unionByName(found), tested.unionByName(pairs)
    return links.unionByName(spool(_links_across(large, nodes, table, least), "links"))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, whichever of the two is its hub; ``low`` and ``high`` name it."""
    ends = pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"), F.col("a").alias("hub"))
    hubs = ends.groupBy("low", "high").agg(F.min("hub").alias("a"))
    return hubs.select("low", "high", "a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"))


def _groups(docs: DataFrame, least: float, degrees: bool) -> tuple[DataFrame, DataFrame | None]:
    """key, copy, class, node, group and kept for every row of ``docs``, and the nodes' numbers of links."""
    texts, counted, roots = link_texts(docs, least, degrees)
    rows = spool(
        texts.join(roots.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .select("key", "copy", "class", "node", "root", (F.size("bands") > 0).alias("has_words")),
        "groups",
    )
    first = rows.groupBy("root").agg(F.min(F.struct("key", "copy")).alias("first"))
    named = rows.join(first, "root").select(
        "key", "copy", "class", "node", F.col("first.key").alias("group"),
        ((F.struct("key", "copy") == F.col("first")) | ~F.col("has_words")).alias("kept"),
    )
    return named, counted


def near_duplicates(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """key, copy, class, group, n_links and kept for every row of ``docs``.

    Two texts are linked if the probability Jaccard similarity of their
    five-word shingles, weighted by how often they occur, is at least
    ``least`` and they share a bucket. ``class`` is the least id of the texts
    with the same words, ``group`` that of all texts reachable by links,
    ``n_links`` how many other classes this one is linked to, all pairs of a
    bucket being compared. One text of a group is kept, the first by id, then
    by hash; rows with equal id and text are one text and all are marked. A
    text without words is linked to nothing but is of the class of all such
    texts, which are kept. Null ids sort first.
    """
    rows, counted = _groups(docs, least, degrees=True)
    n_links = F.coalesce("count", F.lit(0)).alias("n_links")
    return rows.join(counted, "node", "left").select("key", "copy", "class", "group", n_links, "kept")


def keep_one(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """One document of each group, its columns unchanged; of rows with equal id and text one stays."""
    kept = _groups(docs, least, degrees=False)[0].where("kept").select("key", "copy").distinct()
    taken = {c.lower() for c in docs.columns}
    key, copy = (next(n for n in (f"{p}{i}" for i in range(len(taken) + 1)) if n not in taken) for p in "kc")
    named = docs.withColumns({key: doc_key(), copy: F.xxhash64(whole_text())})
    kept = kept.select(F.col("key").alias(key), F.col("copy").alias(copy))
    return named.join(kept, [key, copy]).dropDuplicates([key, copy]).select(*docs.columns)


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, group_id, n_links and kept of every document."""
    rows = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        key_to_id().alias("doc_id"), key_to_id("class").alias("class_id"), key_to_id("group").alias("group_id"), "n_links", "kept"
    )
