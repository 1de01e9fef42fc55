"""The star schema as Parquet folders.

Every load writes what it changes once, into new folders, and then publishes
it: the dimensions and the list of fact months are small numbered tables, and
readers take the last finished one. Facts lie in buckets, one per month and
range of article ids; a load writes the buckets it touches and the list then
names these. A bucket of a month begins at its ``low`` id and ends before the
next one's. One that has grown to more than twice the wanted rows is cut when
it is written. Neighbouring buckets of a month that a load writes share a
folder, a shelf, up to SHELF_ROWS facts, so the number of folders and files
follows the facts and not the size of a bucket. A load that breaks off leaves
folders that nothing names. A shelf is removed after publishing when none of
its buckets is named; when fewer than half are, the load writes these anew.
Until then readers leave out its buckets that have been replaced. A deletion
writes every shelf anew that it touches, so what is deleted is on no disk. A
frame read before a load has to be read again. One load runs at a time.

Beside each bucket lie its counts and sums by source and topic. A load or a
deletion writes those of the buckets it touches, so what the facts it replaces
had added is gone with them, and the totals of all buckets are those of a full
recount, without reading other facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom import schemas
from newsloom.functions.dates import month_key
from newsloom.operators.cleaning import conform
from newsloom.operators.constraints import cascade_delete, split_valid
from newsloom.operators.joins import lookup_join
from newsloom.operators.merging import upsert_facts, upsert_sources, upsert_topics
from newsloom.session import spool
from newsloom.sources.files import children, exists, remove

#: Facts that a bucket is to hold; one with more than twice as many is cut.
BUCKET_ROWS = 1_000_000
#: Facts of small buckets that share a folder.
SHELF_ROWS = 1_000_000
_FACT_PARTITIONED = StructType(list(schemas.FACT.fields)).add("month", "string")
_FACT_FOLDERS = StructType(list(_FACT_PARTITIONED.fields)).add("low", "long").add("version", "integer").add("shelf", "long")
_SUMS = "source_id long, topic_id int, rows long, articles long, score_sum double, scores long, month string, low long, version int, shelf long"
#: ``written`` buckets are in the folder of a version, month and shelf; fewer may be listed.
_BUCKETS = "month string, low long, version int, shelf long, written long"
#: The low id of a month's first bucket.
_LEAST = -(2**63)
#: Ids that a fact is compared with in a step; two steps find its place among the square of that.
_CUTS = 64
#: Parts into which ids of a large bucket are cut at a time, at most.
_PARTS = _CUTS * _CUTS

Bucket = tuple[str, int]


def read_sources(spark: SparkSession, root: str) -> DataFrame:
    return _read_copy(spark, f"{root}/dim_source", schemas.DIM_SOURCE)


def read_topics(spark: SparkSession, root: str) -> DataFrame:
    return _read_copy(spark, f"{root}/dim_topic", schemas.DIM_TOPIC)


def read_facts(spark: SparkSession, root: str) -> DataFrame:
    """All facts with their ``month``; a filter on it prunes folders."""
    return _read(spark, root, _list(spark, root)).drop("low")


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """Counts and sums of the facts by ``month``, ``source_id`` and ``topic_id``, up to date after each load.

    ``rows`` facts, ``articles`` with an id, ``score_sum`` of the ``scores`` importance scores that are set.
    """
    sums = _read(spark, root, _list(spark, root), "fact_sums", StructType.fromDDL(_SUMS))
    totals = [F.sum(c).alias(c) for c in ("rows", "articles", "score_sum", "scores")]
    return sums.groupBy("month", "source_id", "topic_id").agg(*totals)


def _read(
    spark: SparkSession, root: str, buckets: DataFrame, name: str = "fact_article", schema: StructType = _FACT_FOLDERS
) -> DataFrame:
    """The rows of listed ``buckets`` with their ``month`` and ``low``."""
    base, whole, parts = f"{root}/{name}", [], []
    folders = buckets.groupBy("version", "month", "shelf", "written").agg(F.count("*").alias("n")).collect()  # a row for each folder
    for f in sorted(folders):
        path = f"{base}/version={f['version']}/month={f['month']}/shelf={f['shelf']}"
        (whole if f["n"] == f["written"] else parts).append(path)
    reader, key = spark.read.schema(schema).option("basePath", base), ["version", "month", "low"]
    found = [reader.parquet(*whole)] if whole else []
    if parts:
        found.append(lookup_join(reader.parquet(*parts), buckets.select(*key), key, "left_semi"))
    columns = [c for c in schema.fieldNames() if c not in ("version", "shelf")]
    return reduce(DataFrame.unionByName, found or [spark.createDataFrame([], schema)]).select(*columns)


def _read_buckets(spark: SparkSession, root: str, listed: dict[Bucket, int]) -> DataFrame:
    """The facts of some buckets by their names."""
    named = spark.createDataFrame([(*b, v) for b, v in listed.items()], "month string, low long, version int")
    return _read(spark, root, lookup_join(_list(spark, root), named, ["month", "low", "version"], "left_semi"))


def _sums(facts: DataFrame) -> DataFrame:
    score = F.col("importance_score")
    return facts.groupBy("month", "shelf", "low", "source_id", "topic_id").agg(
        F.count("*").alias("rows"), F.count("article_id").alias("articles"),
        F.sum(score).alias("score_sum"), F.count(score).alias("scores"),
    )


def register_views(spark: SparkSession, root: str) -> None:
    """The three tables as views for SQL: dim_news_source, dim_topic, fact_article."""
    read_sources(spark, root).createOrReplaceTempView("dim_news_source")
    read_topics(spark, root).createOrReplaceTempView("dim_topic")
    read_facts(spark, root).createOrReplaceTempView("fact_article")


def load_batch(
    spark: SparkSession,
    root: str,
    scored: DataFrame,
    sources: DataFrame,
    topics: DataFrame,
    bucket_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Upsert one scored batch; gives the refused rows as frames "sources", "topics" and "facts".

    Dimensions are written first, then facts, and loading the same batch again
    changes nothing. A source needs a name, a host and a score in [0, 1]; a
    topic an id, a name and a category; a fact a key, a known source and a
    known topic. Only buckets that hold or get keys of the batch are read and
    written; ``bucket_rows`` is BUCKET_ROWS unless it is given.
    """
    good_sources, bad_sources = split_valid(sources, _source_rule())
    good_topics, bad_topics = split_valid(topics, _all_set(schemas.DIM_TOPIC.fieldNames()))
    _write_copy(upsert_sources(read_sources(spark, root), good_sources), f"{root}/dim_source")
    _write_copy(upsert_topics(read_topics(spark, root), good_topics), f"{root}/dim_topic")

    resolved = resolve(scored, read_sources(spark, root), read_topics(spark, root))
    listed = _list(spark, root)
    facts = spool(_in_buckets(resolved.withColumn("month", month_key(F.col("published_at"))), listed), "facts")
    good, bad = split_valid(facts, _fact_rule())
    placed = good.select(*schemas.FACT.fieldNames(), "month", "low")
    touched = spool(_touched(listed, placed), "touched")
    upserted = upsert_facts(_read(spark, root, touched), placed)
    _write_facts(upserted, root, listed, touched, bucket_rows or BUCKET_ROWS)
    return {"sources": bad_sources, "topics": bad_topics, "facts": bad.drop("month", "low", "_topic_known")}


def resolve(scored: DataFrame, dim_source: DataFrame, dim_topic: DataFrame) -> DataFrame:
    """Scored rows with their source id, null for an unknown name, and whether the topic is known."""
    ids = dim_source.select("source_id", F.col("name").alias("source_name"))
    known = dim_topic.select("topic_id", F.lit(True).alias("_topic_known"))
    joined = lookup_join(lookup_join(scored, ids, ["source_name"]), known, ["topic_id"])
    return conform(joined, StructType(list(schemas.FACT.fields)).add("_topic_known", "boolean"))


def delete_sources(spark: SparkSession, root: str, names: DataFrame) -> None:
    """Delete the sources listed in ``names`` (column name) and all their facts."""
    sources = read_sources(spark, root)
    listed = names.select("name").distinct()
    gone = spool(lookup_join(sources, listed, ["name"], "left_semi"), "gone")
    _drop_facts(spark, root, gone, "source_id")
    _write_copy(lookup_join(sources, gone.select("name"), ["name"], "left_anti"), f"{root}/dim_source")


def delete_topics(spark: SparkSession, root: str, topic_ids: DataFrame) -> None:
    """Delete the topics listed in ``topic_ids`` (column topic_id) and all their facts."""
    gone = spool(topic_ids.select("topic_id").distinct(), "gone")
    _drop_facts(spark, root, gone, "topic_id")
    left = lookup_join(read_topics(spark, root), gone, ["topic_id"], "left_anti")
    _write_copy(left, f"{root}/dim_topic")


def _drop_facts(spark: SparkSession, root: str, gone: DataFrame, key: str) -> None:
    listed = _list(spark, root)
    hit = lookup_join(_read(spark, root, listed), gone.select(key), [key], "left_semi")
    touched = spool(_touched(listed, hit, whole=True), "touched")
    if not touched.isEmpty():
        _write_facts(cascade_delete(_read(spark, root, touched), gone, key), root, listed, touched, BUCKET_ROWS)


def _list(spark: SparkSession, root: str) -> DataFrame:
    """The buckets, each with the folder in which it is to be read."""
    return _read_copy(spark, f"{root}/fact_months", _BUCKETS)


def _listed(spark: SparkSession, root: str) -> dict[Bucket, int]:
    """The version in which each bucket is to be read, for a look at a star of few buckets."""
    return {(row["month"], row["low"]): row["version"] for row in _list(spark, root).collect()}


def _touched(listed: DataFrame, facts: DataFrame, whole: bool = False) -> DataFrame:
    """The listed buckets that are to be written anew: those of ``facts``, and the others of shelves they leave half empty.

    With ``whole`` all of each shelf that holds one of them.
    """
    hit = spool(facts.select("month", "low").distinct().withColumn("_hit", F.lit(True)), "hit")
    marked = lookup_join(listed, hit, ["month", "low"])
    shelf = Window.partitionBy("version", "month", "shelf")
    hits, kept = F.count("_hit").over(shelf), F.count_if(F.col("_hit").isNull()).over(shelf)
    marked = marked.withColumn("_rest", hits > 0 if whole else 2 * kept < F.col("written"))
    return marked.where(F.col("_hit").isNotNull() | F.col("_rest")).drop("_hit", "_rest")


def _in_buckets(facts: DataFrame, listed: DataFrame) -> DataFrame:
    """Add ``low``, the bucket of each fact; a month without buckets begins one for all its ids.

    The lows of a month are a tree of _PARTS branches a level, so a fact is
    compared with a few of them.
    """
    place = F.row_number().over(Window.partitionBy("month").orderBy("low")) - 1
    lows = spool(listed.select("month", "low", place.alias("place")), "lows")
    last, step = lows.agg(F.max("place").alias("last")).first()["last"], 1
    placed = facts.withColumn("low", F.lit(_LEAST))
    if last is None:
        return placed
    while step * _PARTS <= last:
        step *= _PARTS
    first = F.lit(_LEAST)  # of the whole month
    while step:
        node = F.floor(F.col("place") / (step * _PARTS)).alias("node")
        cuts = F.array_sort(F.collect_list("low")).alias("_cuts")
        branches = lows.where(F.col("place") % step == 0).groupBy("month", node).agg(cuts)
        placed = _cut(placed, branches.select("month", first.alias("low"), "_cuts"))
        first, step = F.array_min("_cuts"), step // _PARTS
    return placed


def _cut(facts: DataFrame, cuts: DataFrame) -> DataFrame:
    """Facts of each bucket in ``cuts`` go to the last of its ``_cuts``, in order, that is not above their id.

    An id is compared with the first cut of each run of _CUTS, then with those of its run.
    """
    starts = F.sequence(F.lit(1), F.size("_cuts"), F.lit(_CUTS))
    runs = cuts.withColumn("_cuts", F.transform(starts, lambda at: F.slice("_cuts", at, _CUTS)))
    run = F.try_element_at(F.filter("_cuts", lambda run: run[0] <= F.col("article_id")), F.lit(-1))
    found = lookup_join(facts, runs, ["month", "low"]).withColumn("_cuts", run)
    last = F.array_max(F.filter("_cuts", lambda cut: cut <= F.col("article_id")))
    return found.withColumn("low", F.coalesce(last, "low")).drop("_cuts")


def _sizes(facts: DataFrame) -> DataFrame:
    return spool(facts.groupBy("month", "low").agg(F.count("*").alias("n")), "sizes")


def _cuts(facts: DataFrame, sizes: DataFrame, bucket_rows: int) -> DataFrame | None:
    """Where buckets with more than twice the wanted rows are to be cut; None when there are none."""
    parts = F.least(F.ceil(F.col("n") / bucket_rows), F.lit(_PARTS)).cast("int")
    large = spool(sizes.where(F.col("n") > 2 * bucket_rows).withColumn("parts", parts), "large")
    few, many = large.where(F.col("parts") <= _CUTS), large.where(F.col("parts") > _CUTS)
    found = [_percentiles(facts, some, shares) for some, shares in ((few, _CUTS), (many, _PARTS)) if not some.isEmpty()]
    if not found:
        return None
    # a bucket of one id, with a day each, stays as it is
    above = F.array_distinct(F.filter("at", lambda cut: cut > F.col("low")))
    cuts = reduce(DataFrame.unionByName, found).select("month", "low", above.alias("_cuts"))
    cuts = spool(cuts.where(F.size("_cuts") > 0), "cuts")
    return None if cuts.isEmpty() else cuts


def _percentiles(facts: DataFrame, large: DataFrame, shares: int) -> DataFrame:
    """The ids ``at`` which buckets of ``large`` fall into ``parts``, up to ``shares``, of about equal size."""
    asked = [i / shares for i in range(1, shares)]
    chosen = F.transform(
        F.sequence(F.lit(1), F.col("parts") - 1),
        lambda i: F.element_at("at", F.floor(i * shares / F.col("parts")).cast("int")),
    )
    return (
        lookup_join(facts.select("month", "low", "article_id"), large, ["month", "low"], "inner")
        .groupBy("month", "low", "parts")
        .agg(F.percentile_approx("article_id", asked, max(10_000, 4 * shares)).alias("at"))
        .select("month", "low", chosen.alias("at"))
    )


def _write_facts(facts: DataFrame, root: str, listed: DataFrame, touched: DataFrame, bucket_rows: int) -> None:
    """Write all facts of the ``touched`` buckets, publish them, and remove what they replace."""
    spark, base = facts.sparkSession, f"{root}/fact_article"
    version = max((int(c.removeprefix("version=")) for c in children(spark, base)), default=0) + 1
    placed = spool(facts.select(*schemas.FACT.fieldNames(), "month", "low"), "to-write")
    sizes = _sizes(placed)
    while (cuts := _cuts(placed, sizes, bucket_rows)) is not None:  # each round makes large buckets up to _PARTS times smaller
        placed = spool(_cut(placed, cuts), "to-write")
        sizes = _sizes(placed)
    written = spool(_shelved(sizes, version), "shelved")
    placed = lookup_join(placed, written.select("month", "low", "shelf"), ["month", "low"], "inner")
    for rows, folder in ((placed, base), (_sums(placed), f"{root}/fact_sums")):
        even = rows.hint("rebalance", "month", "shelf").write.mode("overwrite")
        even.partitionBy("month", "shelf").parquet(f"{folder}/version={version}")
    left = lookup_join(listed, touched.select("month", "low"), ["month", "low"], "left_anti")
    _write_copy(left.unionByName(written).hint("rebalance"), f"{root}/fact_months")
    kept = _list(spark, root).select("version", "month", "shelf").distinct().collect()  # a row for each folder
    folders = {(row["version"], row["month"], row["shelf"]) for row in kept}
    _remove_unlisted(spark, base, folders)
    _remove_unlisted(spark, f"{root}/fact_sums", folders)


def _shelved(sizes: DataFrame, version: int) -> DataFrame:
    """Buckets of these ``sizes`` as the list is to name them."""
    earlier = Window.partitionBy("month").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shelf = Window.partitionBy("month", "place")
    return sizes.withColumn("place", F.floor(before / SHELF_ROWS)).select(
        "month", "low", F.lit(version).alias("version"), F.min("low").over(shelf).alias("shelf"), F.count("*").over(shelf).alias("written")
    )


def _remove_unlisted(spark: SparkSession, base: str, listed: set[tuple[int, str, int]]) -> None:
    months = {(version, month) for version, month, _ in listed}
    versions = {version for version, _ in months}
    for folder in children(spark, base):
        version, path = int(folder.removeprefix("version=")), f"{base}/{folder}"
        if version not in versions:
            remove(spark, path)
            continue
        for name in children(spark, path):
            if not name.startswith("month="):
                continue
            month = name.removeprefix("month=")
            if (version, month) not in months:
                remove(spark, f"{path}/{name}")
                continue
            for shelf in children(spark, f"{path}/{name}"):
                if (version, month, int(shelf.removeprefix("shelf="))) not in listed:
                    remove(spark, f"{path}/{name}/{shelf}")


def _source_rule():
    return (
        F.col("source_name").isNotNull()
        & F.col("url").isNotNull()
        & F.coalesce(F.col("reliability_score").between(0, 1), F.lit(True))
    )


def _fact_rule():
    return _all_set(("article_id", "published_at", "source_id", "topic_id")) & F.col("_topic_known")


def _all_set(columns):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _read_copy(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    copies = _copies(spark, path)
    if not copies:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{copies[-1]}")


def _write_copy(df: DataFrame, path: str) -> None:
    copies = _copies(df.sparkSession, path)
    number = int(copies[-1].removeprefix("copy=")) + 1 if copies else 1
    df.write.mode("overwrite").parquet(f"{path}/copy={number:08d}")
    for old in copies:
        remove(df.sparkSession, f"{path}/{old}")


def _copies(spark: SparkSession, path: str) -> list[str]:
    """Finished copies, oldest first."""
    named = [c for c in children(spark, path) if c.startswith("copy=")]
    return [c for c in named if exists(spark, f"{path}/{c}/_SUCCESS")]
