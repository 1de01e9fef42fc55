"""Topics: TF-IDF vectors, k-means clusters and labels made of their words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.session import spool

# Fixed values of the clustering.
CLUSTERS = 5
SEED = 42
BUCKETS = 1000

# Counts that a task of k-means holds in memory, at most.
TASK_VALUES = 10_000_000

# With a comma and a space each word takes three characters or more (only one
# word can be empty), so this many words always fill a label.
LABEL_WORDS = -(-schemas.LABEL_CHARS // 3) + 1


def fit_topics(
    df: DataFrame,
    k: int = CLUSTERS,
    summary: str = "summary",
    output: str = "topic_id",
    seed: int = SEED,
    buckets: int = BUCKETS,
    key: str = "id",
) -> PipelineModel:
    """Fit the text-to-cluster pipeline on all rows of ``df``; null text counts as empty.

    The term counts are written once, so that neither the term weights nor
    the rounds of k-means read the text again; they are put in an order that
    the texts and ids fix, so that the same documents always give the same
    clusters and copies of a text are dealt among tasks by their ids. A task
    gets about TASK_VALUES counts at most, however many documents there are. The
    driver holds the k centres and one weight per bucket. With fewer distinct documents than ``k`` there
    are as many clusters as distinct documents at most.
    """
    counting = _counting(summary, buckets)
    identity = [c for c in (key,) if c in df.columns and c != summary]
    counted = counting.transform(df.select(_filled(summary), *identity)).select("raw_features", _place(summary, identity))
    weighing = _fit(spool(counted, "terms"), k, output, seed, buckets)
    return PipelineModel(stages=[*counting.stages, *weighing.stages])


def _counting(summary: str, buckets: int = BUCKETS) -> PipelineModel:
    """From text to counts of hashed terms."""
    return PipelineModel(
        stages=[
            Tokenizer(inputCol=summary, outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="filtered_words"),
            HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=buckets),
        ]
    )


def _place(summary: str, identity: list[str]):
    """Where a document comes among the others."""
    return F.xxhash64(summary, *identity).alias("_place")


def _fit(counts: DataFrame, k: int, output: str, seed: int = SEED, buckets: int = BUCKETS) -> PipelineModel:
    """Weights and centres of written counts (columns raw_features and _place)."""
    counts = counts.select("raw_features", "_place")
    weighting = IDF(inputCol="raw_features", outputCol="features").fit(counts)
    parts = max(8, -(-counts.count() * buckets // TASK_VALUES))  # a document has a count per bucket at most
    counts = counts.repartition(parts, "_place").sortWithinPartitions("_place").drop("_place")
    # The block solver fails where it finds fewer starting points than k.
    kmeans = KMeans(k=k, seed=seed, featuresCol="features", predictionCol=output, solver="row")
    return PipelineModel(stages=[weighting, kmeans.fit(weighting.transform(counts).select("features"))])


def assign_topics(df: DataFrame, model: PipelineModel, summary: str = "summary") -> DataFrame:
    """``df`` with its cluster and ``filtered_words``, row by row, without a shuffle."""
    return model.transform(df.withColumn(summary, _filled(summary))).drop(
        "words", "raw_features", "features"
    )


def classify_topics(
    df: DataFrame, k: int = CLUSTERS, summary: str = "summary", keep: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents with ``topic_id``, and the label of each topic. Empty input gives empty frames.

    The words of each text and their counts are written once beside the
    ``keep`` columns, all of ``df`` unless they are given; the fit, the topics
    and the labels read those, not the text.
    """
    keep = df.columns if keep is None else list(keep)
    if df.isEmpty():
        spark = df.sparkSession
        none = df.select(*keep, F.split(summary, " ").alias("filtered_words"), F.lit(None).cast("int").alias("topic_id"))
        return none, spark.createDataFrame([], schemas.TOPIC)
    filled = df.withColumn(summary, _filled(summary))
    place = _place(summary, [c for c in ("id",) if c in df.columns and c != summary])
    counting = _counting(summary).transform(filled)
    counted = spool(counting.select(*keep, "filtered_words", "raw_features", place), "counted")
    model = _fit(counted, k, "topic_id")
    clustered = model.transform(counted).drop("raw_features", "features", "_place")
    tokens = clustered.select("topic_id", F.explode("filtered_words").alias("word"))
    return clustered, topic_labels(topic_word_counts(tokens))


def classify_articles(df: DataFrame, k: int = CLUSTERS, summary: str = "summary") -> DataFrame:
    """Title, summary and cluster of each document."""
    if df.isEmpty():
        return df.select("title", summary, F.lit(None).cast("int").alias("cluster"))
    model = fit_topics(df, k, summary, output="cluster")
    return assign_topics(df, model, summary).select("title", summary, "cluster")


def topic_word_counts(
    tokens: DataFrame, topic: str = "topic_id", word: str = "word"
) -> DataFrame:
    return tokens.groupBy(topic, word).agg(F.count("*").alias("count"))


def top_words(
    counts: DataFrame, limit: int, topic: str = "topic_id", word: str = "word"
) -> DataFrame:
    """The ``limit`` most used words per topic with their rank; equal counts go by the alphabet.

    Spark keeps ``limit`` words per topic and task before the shuffle, so a
    topic with a very large vocabulary does not reach one task whole.
    """
    best = Window.partitionBy(topic).orderBy(F.desc("count"), word)
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)


def topic_categories(
    counts: DataFrame, topic: str = "topic_id", word: str = "word"
) -> DataFrame:
    """The most used word of each topic."""
    label = F.substring(F.col(word), 1, schemas.LABEL_CHARS).alias("category")
    return top_words(counts, 1, topic, word).select(topic, label)


def topic_labels(
    counts: DataFrame, topic: str = "topic_id", word: str = "word"
) -> DataFrame:
    """Name (all words by use, cut to the label length) and category (the first word) per topic."""
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col(word).alias("word"))))
    name = F.array_join(F.transform(listed, lambda pair: pair["word"]), ", ")
    first = F.max(F.when(F.col("rank") == 1, F.col(word)))
    return (
        top_words(counts, LABEL_WORDS, topic, word)
        .groupBy(topic)
        .agg(
            F.substring(name, 1, schemas.LABEL_CHARS).alias("name"),
            F.substring(first, 1, schemas.LABEL_CHARS).alias("category"),
        )
    )


def _filled(summary: str):
    return F.coalesce(F.col(summary), F.lit("")).alias(summary)
