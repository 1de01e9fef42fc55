"""The operators run over the supplied tables, one function per query: (spark, folder) -> frame."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import text
from newsloom.functions.dates import leading_date, month_key, utc_date
from newsloom.operators import (
    cleaning,
    constraints,
    entities,
    facts,
    merging,
    profiles,
    ranking,
    sentiment,
    topics,
    words,
)
from newsloom.plans import analysis, daily, rankings
from newsloom.session import scratch_path, spool
from newsloom.sources import bucketed, readers, star, writers
from newsloom.streaming import incremental

# Two deliveries that overlap, as ranges of days over a whole table.
TABLE_UNTIL = "1999-01-01"
BATCH_FROM = "1997-01-01"
FIRST_YEAR = "1996-01-01"
LATER_FROM = "1995-06-01"

# Values in a CSV file that many tasks read, and in one that a single task reads.
SPLIT_FILE_BYTES = 256 << 20
WHOLE_FILE_BYTES = 64 << 20

# Words and names that occur in the supplied documents.
LEXICON = {"for": 0.1, "the": 0.25, "not": -0.5, "good": 0.7, "rely": 0.5, "worthless": -0.8, "de": -0.3}
GAZETTEER = {
    "of the": "ORG",
    "the": "LOC",
    "to the of": "ORG",
    "and": "PERSON",
    "apache license": "LAW",
    "mit license": "LAW",
    "de la": "GPE",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return readers.read_parquet(spark, f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """A table with long texts; one of a few splits, as the test tables are, is dealt to eight tasks."""
    found = table(spark, folder, name)
    return found.repartition(8) if found.rdd.getNumPartitions() < 8 else found


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(LEXICON.items()), "token string, polarity double")


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(GAZETTEER.items()), "surface string, label string")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The supplied documents in the shape of delivered ones."""
    events, pages = table(spark, folder, "events"), table(spark, folder, "pages")
    return (
        texts(spark, folder).join(events.select(F.col("event_id").alias("doc_id"), "ts", "props"), "doc_id", "left")
        .join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            F.col("source").alias("title"),
            "url",
            F.lit("").alias("image_url"),
            F.col("source").alias("news_site"),
            F.col("text").alias("summary"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
            F.lit(False).alias("featured"),
            F.lit("[]").alias("launches"),
            F.col("props").alias("events"),
            "lang",
        )
    )


def with_summary(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).select(
        F.col("doc_id").alias("id"), F.col("text").alias("summary"), "lang", "source"
    )


# Sources and sinks


def src_csv_roundtrip(spark, folder):
    """Whole texts, with blanks at their ends, quotes, commas and all line breaks."""
    docs = table(spark, folder, "documents")
    odd = docs.withColumn("text", F.concat(F.lit("\t"), "text", F.lit(' "x", y\r\n\\ z\r ')))
    path = writers.write_csv(odd, scratch_path(spark, "documents"), 4, WHOLE_FILE_BYTES)
    return readers.read_csv(spark, path, docs.schema)


def src_csv_split(spark, folder):
    """Whole texts twice over, with blank lines, quotes and line breaks, in one file that many tasks read.

    Beyond SPLIT_FILE_BYTES it takes more files, as one file is written by one task.
    """
    docs = table(spark, folder, "documents")
    twice = F.concat("text", F.lit(' "",\n\n"x"\r\n,y\n'), "text")
    path = writers.write_csv(docs.withColumn("text", twice), scratch_path(spark, "documents"), 1, SPLIT_FILE_BYTES)
    return readers.read_csv(spark, path, docs.schema, split=True)


def csv_single_file(spark, folder):
    """A counted table as one CSV file, as the caller says."""
    counts = profiles.site_counts(table(spark, folder, "documents"), "source")
    path = writers.write_csv(counts, scratch_path(spark, "sites"), parts=1)
    read = readers.read_csv(spark, path, counts.schema)
    files = read.select(F.input_file_name().alias("file")).distinct().agg(F.count("*").cast("int").alias("files"))
    return read.withColumn("files", files.scalar())


def src_parquet_count(spark, folder):
    return table(spark, folder, "documents").agg(F.count("*").alias("n"))


def page_ingest(spark, folder):
    """Documents stored as service pages, read back and normalized."""
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("title"),
        F.col("source").alias("news_site"),
        F.col("text").alias("summary"),
        F.array(F.struct(F.col("n_chars").alias("n"))).alias("launches"),
    )
    path = scratch_path(spark, "pages")
    texts(spark, folder).select(F.array(record).alias("results")).write.json(path)
    return cleaning.normalize(readers.read_pages(spark, path)).drop("published_at", "updated_at")


def json_props(spark, folder):
    props = F.from_json("props", "k long")
    return table(spark, folder, "events").select(
        "event_id", props["k"].alias("k"), F.to_json(props).alias("props_text")
    )


def page_window(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.page(orders, [("o_orderkey", "asc")], number=3, size=50)


def since_date(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return readers.since(events, "2024-01-15", "ts")


def sink_partitioned(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    dated = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    path = writers.write_partitioned(dated, scratch_path(spark, "events"), "day")
    return spark.read.schema(dated.schema).parquet(path)


# Documents


def clean_docs(spark, folder):
    docs = cleaning.conform(documents(spark, folder), schemas.RAW)
    return cleaning.clean(docs).select("id", "summary", "published_at", "updated_at")


def normalize_text(spark, folder):
    tidy = text.quiet_quotes(text.squeeze(F.col("text")))
    return texts(spark, folder).select("doc_id", tidy.alias("summary"))


def ingest_normalize(spark, folder):
    pages = texts(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("id"),
        F.col("html").alias("title"),
        F.concat(F.lit(" \t"), "url", F.lit("\n")).alias("url"),
        F.col("html").alias("summary"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("image_url", "news_site", "published_at", "updated_at", "featured", "launches", "events")
        ],
    )
    return cleaning.normalize(pages, missing_id=0)


def url_host(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))


def to_date_cast(spark, folder):
    events = table(spark, folder, "events")
    written = events.withColumn("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return written.select(
        "event_id",
        utc_date(F.col("ts"), events.schema["ts"].dataType).alias("day"),
        utc_date(F.col("iso"), written.schema["iso"].dataType).alias("day_of_text"),
        leading_date(F.col("iso")).alias("day_of_prefix"),
    )


def union_doc_types(spark, folder):
    orders = table(spark, folder, "orders")
    urgency = F.substring("o_orderpriority", 1, 1).cast("int")
    batches = {
        "articles": orders.where(urgency <= 2),
        "reports": orders.where(urgency == 3),
        "blogs": orders.where(urgency >= 4),
    }
    return cleaning.union_doc_types(batches, orders.schema).select(
        "doc_type", "o_orderkey", "o_orderpriority"
    )


def dedupe_by_key(spark, folder):
    events = table(spark, folder, "events")
    return cleaning.deduplicate(events, ["user_id", "event_type"], ["ts"])


# Words, topics, sentiment, entities


def word_counts(spark, folder):
    return words.word_counts(with_summary(spark, folder))


def tfidf_terms(spark, folder):
    terms = words.tfidf_terms(with_summary(spark, folder))
    return terms.withColumn("tfidf", F.round("tfidf", 6))


def _lang_counts(spark, folder):
    tokens = words.explode_words(with_summary(spark, folder), keep=["lang"])
    return topics.topic_word_counts(tokens, "lang")


def topic_word_counts(spark, folder):
    return _lang_counts(spark, folder)


def topic_category(spark, folder):
    return topics.topic_categories(_lang_counts(spark, folder), "lang")


def topic_labels(spark, folder):
    return topics.topic_labels(_lang_counts(spark, folder), "lang")


def topics_kmeans(spark, folder):
    clustered, _ = topics.classify_topics(with_summary(spark, folder))
    return clustered.select("id", "topic_id")


def cluster_labels(spark, folder):
    return topics.classify_topics(with_summary(spark, folder))[1]


def article_clusters(spark, folder):
    docs = with_summary(spark, folder).withColumn("title", F.col("source"))
    return topics.classify_articles(docs, k=3)


def topics_kmeans_rows(spark, folder):
    """Every document has one topic, a number below the number of clusters."""
    return topics_kmeans(spark, folder).select("id", F.col("topic_id").between(0, topics.CLUSTERS - 1).alias("valid"))


def cluster_labels_agree(spark, folder):
    """The labels of each topic against those counted from the assignment that was written."""
    clustered, labels = topics.classify_topics(with_summary(spark, folder))
    assigned = spool(clustered.select("topic_id", "filtered_words"), "assigned")
    counts = assigned.select("topic_id", F.explode("filtered_words").alias("word")).groupBy("topic_id", "word").count()
    first = counts.groupBy("topic_id").agg(F.min(F.struct(-F.col("count"), "word"))["word"].alias("most"))
    same = F.col("category").eqNullSafe(F.substring("most", 1, 255)) & F.col("name").startswith(F.col("category"))
    checked = labels.join(first, "topic_id", "full_outer")
    return checked.agg(F.bool_and(F.coalesce(same, F.lit(False))).alias("agree"), (F.count("*") <= topics.CLUSTERS).alias("few"))


def article_cluster_rows(spark, folder):
    """Title and summary of every document, whole, with a valid cluster."""
    found = article_clusters(spark, folder)
    return found.select("title", "summary", F.col("cluster").between(0, 2).alias("valid"))


def sentiment_scorer(spark, folder):
    """A model in place of the lexicon: here the share of question marks."""

    @F.pandas_udf("double")
    def share(texts):
        return texts.str.count(r"\?") / texts.str.len().clip(lower=1) - 0.001

    scored = sentiment.sentiment(with_summary(spark, folder), scorer=share)
    return scored.withColumn("sentiment_score", F.round("sentiment_score", 5))


def sentiment_lexicon(spark, folder):
    scored = sentiment.sentiment(with_summary(spark, folder), lexicon(spark))
    return scored.withColumn("sentiment_score", F.round("sentiment_score", 4))


def entities_gazetteer(spark, folder):
    found = entities.entities(with_summary(spark, folder), gazetteer(spark))
    listed = found.select("id", F.posexplode("entities").alias("place", "entity"))
    return listed.select("id", "place", "entity.text", "entity.label")


def entities_text(spark, folder):
    found = entities.entities(with_summary(spark, folder), gazetteer(spark))
    return entities.entities_as_text(found)


def entities_tagger(spark, folder):
    """A model in place of the gazetteer: here it finds numbers of four digits or more."""

    def numbers(batches):
        import re

        for batch in batches:
            found = [[{"text": n, "label": "NUMBER"} for n in re.findall("[0-9]{4,}", t)] for t in batch["text"]]
            yield batch[["id"]].assign(entities=found)

    found = entities.entities(with_summary(spark, folder), tagger=numbers)
    listed = found.select("id", F.posexplode("entities").alias("place", "entity"))
    return listed.select("id", "place", "entity.text", "entity.label")


def hashed_terms(spark, folder):
    """Tokens of each text, and what the hashed counts of its terms add up to."""
    docs = table(spark, folder, "documents")
    tokens = Tokenizer(inputCol="text", outputCol="words").transform(docs.select("doc_id", "text"))
    hashed = HashingTF(inputCol="words", outputCol="terms", numFeatures=topics.BUCKETS).transform(tokens)
    counted = F.aggregate(vector_to_array("terms"), F.lit(0.0), lambda a, n: a + n)
    return hashed.select("doc_id", F.size("words").alias("tokens"), counted.cast("long").alias("hashed"))


def analyze_in_memory(spark, folder):
    """The words of records held in memory, one for each source and language."""
    docs = table(spark, folder, "documents")
    firsts = docs.groupBy("source", "lang").agg(F.min("doc_id").alias("id"))
    records = [
        {"id": r["id"], "title": r["source"], "news_site": r["source"], "summary": f"{r['source']} Item {r['lang']}", "url": "https://a.example/x"}
        for r in firsts.collect()  # held in memory, as a user of this has them
    ]
    return analysis.analyze_rows(spark, records)["words"]


def raw_sink(spark, folder):
    """Whole texts as a raw delivery and back; empty ones read as null."""
    path = writers.write_raw(documents(spark, folder).drop("lang"), scratch_path(spark, "raw"))
    return readers.read_csv(spark, path).select("id", "title", "summary")


def empty_inputs(spark, folder):
    """Rows that operators make of the documents of no language."""
    none = documents(spark, folder).where("lang = 'none'")
    clustered, labels = topics.classify_topics(none)
    found = {
        "clustered": clustered, "labels": labels, "articles": topics.classify_articles(none),
        "words": words.word_counts(none), "entities": entities.entities(none, gazetteer(spark)),
        "sentiment": sentiment.sentiment(none, lexicon(spark)), "sources": profiles.source_reliability(none),
    }
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("operator"), "n") for name, df in found.items()]
    return reduce(DataFrame.unionByName, counts)


# Counts and profiles


def publication_trend(spark, folder):
    events = table(spark, folder, "events")
    return profiles.publication_trend(events.select(F.col("ts").cast("date").alias("published_at")))


def site_counts(spark, folder):
    return profiles.site_counts(table(spark, folder, "documents"), "source")


def doc_sources(spark, folder):
    return profiles.doc_sources(table(spark, folder, "documents"), "doc_id", "source")


def _doc_pages(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return table(spark, folder, "documents").select("doc_id", "source").join(pages, "doc_id", "left")


def source_reliability(spark, folder):
    shares = profiles.source_reliability(_doc_pages(spark, folder), "doc_id", "source", "url")
    return shares.withColumn("reliability_score", F.round("reliability_score", 6))


# Facts


def _left3(spark, folder):
    """Events, and the source, label and cluster of the document of the same number."""
    return {
        "dates": table(spark, folder, "events").select(
            F.col("event_id").alias("id"), F.col("ts").cast("date").alias("published_at")
        ),
        "sources": profiles.doc_sources(table(spark, folder, "documents"), "doc_id", "source"),
        "topics": table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("topic_id")),
        "sentiment": table(spark, folder, "embeddings").select(
            F.col("vec_id").alias("id"), F.col("label").cast("float").alias("sentiment_score")
        ),
    }


def merge_left3(spark, folder):
    return facts.merge_documents(*_left3(spark, folder).values())


def merge_bucketed(spark, folder):
    """The same over tables in buckets of the id, which meet without a shuffle."""
    path = scratch_path(spark, "bucketed")
    written = [bucketed.write_bucketed(df, f"{path}/{name}", "id", 16) for name, df in _left3(spark, folder).items()]
    return facts.merge_documents(*written)


def _scored(spark, folder):
    """Documents with language as topic and label as sentiment; unlabelled ones have none."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    merged = docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("article_id"),
        F.col("source").alias("source_name"),
        F.col("lang").alias("topic_id"),
        F.col("quality").cast("double").alias("sentiment_score"),
    )
    sources = profiles.source_reliability(_doc_pages(spark, folder), "doc_id", "source", "url")
    scored = facts.importance(merged, sources)
    return scored.withColumn("importance_score", F.round("importance_score", 6))


def importance(spark, folder):
    return _scored(spark, folder)


def attach_entities(spark, folder):
    found = entities.entities_as_text(entities.entities(with_summary(spark, folder), gazetteer(spark)))
    return facts.attach_entities(_scored(spark, folder), found)


# Star schema


def monthly_trends(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, folder, "customer")
    return rankings.monthly_trends(orders, customers, "c_custkey", "o_orderdate", "c_mktsegment")


def influential_sources(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    ranked = rankings.influential_sources(
        lines, table(spark, folder, "supplier"), "s_suppkey", "l_orderkey", "l_extendedprice", "s_name"
    )
    return ranked.withColumn("avg_importance", F.round("avg_importance", 4))


def _customer_profile(orders: DataFrame, customers: DataFrame, url: str) -> DataFrame:
    named = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    share = profiles.source_reliability(
        named.withColumn("url", F.lit(f"https://{url}/x")), "o_orderkey", "c_name", "url"
    )
    return share.withColumn("reliability_score", F.round("reliability_score", 8))


def upsert_sources(spark, folder):
    """Customers of the first year, then those of a longer second period."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    first = _customer_profile(orders.where(F.col("o_orderdate") < FIRST_YEAR), customers, "first")
    later = _customer_profile(orders.where(F.col("o_orderdate") >= LATER_FROM), customers, "later")
    empty = spark.createDataFrame([], schemas.DIM_SOURCE)
    return merging.upsert_sources(merging.upsert_sources(empty, first), later)


def insert_ignore_topics(spark, folder):
    """Parts shipped in the first year, then those shipped later under another category."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")

    def shipped(period, category):
        keys = lines.where(period).select(F.col("l_partkey").alias("p_partkey")).distinct()
        return keys.join(parts, "p_partkey").select(
            F.col("p_partkey").alias("topic_id"), F.col("p_name").alias("name"), F.col(category).alias("category")
        )

    first = shipped(F.col("l_shipdate") < FIRST_YEAR, "p_brand")
    return merging.upsert_topics(first, shipped(F.col("l_shipdate") >= LATER_FROM, "p_type"))


def _order_facts(orders: DataFrame, step: int) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("article_id"),
        (F.col("o_custkey") + step).alias("source_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("topic_id"),
        F.col("o_orderdate").cast("date").alias("published_at"),
        (F.col("o_totalprice") + step).alias("sentiment_score"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * (step + 1)).alias("importance_score"),
    )


def upsert_facts(spark, folder):
    """Orders until a day, then orders from an earlier day on with other scores."""
    orders = table(spark, folder, "orders")
    present = _order_facts(orders.where(F.col("o_orderdate") < TABLE_UNTIL), 0)
    batch = _order_facts(orders.where(F.col("o_orderdate") >= BATCH_FROM), 1)
    return merging.upsert_facts(present, batch)


def _scored_orders(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("article_id"),
        F.format_string("Customer#%09d", "o_custkey").alias("source_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("topic_id"),
        F.col("o_orderdate").cast("date").alias("published_at"),
        F.col("o_totalprice").alias("sentiment_score"),
        (F.col("o_totalprice") / 1000).alias("importance_score"),
    )


def _priority_topics(spark, folder):
    priority = table(spark, folder, "orders").select("o_orderpriority").distinct()
    return priority.select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("topic_id"),
        F.col("o_orderpriority").alias("name"),
        F.substring("o_orderpriority", 3, 100).alias("category"),
    )


def fact_resolved(spark, folder):
    """Orders of customers that are in the black; the others have no source."""
    dim = table(spark, folder, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name")
    )
    resolved = star.resolve(_scored_orders(spark, folder), dim, _priority_topics(spark, folder))
    return resolved.where(F.col("source_id").isNotNull()).drop("_topic_known")


def _loaded_star(spark, folder, bucket_rows=None) -> str:
    """The folder of star tables after two overlapping batches."""
    root = scratch_path(spark, "star")
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    scored, topic_rows = _scored_orders(spark, folder), _priority_topics(spark, folder)
    changed = scored.withColumn("importance_score", F.lit(1.0))
    first = _customer_profile(orders.where(F.col("o_orderdate") < FIRST_YEAR), customers, "first")
    later = _customer_profile(orders.where(F.col("o_orderdate") >= LATER_FROM), customers, "later")
    early = F.col("published_at") < F.lit(FIRST_YEAR).cast("date")
    late = F.col("published_at") >= F.lit(LATER_FROM).cast("date")
    star.load_batch(spark, root, scored.where(early), first, topic_rows, bucket_rows)
    star.load_batch(spark, root, changed.where(late), later, topic_rows, bucket_rows)
    return root


def _named_facts(spark, root: str) -> DataFrame:
    names = star.read_sources(spark, root).select("source_id", F.col("name").alias("source_name"))
    return star.read_facts(spark, root).join(names, "source_id")


def star_load(spark, folder):
    """Two overlapping batches loaded into star tables on disk."""
    return _named_facts(spark, _loaded_star(spark, folder))


def star_load_buckets(spark, folder):
    """The same into buckets of few facts, so that months are cut and loads touch some of their buckets only."""
    return _named_facts(spark, _loaded_star(spark, folder, bucket_rows=100))


def star_sums(spark, folder):
    """Sums kept up to date by two loads and the deletion of a topic."""
    root = _loaded_star(spark, folder, bucket_rows=100)
    star.delete_topics(spark, root, spark.createDataFrame([(5,)], "topic_id int"))
    return star.read_sums(spark, root).withColumn("score_sum", F.round("score_sum", 3))


def star_trends(spark, folder):
    """Topics of each month, from the sums that loads keep up to date."""
    root = _loaded_star(spark, folder)
    return rankings.monthly_trends_of_sums(star.read_sums(spark, root), star.read_topics(spark, root))


def fk_violations(spark, folder):
    return constraints.orphans(
        table(spark, folder, "documents").select("doc_id", "source"), "doc_id", table(spark, folder, "labels"), "doc_id"
    )


def key_violations(spark, folder):
    return constraints.key_violations(table(spark, folder, "events"), ["user_id", "event_type"])


def null_violations(spark, folder):
    return constraints.null_violations(_doc_pages(spark, folder), ["source", "url"])


def range_violations(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return constraints.range_violations(lines, "l_discount", 0.02, 0.05)


def cascade_delete(spark, folder):
    suppliers = table(spark, folder, "supplier").where("s_acctbal < 1000")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return constraints.cascade_delete(lines, suppliers.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")


def month_partition_counts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    dated = orders.withColumn("month", month_key(F.col("o_orderdate")))
    path = writers.write_partitioned(dated, scratch_path(spark, "orders"), "month")
    stored = spark.read.schema(dated.schema).parquet(path)
    return stored.groupBy("month").agg(F.count("*").alias("orders"))


# Whole runs


def daily_run(spark, folder):
    """One batch from raw documents to facts, through every stage and its files.

    What hangs on the clusters is recomputed from the assignment that was
    written: a known topic, and the importance without the topic's part.
    """
    batch = {"articles": documents(spark, folder).drop("lang")}
    out = scratch_path(spark, "daily")
    tables = daily.run_batch(spark, batch, out, f"{out}/star", gazetteer=gazetteer(spark))
    sizes = tables["doc_topics"].groupBy("topic_id").agg(F.count("*").alias("size"))
    return (
        tables["scored"]
        .join(sizes, "topic_id", "left")
        .select(
            "article_id",
            "id",
            "source_name",
            F.col("topic_id").between(0, topics.CLUSTERS - 1).alias("topic_known"),
            "published_at",
            F.round("sentiment_score", 4).alias("sentiment_score"),
            F.round(F.col("importance_score") - 0.2 * F.log1p("size"), 4).alias("other_importance"),
            "entities",
        )
    )


def incremental_load(spark, folder):
    """Two dates delivered as CSV files, with one file late; the clean set of both dates."""
    base = scratch_path(spark, "delivered")
    inbox, out = f"{base}/inbox", f"{base}/out"
    docs = documents(spark, folder).drop("lang")
    part = F.col("id") % 6  # two dates with three types each

    def deliver(number: int) -> None:
        date, doc_type = f"2024-02-0{number // 3 + 1}", daily.DOC_TYPES[number % 3]
        writers.write_csv(docs.where(part == number), f"{inbox}/{date}/{doc_type}.csv")

    def load() -> None:
        incremental.incremental_load(spark, inbox, out, f"{base}/star", f"{base}/progress").awaitTermination()

    for number in (0, 1, 3, 4, 5):
        deliver(number)
    load()
    deliver(2)
    load()
    dates = [spark.read.schema(schemas.CLEAN).parquet(f"{out}/2024-02-0{n}/clean") for n in (1, 2)]
    return dates[0].unionByName(dates[1]).select("id", "title", "summary", "published_at")


def stream_first_arrivals(spark, folder):
    """The first event of a user and type in each hour, from events that arrive as a stream of files."""
    source, out, keys = scratch_path(spark, "inbox"), scratch_path(spark, "arrivals"), ("user_id", "event_type")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(5, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    incremental.first_arrivals(stream, out, scratch_path(spark, "progress"), keys, "ts", "1 hour").awaitTermination()
    return incremental.read_first(spark, out, keys).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props"
    )


#: Event time by which the rows of the two stateful streams may be late, and parts they are delivered in.
DELAY = "2 days"
DELIVERIES = 3


def _delivered_events(spark, folder, start) -> None:
    """Run ``start`` on a stream of events after each of three deliveries; a delivery repeats the end of the one before."""
    source = scratch_path(spark, "inbox")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    for number in range(DELIVERIES):
        place = (F.col("ts").cast("double") - low) / (high - low) * DELIVERIES
        again = F.col("ts").cast("double") > low + (high - low) * number / DELIVERIES - 86_400
        part = F.least(F.floor(place), F.lit(DELIVERIES - 1)) == number
        earlier = place < number
        events.where(part | (earlier & again)).write.mode("append").parquet(source)
        start(spark.readStream.schema(events.schema).parquet(source)).awaitTermination()


def _event_columns(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


def stream_first_in_window(spark, folder):
    """The first event of a user and type in each hour that is over, kept in a state of two days."""
    out, progress = scratch_path(spark, "first"), scratch_path(spark, "progress")
    keys = ("user_id", "event_type")
    _delivered_events(
        spark, folder, lambda s: incremental.first_per_window(s, out, progress, keys, "ts", "1 hour", DELAY)
    )
    return _event_columns(spark.read.parquet(out))


def stream_once(spark, folder):
    """Every event once, though deliveries overlap by a day."""
    out, progress = scratch_path(spark, "once"), scratch_path(spark, "progress")
    _delivered_events(spark, folder, lambda s: incremental.once_per_key(s, out, progress, ("event_id",), "ts", DELAY))
    return _event_columns(spark.read.parquet(out))


QUERIES = {
    f.__name__: f
    for f in (
        src_csv_roundtrip,
        src_csv_split,
        csv_single_file,
        src_parquet_count,
        page_ingest,
        json_props,
        page_window,
        since_date,
        sink_partitioned,
        clean_docs,
        normalize_text,
        ingest_normalize,
        url_host,
        to_date_cast,
        union_doc_types,
        dedupe_by_key,
        word_counts,
        tfidf_terms,
        topic_word_counts,
        topic_category,
        topic_labels,
        topics_kmeans,
        cluster_labels,
        article_clusters,
        topics_kmeans_rows,
        cluster_labels_agree,
        article_cluster_rows,
        sentiment_lexicon,
        sentiment_scorer,
        entities_gazetteer,
        entities_text,
        entities_tagger,
        hashed_terms,
        analyze_in_memory,
        raw_sink,
        empty_inputs,
        publication_trend,
        site_counts,
        doc_sources,
        source_reliability,
        merge_left3,
        merge_bucketed,
        importance,
        attach_entities,
        monthly_trends,
        influential_sources,
        upsert_sources,
        insert_ignore_topics,
        upsert_facts,
        fact_resolved,
        star_load,
        star_load_buckets,
        star_sums,
        star_trends,
        fk_violations,
        key_violations,
        null_violations,
        range_violations,
        cascade_delete,
        month_partition_counts,
        daily_run,
        incremental_load,
        stream_first_arrivals,
        stream_first_in_window,
        stream_once,
    )
}
