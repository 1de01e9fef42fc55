"""Entities of a document: names from a gazetteer, and tokens that look like values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from newsloom import schemas
from newsloom.functions.text import squeeze
from newsloom.operators.joins import lookup_join
from newsloom.session import spool

# A small gazetteer. Give a larger one as a frame.
NAMES = {
    "apache license": "LAW", "apollo": "PRODUCT", "artemis": "PRODUCT", "berlin": "GPE",
    "blue origin": "ORG", "boeing": "ORG", "california": "GPE", "china": "GPE",
    "earth": "LOC", "esa": "ORG", "europe": "LOC", "european space agency": "ORG",
    "falcon 9": "PRODUCT", "florida": "GPE", "france": "GPE", "germany": "GPE",
    "hubble": "PRODUCT", "india": "GPE", "international space station": "FAC", "isro": "ORG",
    "japan": "GPE", "jupiter": "LOC", "kennedy space center": "FAC", "mars": "LOC",
    "mit license": "LAW", "moon": "LOC", "nasa": "ORG", "new york": "GPE",
    "paris": "GPE", "roscosmos": "ORG", "russia": "GPE", "saturn": "LOC",
    "space center": "FAC", "spacex": "ORG", "starship": "PRODUCT", "texas": "GPE",
    "united launch alliance": "ORG", "united states": "GPE", "venus": "LOC", "washington": "GPE",
}

# Single tokens labelled by their form.
FORMS = (
    ("MONEY", r"^[$€£][0-9][0-9.,]*[kmb]?$"),
    ("PERCENT", r"^[0-9]+([.,][0-9]+)?%$"),
    ("DATE", r"^((19|20)[0-9]{2}|[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})$"),
)

# First characters of such tokens.
FORM_STARTS = tuple("0123456789$€£")

# Cut off both ends of a token before it is matched.
OUTER = ".,;:!?()[]{}\"'|"


def default_gazetteer(spark) -> DataFrame:
    return spark.createDataFrame(sorted(NAMES.items()), "surface string, label string")


def entities(
    df: DataFrame,
    gazetteer: DataFrame | None = None,
    tagger: Callable | None = None,
    key: str = "id",
    summary: str = "summary",
) -> DataFrame:
    """All entities of each document in text order: columns id and entities, an array.

    Every document has one row; repeated entities stay. A name inside a longer
    name is left out. ``key`` is unique, as after deduplication.

    ``tagger`` takes the place of the gazetteer: a function for mapInPandas
    that gets batches with id and text and returns batches with id and
    entities, so that it can load its model once per partition.
    """
    docs = df.select(F.col(key).alias("id"), F.col(summary).alias("text"))
    if tagger is not None:
        result = StructType([docs.schema["id"], StructField("entities", ArrayType(schemas.ENTITY))])
        return docs.withColumn("text", F.coalesce("text", F.lit(""))).mapInPandas(tagger, result)
    names = name_table(default_gazetteer(df.sparkSession) if gazetteer is None else gazetteer)
    longest = names.agg(F.max("size").alias("n")).first()["n"] or 1
    found = mentions(docs, names, longest)
    every = docs.select("id", F.lit(None).cast(found.schema["mention"].dataType).alias("mention"))
    return (
        every.unionByName(found)
        .groupBy("id")
        .agg(F.sort_array(F.collect_list("mention")).alias("_found"))
        .select("id", _spans("_found", longest).alias("entities"))
    )


def name_table(gazetteer: DataFrame) -> DataFrame:
    """Unique surfaces in lower case with their label, number of words and first word."""
    return spool(
        gazetteer.groupBy(squeeze(F.lower("surface")).alias("surface"))
        .agg(F.min("label").alias("label"))
        .withColumn("size", F.size(F.split("surface", " ")))
        .withColumn("first", F.substring_index("surface", " ", 1)),
        "names",
    )


def mentions(docs: DataFrame, names: DataFrame, longest: int) -> DataFrame:
    """One row per match in ``docs`` (id, text), names inside longer names included.

    The text is read once. Each token carries only the ``longest - 1`` tokens
    after it, so the rows grow with the length of the text. Tokens that
    neither begin a name nor have the form of a value are dropped before the
    runs of words they begin are looked up. A name has its label from the
    gazetteer even if it has such a form.
    """
    tokens = (
        docs.select("id", F.split(squeeze(F.lower("text")), " ").alias("w0"))
        .select("id", "w0", *[_from("w0", n).alias(f"w{n}") for n in range(1, longest)])
        .select("id", F.posexplode(F.arrays_zip(*_run_fields(longest))).alias("pos", "run"))
        .withColumn("first", _trimmed(F.col("run")["w0"]))
    )
    beginnings = names.select("first").distinct().withColumn("begins", F.lit(True))
    begun = (
        lookup_join(tokens, beginnings, ["first"])
        .withColumn("form", _form(F.col("first")))
        .where(F.col("begins") | F.col("form").isNotNull())
    )
    runs = begun.select("id", "pos", "form", F.posexplode(_prefixes(longest)).alias("more", "surface"))
    found = lookup_join(runs.where(F.col("surface").isNotNull()), names.select("surface", "label"), ["surface"])
    label = F.coalesce(F.col("label"), F.when(F.col("more") == 0, F.col("form")))
    return found.select("id", "pos", "more", "surface", label.alias("label")).where("label IS NOT NULL").select(
        "id",
        F.struct(
            F.col("pos"),
            (-1 - F.col("more")).alias("shorter"),
            F.col("surface").alias("text"),
            F.col("label"),
        ).alias("mention"),
    )


def entities_as_text(df: DataFrame) -> DataFrame:
    """The list as one string: "[text (LABEL), ...]"."""
    written = F.transform("entities", lambda e: F.concat(e["text"], F.lit(" ("), e["label"], F.lit(")")))
    return df.select("id", written.cast("string").alias("entities"))


def _run_fields(longest: int) -> list[str]:
    return [f"w{n}" for n in range(longest)]


def _from(tokens: str, n: int) -> Column:
    """``tokens`` without the first ``n``."""
    return F.slice(tokens, F.lit(n + 1), F.greatest(F.size(tokens) - n, F.lit(0)))


def _trimmed(token: Column) -> Column:
    return F.btrim(token, F.lit(OUTER))


def _prefixes(longest: int) -> Column:
    """The first one, two, ... words of a run, joined; null where the run is shorter."""
    joined: list[Column] = []
    for field in _run_fields(longest):
        word = _trimmed(F.col("run")[field])
        joined.append(F.concat(joined[-1], F.lit(" "), word) if joined else word)
    return F.array(*joined)


def _form(token: Column) -> Column:
    label = F.lit(None).cast("string")
    for name, pattern in reversed(FORMS):
        label = F.when(token.rlike(pattern), F.lit(name)).otherwise(label)
    return F.when(F.substring(token, 1, 1).isin(*FORM_STARTS), label)


def _spans(found: str, longest: int) -> Column:
    """Entities from sorted mentions, without those that lie inside another one.

    Mentions are sorted by position and then longest first, so one that covers
    another comes before it, and not further away than ``near`` entries: that
    many can start within the length of the longest name.
    """
    near = longest * (longest + 1)

    def outermost(mention, i):
        before = F.slice(F.col(found), F.greatest(i - near + 1, F.lit(1)), F.least(i, F.lit(near)))
        return ~F.exists(
            before,
            lambda other: other["pos"] - other["shorter"] >= mention["pos"] - mention["shorter"],
        )

    return F.transform(
        F.filter(F.col(found), outermost), lambda m: F.struct(m["text"].alias("text"), m["label"].alias("label"))
    )
