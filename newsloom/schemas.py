"""Schemas of the document batches, the derived tables and the star schema."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# What a delivered file holds: dates are still text, nested lists are JSON text.
RAW = _schema(
    id=LongType(),
    title=StringType(),
    url=StringType(),
    image_url=StringType(),
    news_site=StringType(),
    summary=StringType(),
    published_at=StringType(),
    updated_at=StringType(),
    featured=BooleanType(),
    launches=StringType(),
    events=StringType(),
)

CLEAN = StructType(
    [
        StructField(f.name, DateType()) if f.name in ("published_at", "updated_at") else f
        for f in RAW.fields
    ]
)

# One page as the news service delivers it. Ids may be text or numbers, and a
# StringType field keeps a nested value as its JSON text.
PAGE = StructType(
    [
        StructField(
            "results",
            ArrayType(StructType([StructField(f.name, StringType()) for f in RAW.fields])),
        )
    ]
)

DOC_SOURCE = _schema(id=LongType(), source_name=StringType())
SOURCE = _schema(source_name=StringType(), url=StringType(), reliability_score=DoubleType())
DOC_TOPIC = _schema(id=LongType(), topic_id=IntegerType())
TOPIC = _schema(topic_id=IntegerType(), name=StringType(), category=StringType())
SENTIMENT = _schema(id=LongType(), sentiment_score=FloatType(), sentiment=StringType())
ENTITY = _schema(text=StringType(), label=StringType())
ENTITIES = _schema(id=LongType(), entities=StringType())

DIM_SOURCE = _schema(
    source_id=LongType(),
    name=StringType(),
    url=StringType(),
    reliability_score=DoubleType(),
)
DIM_TOPIC = TOPIC
FACT = _schema(
    article_id=LongType(),
    source_id=LongType(),
    topic_id=IntegerType(),
    published_at=DateType(),
    sentiment_score=DoubleType(),
    importance_score=DoubleType(),
)

# Longest label the dimension tables keep.
LABEL_CHARS = 255
