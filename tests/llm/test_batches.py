from __future__ import annotations

import tracemalloc

import pyarrow as pa
import pytest

from newsloom.llm import near_dedup, quality, toxicity
from newsloom.llm.common import BATCH_ROWS, batches

ROWS = 300_000


def short_texts():
    """Very many empty and one-letter texts, as Spark hands them over, in record batches of 10,000 rows."""
    for low in range(0, ROWS, 10_000):
        yield pa.RecordBatch.from_pydict({"text": pa.array(["" if i % 2 else "abc"[i % 3] for i in range(low, low + 10_000)], pa.string())})


def test_a_batch_has_a_bounded_number_of_rows():
    sizes = [table.num_rows for table in batches(short_texts(), "text", 8 << 20)]
    assert sum(sizes) == ROWS and max(sizes) == BATCH_ROWS
    assert [t.num_rows for t in batches(short_texts(), "text", 8 << 20, 7_000)][:3] == [7_000] * 3


def _sign(table):
    owner, value, count, _ = near_dedup.shingles(table["text"])
    near_dedup.band_keys(near_dedup.probminhash(owner, value, count.astype(float), table.num_rows))


INSULTS, LEARNED = (toxicity.automaton({w: 1.0}) for w in ("ab", "c"))


@pytest.mark.parametrize(
    "work", [_sign, lambda t: quality.measure(t["text"]), lambda t: toxicity.measure(t["text"], INSULTS, LEARNED)], ids=["2", "3", "9"]
)
def test_many_short_texts_stay_below_200_mb(work):
    tracemalloc.start()
    for number, table in enumerate(batches(short_texts(), "text", 8 << 20)):
        if number < 2:
            work(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def test_short_texts_in_one_task(spark):
    docs = spark.range(0, 100_000, 1, 1).selectExpr("id AS doc_id", "IF(id % 2 = 0, NULL, substr('abc', id % 3 + 1, 1)) AS text")
    got = near_dedup.near_duplicates(docs).groupBy("class").count().collect()
    assert sorted((r["class"], r["count"]) for r in got) == [(0, 50_000), (1, 16_667), (3, 16_667), (5, 16_666)]
