from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from newsloom.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests, arity):
    """The root, and for each leaf (digests on the left, digests on the right) per level."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for proof, i in zip(proofs, at):
            run = i - i % arity
            proof.append((digests[run:i], digests[i + 1 : run + arity]))
        digests = [digest(*digests[i : i + arity]) for i in range(0, len(digests), arity)]
        at = [i // arity for i in at]
    return digests[0], proofs


def wanted(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append(tree([leaf(r) for r in groups[name]], arity))
    root, tops = tree([t[0] for t in trees], arity)
    out = []
    for name, (subroot, proofs), top in zip(names, trees, tops):
        for row, proof in zip(groups[name], proofs):
            path = proof + top
            chosen = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            state = leaf(row, 1) if chosen else leaf(row)
            for left, right in path:
                state = digest(*left, state, *right)
            siblings = digest(*[d for left, right in path for d in (*left, *right)])
            out.append((row["doc_id"], leaf(row), subroot, root, siblings, state, state == root))
    return sorted(out, key=repr)


def query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return manifest.merkle_manifest(spark, str(tmp_path))


def test_query_equals_trees_in_plain_python(spark, docs, tmp_path):
    got = sorted((tuple(r) for r in query(spark, docs, tmp_path).collect()), key=repr)
    assert got == wanted(docs.collect(), 2)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize(("arity", "block"), [(2, 2), (3, 10)])
def test_any_arity_and_block(spark, docs, arity, block):
    made = manifest.manifest(docs, arity=arity, block_nodes=block)
    subroot = manifest.fold(F.col("proof"), F.col("leaf"), F.col("pos"), arity)
    folded = made.withColumn("folded", manifest.fold(F.col("group_proof"), subroot, F.col("group_pos"), arity))
    got = folded.select("doc_id", "leaf", "subroot", "root", "folded", F.array_join(F.concat("proof", "group_proof"), "").alias("all"))
    rows = got.collect()
    want = {(r[0], r[1], r[2], r[3], r[4]) for r in wanted(docs.collect(), arity)}
    assert {(r[0], r[1], r[2], r[3], digest(r[5])) for r in rows} == want and len(rows) == docs.count()
    assert all(r["folded"] == r["root"] for r in rows)


def test_equal_rows_and_null_keys_all_stay(spark, tmp_path):
    rows = [(None, "same", None, None, None)] * 40 + [(1, None, "en", "s", None), (1, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    docs = docs.withColumn("pos", F.lit(9)).withColumn("root", F.lit("x")).withColumn("grp", F.lit(0)).withColumn("digest", F.lit(1))
    got = sorted((tuple(r) for r in query(spark, docs, tmp_path).collect()), key=repr)
    assert got == wanted(docs.collect(), 2) and len(got) == 42


def test_one_row_is_its_own_root(spark, docs, tmp_path):
    row = query(spark, docs.where("doc_id = 12"), tmp_path).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == digest("")


def test_empty_table(spark, no_docs, tmp_path):
    assert query(spark, no_docs, tmp_path).count() == 0


def test_sql_gives_the_same(spark, docs, tmp_path):
    import duckdb

    got = sorted((tuple(r) for r in query(spark, docs, tmp_path).collect()), key=repr)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(connection.execute(manifest.oracle_sql()).fetchall(), key=repr) == got


def test_no_python_and_no_single_task_over_documents(spark, docs, tmp_path):
    plan = query(spark, docs, tmp_path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
