from __future__ import annotations

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, `key` string"


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, size=60):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3))) + rng.choice(["", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empties, copies, near copies, shared passages, odd white space and repeated rows."""
    rng = random.Random(5)
    passage, line = sentence(rng, 45), sentence(rng, 9)
    base = sentence(rng, 300)
    near = base.split(" ")
    texts = [None, "", " \t\n ", "one", "one two three four", "one two three four five six seven eight nine ten", base, base]
    for i in range(6):
        changed = list(near)
        changed[20 * i + 3] = "changed"
        texts.append(" ".join(changed))
    for _ in range(12):
        texts.append(sentence(rng, rng.randint(5, 80)) + "\n" + passage + "\n" + sentence(rng, rng.randint(0, 60)))
    for _ in range(10):
        texts.append("\n".join([line] * rng.randint(2, 6) + [sentence(rng, 30)]))
    texts += ["### $$$ %%% &&& *** | < >" * 9, "Éàü ñandú x y \x1c z \x85 q ÀÉÎ", "a\x0bb\x0cc\rd", sentence(rng, 4000), "same " * 200]
    texts += [sentence(rng, rng.randint(1, 120)) for _ in range(25)]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", None]), len(t or ""), True, "x") for i, t in enumerate(texts)]
    out.append((None, sentence(rng, 30), "en", "src1", 1, None, None))
    out.append(out[6])  # a repeated row
    out.append((7, "another text with the id of an earlier row and more words than ten in it", "en", "src0", 5, False, "y"))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
