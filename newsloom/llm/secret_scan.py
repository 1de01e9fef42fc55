"""Secrets in texts: fixed patterns, and strings near sensitive words that a primed compressor finds new."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import batches, spool, whole_text

# The kinds of base findings, their patterns and their least lengths, in the order of the kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is the run that [0-9a-f]+ finds
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

#: Words that make what follows them on the line sensitive.
SENSITIVE = re.compile(
    r"key|secret|token|passw|passphrase|pwd|auth|bearer|credential|private|signature|session|cookie|login|connection",
    re.IGNORECASE | re.ASCII,
)
SENSITIVE_CHARS = 64
#: A candidate: letters and digits, at least so many, with at least one of each.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
#: Identifiers of program code and its settings, besides those of the texts.
CODE_WORDS = """
account action address admin algorithm allow amount application argument array async attempt attribute audience
authentication authorization await backend backup balance base batch begin boolean branch browser bucket buffer build
builder byte cache callback catch category certificate challenge change channel check class cleanup client cluster code
collection column command comment commit company compare component condition config configuration connection console
const constant constructor container content context continue control controller convert cookie copy count counter
create created credential credentials current customer data database date days debug decode default define delay delete
deploy description destination detail device digest directory disable display document domain download driver duration
element email enable encode encrypt endpoint engine entry environment error event example exception execute expire
expires export expression extension failure false feature fetch field file filter final find finish first flag float
folder follow font footer force format forward frame function gateway generate generator global grant group handle
handler hash header height hidden history host hour http https identifier identity image import include index info
initialize inner input insert instance integer interface internal interval invalid issuer item iterator job join json
keyword label language last layer layout length level library limit link list listener load loader local location lock
log logger login logout loop manager manifest map master match max member memory message metadata method metric
middleware migration min minute mode model module monitor month name namespace network next node normal notification
null number object offset open operation operator option options order organization origin output owner package page
parameter parent parse parser passphrase password path pattern payload payment pending permission person phone pipeline
plan plugin policy pool port position prefix previous private process processor product profile project promise property
protected protocol provider proxy public publish query queue random range read reader record redirect refresh region
register registry release remove render replace report repository request require reset resource response result retry
return role rotation route router rule runtime save scheduler schema scope screen script search second secret section
select selector send sequence serial series server service session setting settings setup shared signature size socket
sort source start state static status step storage store stream string struct style subject submit success suffix
summary super switch system table target task template temporary tenant test text thread throw ticket time timeout
timestamp title token tool topic total trace transaction transfer transform trigger true type undefined unique unit
update upload user username utils valid validate validator value values variable vector vendor verify version video view
virtual visible void wait wallet warning webhook week widget width window worker workspace write writer year zone
""".split()
#: Code points of surrounding text on each side that the compressor sees first.
CONTEXT_CHARS = 256
#: Least marginal compressed bytes per character that are reported.
NOVELTY = 0.7
LEVEL = 3
#: Identifiers that the dictionary holds, the most frequent of all texts.
DICTIONARY_WORDS = 4096
LEAST_SHARE = 1 / 100_000
IDENTIFIER = r"(?<![A-Za-z0-9+/=_-])[A-Za-z_]{4,32}(?![A-Za-z0-9+/=_-])"

BATCH_BYTES = 4 << 20
BATCH_ROWS = 20_000
_FINDINGS = "key long, findings array<struct<kind:string,start:int,end:int,novelty:double>>"


def identifiers(docs: DataFrame, text_column: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The identifiers without digits that occur most, counted over all texts; at most ``words``.

    Only those that make up at least 1 / 100,000 of all are taken, so that at
    most 100,000 are put in order, whatever the number of tasks. Strings with
    digits never get in, so a secret copied to many documents stays new.
    """
    found = docs.select(F.explode(F.regexp_extract_all(whole_text(text_column), F.lit(IDENTIFIER), 0)).alias("word"))
    counts = spool(found.groupBy("word").count(), "identifiers")
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = counts.where(F.col("count") >= total * LEAST_SHARE)
    top = frequent.orderBy(F.col("count").desc(), "word").limit(words)
    return [row["word"] for row in top.collect()]


class Novelty:
    """Marginal compressed bytes of strings, with a dictionary of identifiers and the text around the string."""

    def __init__(self, words: list[str], level: int = LEVEL):
        import zstandard

        options = {"level": level, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        # the most frequent come last, where they are nearest
        raw = " ".join([*reversed(words), *CODE_WORDS]).encode()
        primed = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        options["dict_data"] = primed
        self._compress = zstandard.ZstdCompressor(**options).compress

    def marginal(self, before: str, candidate: str, after: str) -> int:
        """Bytes that a candidate adds to what is around it; its other occurrences there do not count."""
        around = (after + "\n" + before).replace(candidate, "").encode()
        return len(self._compress(around + candidate.encode())) - len(self._compress(around))


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns' matches, leftmost and not overlapping within a kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Spans of strings with letters and digits behind a sensitive word of their line, that no base finding touches."""
    spans = sorted((start, end) for _, start, end in taken)
    reach = list(accumulate((end for _, end in spans), max))
    from bisect import bisect_left

    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        if not _DIGIT.search(text, start, end) or not _LETTER.search(text, start, end):
            continue
        line = max(text.rfind("\n", 0, start) + 1, start - SENSITIVE_CHARS)
        if not SENSITIVE.search(text, line, start):
            continue
        earlier = bisect_left(spans, (end,))
        if not earlier or reach[earlier - 1] <= start:
            yield start, end


def scan_text(text: str, novelty: Novelty, least: float = NOVELTY) -> list[dict]:
    """All findings of a text by start, then kind; ``novelty`` is set for kind novel."""
    found = [(kind, start, end, None) for kind, start, end in base_findings(text)]
    for start, end in candidates(text, [f[:3] for f in found]):
        before, after = text[max(0, start - CONTEXT_CHARS) : start], text[end : end + CONTEXT_CHARS]
        share = novelty.marginal(before, text[start:end], after) / (end - start)
        if share >= least:
            found.append(("novel", start, end, share))
    found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    return [dict(zip(("kind", "start", "end", "novelty"), f)) for f in found]


def scan(
    docs: DataFrame,
    words: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = NOVELTY,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Secrets of every whole text: ``id_column`` and ``findings``, an array of kind, start, end and novelty.

    Kinds assign, access and hex are the fixed patterns. Kind novel is a string
    of 16 characters or more with letters and digits, behind a sensitive word
    of the same line and apart from base findings, whose marginal compressed
    bytes are at least ``least`` a character: zstandard is primed with
    ``words`` (by default the 4,096 most frequent identifiers of all texts) and
    identifiers of program code, and sees up to 256 code points on both sides first. Spans are code points,
    the end exclusive; findings are ordered by start, then kind, so ties and
    overlapping kinds are all kept.

    A null or empty text has no findings, a null id stays null, repeated rows
    all give a row, other columns are not looked at, and an empty table gives
    no rows. Texts may have any length; one beyond ``batch_bytes`` is a batch
    alone, and a string is measured with what is around it, not with the text.
    """
    words = identifiers(docs, text_column) if words is None else words
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])

    def find(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        for table in batches(stream, "text", batch_bytes, BATCH_ROWS):
            found = [scan_text(text, novelty, least) for text in table["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [table["key"].combine_chunks(), pa.array(found, pa.list_(kind))], names=["key", "findings"]
            )

    rows = docs.select(F.col(id_column).cast("long").alias("key"), whole_text(text_column).alias("text"))
    return rows.mapInArrow(find, _FINDINGS).select(F.col("key").alias(id_column), "findings")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: counts of base findings, their digest, and all spans."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def written(findings):
        span = F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")))
        return F.array_join(span, ",")

    def of(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"] != "novel")
    return found.select(
        "doc_id", *[of(kind) for kind in KINDS[:3]], F.sha2(written(base), 256).alias("base_sha256"),
        written("findings").alias("spans"),
    )
