"""WARC archives: revisit resolution, writing without repeated payloads, reading back.

``write`` resolves which records repeat a payload: headers alone (id, URL, digest, length) are shuffled by
payload digest, the smallest record id of a digest is the response (a minimum, which combines before the
shuffle), and the other records of ``least_bytes`` or more become revisits that name it. Revisits
are written from their headers. Responses are written where their payloads are read: a bitmap of the
revisits, of fixed size, tells which rows are none of them. The few others that only look like revisits
there are found exactly by their headers; a second bitmap and a semi-join pick them out, and no other payload is shuffled.

The archives are written by Spark's text writer, so any file system that Spark knows will do: a line is a whole
WARC/1.1 record and the line separator is the blank line behind each record. Files are
compressed by gzip and hold at most ``records_per_file`` records and ``file_bytes`` bytes of payload, or one longer record.

``read`` opens the files by Spark's binary reader and takes each apart, record by record, by its content
lengths; the digests of responses are taken anew from their payloads. ``resolve`` joins revisits to their originals by
digest for the full payload's length.

Defined cases: a null payload is the empty one; null URLs are left out of the headers; records with
one id and one digest are written once for each row, and an id's rows of other payloads are
judged by their own digests (a record without an id is never the original of another, and is a
response); payloads may hold anything, also what looks like record headers; other columns of the pages are not read,
whatever their names; no pages give no records. Memory: a task holds a batch of payloads when it writes, a compressed file and
a few records when it reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm.shared import written

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # a parameter of write: archives of one input are equal byte for byte
#: rows are marked in a bitmap of at most this many 64-bit words
WORDS = 1 << 18
_SPACE = uuid.UUID("7a1f6a5e-0000-4000-8000-000000000000")

HEADERS = T.StructType([
    T.StructField("record_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(record_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{record_id}:{digest}')}>"


def with_digests(pages: DataFrame, record_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``(record_id, url, payload, digest, size)`` of every row; the payload is text in UTF-8, the digest in hex."""
    source = pages.select(F.col(record_id).cast("long").alias("record_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    return source.select("*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").cast("long").alias("size"))


def revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(record_id, url, digest, size, original, original_url)`` of the headers whose payload another record has as response."""
    known = headers.where(F.col("record_id").isNotNull() & (F.col("size") >= least_bytes))
    first = known.groupBy("digest").agg(F.min(F.struct("record_id", "url")).alias("first"), F.max("record_id").alias("last"))
    repeated = first.where("last > first.record_id").select("digest", F.col("first.record_id").alias("original"), F.col("first.url").alias("original_url"))
    return known.join(repeated, "digest").where("record_id > original").select("record_id", "url", "digest", "size", "original", "original_url")


def _marked(rows: DataFrame, marks: DataFrame, words: int) -> DataFrame:
    """Rows with a column ``hit``: false only where no row of ``marks`` has that id and digest. Nothing is shuffled but the marks' bits."""
    mixed = F.xxhash64("record_id", "digest")
    word, bit = F.pmod(F.shiftrightunsigned(mixed, 6), F.lit(words)), F.pmod(mixed, F.lit(64)).cast("int")
    bits = marks.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(xxhash64(record_id, digest), 64) AS INT))")).alias("bits"))
    hit = F.col("record_id").isNotNull() & F.coalesce(F.getbit("bits", bit) == 1, F.lit(False))
    return rows.withColumn("word", word).join(F.broadcast(bits), "word", "left").withColumn("hit", hit).drop("word", "bits")


def responses(records: DataFrame, headers: DataFrame, again: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``records`` that aren't among the revisits ``again``, by id and digest."""
    clear = _marked(records, again, words)
    doubtful = _marked(headers.select("record_id", "digest"), again, words).where("hit").drop("hit")
    mistaken = written(doubtful.join(again, ["record_id", "digest"], "left_anti").distinct(), "mistaken")
    out = clear.where("NOT hit").drop("hit")
    if mistaken.isEmpty():
        return out
    found = _marked(clear.where("hit").drop("hit"), mistaken, words).where("hit").drop("hit")
    return out.unionByName(found.join(mistaken, ["record_id", "digest"], "left_semi"))


def _record(record_id: int | None, url: str | None, payload: str, digest: str, size: int, original: int | None, original_url: str | None, date: str) -> str:
    """A record's headers and block, without the blank line that ends it; a revisit's block has no payload."""
    revisit = original is not None
    digest = base64.b32encode(bytes.fromhex(digest)).decode()
    target = lambda name, uri: [] if uri is None else [f"{name}: " + uri.replace("\r", "%0D").replace("\n", "%0A")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(record_id, digest)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if record_id is not None:
        lines.append(f"X-Record-Key: {record_id}")
    lines += target("WARC-Target-URI", url)
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(original, digest)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Key: {original}"]
        lines += target("WARC-Refers-To-Target-URI", original_url)
    return "\r\n".join([*lines, f"Content-Length: {len(http) + (0 if revisit else size)}", "", http if revisit else http + payload])


def records(pages: DataFrame, headers: DataFrame, least_bytes: int = 0, words: int = WORDS) -> DataFrame:
    """Responses with their payloads and revisits without, from the pages :func:`with_digests` and their headers."""
    again = written(revisits(headers, least_bytes), "revisits")
    first = responses(pages, headers, again, words).select("*", F.lit(None).cast("long").alias("original"), F.lit(None).cast("string").alias("original_url"))
    return first.unionByName(again.withColumn("payload", F.lit("")))


def write(pages: DataFrame, path: str, record_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
          date: str = DATE, records_per_file: int = 2000, file_bytes: int = 1 << 27, words: int = WORDS) -> None:
    """Write one record for each row below ``path``, as response or as revisit."""
    digested = with_digests(pages, record_id, url, payload)
    headers = written(digested.drop("payload"), "headers")
    rows = records(digested, headers, least_bytes, words).select("record_id", "url", "payload", "digest", "size", "original", "original_url")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([_record(*row, date) for row in fields], pa.string())], names=["value"])

    # a file of long records has fewer of them
    longest, bound = headers.agg(F.max("size")).first()[0] or 0, max(1, file_bytes // records_per_file)
    parts = [(rows, records_per_file)]
    if longest > bound:
        parts = [(rows.where(F.col("size") <= bound), records_per_file), (rows.where(F.col("size") > bound), max(1, file_bytes // longest))]
    for k, (part, many) in enumerate(parts):
        out = part.mapInArrow(run, "value string").write.mode("append" if k else "errorifexists")
        out.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", many).text(path)


def _parse(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file, one at a time."""
    while first := file.readline():
        if first.decode().rstrip("\r\n") != VERSION:
            raise ValueError("no WARC record where one should begin")
        headers = {}
        while line := file.readline().decode().rstrip("\r\n"):
            name, _, value = line.partition(": ")
            headers[name.lower()] = value
        yield headers, file.read(int(headers["content-length"]))
        file.read(4)


def read(spark: SparkSession, path: str, with_payload: bool = True, batch_bytes: int = 1 << 24) -> DataFrame:
    """The records of all archives below ``path``, as :data:`HEADERS`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=HEADERS.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                file = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                rows: list[tuple] = []
                held = 0
                for headers, block in _parse(file):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    key, original = headers.get("x-record-key"), headers.get("x-refers-to-key")
                    told = headers["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((
                        int(key) if key else None, headers.get("warc-target-uri"), headers["warc-type"], told if original else _digest(payload),
                        int(original) if original else None, len(payload), payload if with_payload else None))
                    held += len(payload) if with_payload else 0
                    if held >= batch_bytes or len(rows) >= 500:
                        yield packed(rows)
                        rows, held = [], 0
                yield packed(rows)

    return files.mapInArrow(run, HEADERS)


def resolve(records: DataFrame) -> DataFrame:
    """Every record with its full payload's length: revisits take it from the original with their digest."""
    originals = (
        records.where("record_type = 'response'").groupBy("payload_digest")
        .agg(F.min("record_id").alias("original"), F.max("bytes").alias("original_bytes"))
    )
    joined = records.join(originals, "payload_digest", "left")
    revisit = F.col("record_type") == "revisit"
    return joined.select(
        "record_id", "url", "record_type", "payload_digest", F.when(revisit, F.col("original")).alias("refers_to"),
        F.when(revisit, F.col("original_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"))
