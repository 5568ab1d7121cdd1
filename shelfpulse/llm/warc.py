"""WARC archives of web pages, compressed record by record with a dictionary of their own.

An archive is a Zstandard file: a skippable frame that holds a dictionary built from the
archive's records, then a frame for each record, compressed with that dictionary, so that any
record can be read alone. Spark's own text writer puts the frames into files, which works on
every store that Spark can write to: each line is one frame, and the line end is an empty
skippable frame, which readers of the format pass over.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import ship
from shelfpulse.scratch import stage

# Fixed values of the format: the dictionary's frame, the empty frame between records.
DICTIONARY_FRAME = 0x184D2A5D
BETWEEN = "P*M\x18\x00\x00\x00\x00"
#: Payloads below this size are never revisits.
LEAST_REVISIT = 100
#: Payload bytes of one archive, about; archives are read whole by a task.
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
#: Of an archive, records up to so many bytes in all train its dictionary.
TRAIN_BYTES = 4 << 20
#: Fixed capture time: pages carry none, and reruns give equal files.
DATE = "1970-01-01T00:00:00Z"


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to for each row.

    Null html is an empty payload. Of the rows with equal payloads of 100 bytes or more the
    one with the smallest page_id is the response, the others revisit it. Repeated rows of
    that page_id are responses all. A page without page_id revisits a numbered one if there
    is any and is a response otherwise. An empty table gives no row; other columns of
    ``pages`` are not read, whatever their names.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_REVISIT
    # Only digests that occur more than once are joined. They are written first, so that
    # both sides of the join are plain exchanges, whose hot keys Spark splits.
    keys = rows.where(large).select("page_id", "payload_digest")
    repeated = stage(
        keys.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_page"),
        "warc-repeated",
    )
    joined = rows.join(repeated, "payload_digest", "left")
    revisits = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        F.when(large & revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(large & revisits, F.col("first_page")).alias("refers_to"),
    )


def archives_for(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """So many archives that each holds about ``archive_bytes`` before compression."""
    total = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 512)).first()[0] or 0
    return max(1, -(-total // archive_bytes))


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but tells its digest and length."""
    name = "-" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        # A line end in a URL would end the header.
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    body = payload
    if kind == "revisit":
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
        body = b""
    else:
        lines.append("Content-Type: text/html; charset=utf-8")
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary from an archive's records, empty if they are too few to train one."""
    sample, size = [], 0
    step = max(1, sum(map(len, records)) // TRAIN_BYTES)
    for item in records[::step]:
        sample.append(item[: 128 << 10])
        size += len(sample[-1])
    if len(sample) < 16 or size < 8 * 1024:
        return b""
    try:
        made = zstandard.train_dictionary(
            min(DICTIONARY_BYTES, max(1024, size // 16)), sample, k=512, d=8
        )
    except zstandard.ZstdError:  # records too alike or too short to train on
        return b""
    return made.as_bytes()


def archive(records: list[bytes], level: int = 3) -> Iterator[bytes]:
    """The frames of one archive, the dictionary's first."""
    trained = _dictionary(records)
    yield struct.pack("<II", DICTIONARY_FRAME, len(trained)) + trained
    options = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    press = zstandard.ZstdCompressor(level=level, write_content_size=True, **options)
    for item in records:
        yield press.compress(item)


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one after the other; an empty file has none."""
    if not data:
        return
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    trained = data[8 : 8 + size]
    options = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    reader = zstandard.ZstdDecompressor(**options)
    at = 8 + size
    while at < len(data):
        magic, skip = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + skip
            continue
        taken = _frame_bound(data, at)
        yield reader.decompress(data[at : at + taken])
        at += taken


def _frame_bound(data: bytes, at: int) -> int:
    """Bytes that the frame at ``at`` takes, read from its block headers."""
    pos = at + zstandard.frame_header_size(data[at : at + 18])
    checksum = data[at + 4] >> 2 & 1
    while True:
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return pos - at + 4 * checksum


def write_archives(rows: DataFrame, path: str, archives: int) -> None:
    """Write the rows of ``with_revisits`` as ``archives`` files below ``path``, a new folder.

    Files end in .txt, as Spark names them; their content is Zstandard. A task
    holds the records of its one archive. Tasks
    that are lost run again, and only the files of a task that ended well are kept.
    """

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[bytes] = []
        for frame in frames:
            held += [record(*row) for row in frame.itertuples(index=False, name=None)]
        if held:
            out = list(archive(held))
            for i in range(0, len(out), 256):
                yield pd.DataFrame({"value": out[i : i + 256]})

    ship(rows.sparkSession)
    frames = rows.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "payload",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    # Rows go round to the archives, so that they are alike in size whatever their keys.
    frames = frames.repartition(archives)
    # The cast keeps the bytes as they are: a string column need not be valid text here.
    lines = frames.mapInPandas(packed, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", BETWEEN).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload."""

    def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                held = []
                for item in records_of(content):
                    held.append(_parsed(item))
                    if len(held) == 256:
                        yield pd.DataFrame(held, columns=FIELDS)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=FIELDS)

    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInPandas(
        unpacked,
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary",
    )


FIELDS = "page_id url payload_bytes payload_digest record_type refers_to payload".split()


def _parsed(item: bytes) -> tuple:
    head, _, body = item.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    number = lambda key: (
        int(x) if (x := fields.get(key, "<urn:page:->")[10:-1]) != "-" else None
    )
    body = body[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return (
        number("WARC-Record-ID"),
        fields.get("WARC-Target-URI"),
        int(fields["X-Payload-Length"]),
        digest,
        fields["WARC-Type"],
        number("WARC-Refers-To"),
        body,
    )
