import hashlib
import struct
import uuid

import zstandard

from shelfpulse.llm.warc import (
    DICTIONARY_FRAME,
    archive,
    archives_for,
    read_archives,
    records_of,
    with_revisits,
    write_archives,
)
from shelfpulse.scratch import scratch_path

PAGES = "page_id long, url string, html string, payload string, refers_to long"


def round_trip(spark, pages, archives=2):
    path = scratch_path(spark, f"archives-{uuid.uuid4().hex}")
    write_archives(with_revisits(pages), path, archives)
    return read_archives(spark, path).collect(), path


def test_odd_pages(spark):
    big, bigger = "x" * 100, "é" * 60
    rows = [
        (3, "u3", big), (1, "u1", big), (2, None, big), (4, "u\r\nX: y", "short"), (5, "u5", "short"),
        (6, "u6", None), (7, "u7", ""), (8, "u8", bigger), (9, "u9", bigger), (None, "n", big),
        (1, "u1", big), (10, "u10", "a\r\n\r\nWARC/1.1\r\n" * 20), (11, "u11", "line\n" * 300_000),
    ]
    pages = spark.createDataFrame([(*r, "p", 5) for r in rows], PAGES)
    got, _ = round_trip(spark, pages)
    payload = lambda text: (text or "").encode()
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert kinds == {
        (1, "response", None), (2, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1),
        (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None),
        (8, "response", None), (9, "revisit", 8), (10, "response", None), (11, "response", None),
    }
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == sorted(
        (str(i), len(payload(t)), hashlib.sha256(payload(t)).hexdigest()) for i, _, t in rows
    )
    bodies = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert all(bodies[i] == payload(t) for i, _, t in rows if i in bodies)


def test_no_pages(spark):
    pages = spark.createDataFrame([], PAGES)
    assert archives_for(pages) == 1
    assert round_trip(spark, pages)[0] == []


def test_records_are_frames_of_their_own_behind_a_dictionary(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got, path = round_trip(spark, pages)
    assert len(got) == pages.count()
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) == 2
    for file in files:
        data = bytes(file["content"])
        magic, size = struct.unpack_from("<II", data)
        assert magic == DICTIONARY_FRAME and size > 1000
        assert len(list(records_of(data))) > 10
        # Plain readers pass over the dictionary, and need it for the records.
        try:
            zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        except zstandard.ZstdError as wrong:
            assert "ictionary" in str(wrong)
        else:
            raise AssertionError("records were not compressed with the dictionary")


def test_archives_of_few_or_equal_records():
    for records in ([b"one"], [b"same" * 50] * 40, [bytes([i]) * 900 for i in range(60)]):
        assert list(records_of(b"".join(archive(records)))) == records
