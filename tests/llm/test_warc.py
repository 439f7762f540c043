import base64
import gzip
import hashlib
import zlib

import pytest

from panelcast.llm import warc
from panelcast.runtime import cut_lineage

PAGES = "page_id long, url string, html string, sha1 int, first string, file string"


def archived(spark, rows, folder, **options):
    pages = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], PAGES)
    return cut_lineage(warc.write_warc(warc.first_of_equal(pages, **options), str(folder)))


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


ROWS = [
    (1, "http://a/", "<p>é</p>"), (2, "http://b/ x\r\ny", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "long " * 90_000),
    (6, "u", "\x1f plain WARC/1.1 text"), (-7, "u", "<p>é</p>"), (None, "n", "<p>é</p>"), (None, "n", "alone"), (9, "u", "x"), (9, "u", "x"),
    (2**62 + 5, "u", "big"), (-(2**63), "u", "small"),
]


@pytest.mark.parametrize("split", [64, 1000, 1 << 25])
def test_round_trip_at_every_split_size(spark, tmp_path, split):
    got = warc.read_warc(archived(spark, ROWS, tmp_path), split).collect()
    assert len(got) == len(ROWS) and all(r.intact for r in got)
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = sorted(
        (str(i), len((h or "").encode()), sha(h or ""), None if i is None or first[h or ""] == i else first[h or ""]) for i, _, h in ROWS
    )
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert (r.record_type == "revisit") == (r.refers_to is not None) == (r.payload is None)
        assert r.payload is None or sha(bytes(r.payload).decode()) == r.payload_digest
    assert {r.target_uri for r in got if r.page_id == 2} == {"http://b/%20x%0D%0Ay"}


def test_small_payloads_are_not_revisited(spark, tmp_path):
    got = warc.read_warc(archived(spark, ROWS, tmp_path, min_bytes=9), 500).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {1, 2}


def test_archives_are_plain_gzip(spark, tmp_path):
    total = 0
    for row in archived(spark, ROWS, tmp_path).collect():
        text = gzip.open(row.file).read()
        assert text.count(b"WARC/1.1\r\n") == row.records and text.startswith(b"WARC/1.1\r\n")
        total += row.records
    assert total == len(ROWS)


def test_empty_table(spark, tmp_path):
    assert warc.read_warc(archived(spark, [], tmp_path)).collect() == []


def test_foreign_bytes_between_members(spark, tmp_path):
    """Padding, other gzip members, cut members and loose magics are passed over."""
    one, two = (warc.member(i, "u", b"x" * 3000 * i, hashlib.sha1(b"x" * 3000 * i).hexdigest(), None) for i in (1, 2))
    data = b"\x1f\x8b\x08junk" + one + b"\0" * 70 + zlib.compress(b"no record", 6, 31) + one[:40] + two + two[:-9]
    path = tmp_path / "x.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(f"file://{path}", len(data))], "file string, bytes long")
    for split in (1, 7, 50, 10_000):
        assert sorted(r.page_id for r in warc.read_warc(files, split).collect()) == [1, 2]


def test_record_ids_carry_page_ids():
    for i in (0, 1, -1, 2**63 - 1, -(2**63), 2**62):
        assert warc.page_of(f"<urn:uuid:{warc.record_uuid(i)}>") == i
    assert warc.page_of(warc.record_uuid(None, b"12345678")) is None and warc.page_of("other") is None
