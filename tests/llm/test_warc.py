import base64
import hashlib
import io
import random

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from clearwell.llm.common import fresh_path
from clearwell.llm.warc import (
    DamagedArchive,
    archive_pages,
    encode_record,
    gzip_member,
    pages_round_trip,
    payload_digest,
    read_back,
    read_warc,
    salvage,
)

SF = "/root/testdata/sf0.001"


def record(i: int, body: bytes) -> bytes:
    return encode_record({"WARC-Type": "response", "WARC-Record-ID": f"<urn:{i}>", "WARC-Block-Digest": f"sha1:{payload_digest(body)}"}, body)


def salvaged(data: bytes):
    records, gaps = [], []
    for item in salvage(io.BytesIO(data)):
        if len(item) == 3:
            gaps.append(item[:2])
        else:
            records.append((item[2]["warc-record-id"], item[3]))
    return records, gaps


def test_whole_archives_have_no_gaps():
    rng = random.Random(1)
    bodies = [rng.randbytes(rng.randint(0, 5000)) for _ in range(30)] + [rng.randbytes(3 << 20)]
    want = [(f"<urn:{i}>", b) for i, b in enumerate(bodies)]
    for pack in (lambda x: x, gzip_member):
        data = b"".join(pack(record(i, b)) for i, b in enumerate(bodies))
        assert salvaged(data) == (want, [])
    mixed = b"".join((gzip_member if i % 2 else bytes)(record(i, b)) for i, b in enumerate(bodies))
    assert salvaged(mixed) == (want, [])


def test_damage_costs_only_what_it_touches():
    rng = random.Random(2)
    bodies = [f"page {i} ".encode() * rng.randint(1, 400) for i in range(25)]
    for pack in (bytes, gzip_member):
        parts = [pack(record(i, b)) for i, b in enumerate(bodies)]
        for trial in range(40):
            k, kind = rng.randrange(25), trial % 4
            hurt = bytearray(parts[k])
            if kind == 0:  # flipped bytes
                for _ in range(3):
                    at = rng.randrange(len(hurt))
                    hurt[at] ^= 0x55
            elif kind == 1:  # cut
                del hurt[rng.randrange(1, len(hurt)) :]
            elif kind == 2:  # overwritten head
                hurt[:12] = b"x" * 12
            else:  # junk in front
                hurt[:0] = rng.randbytes(50)
            data = b"".join([*parts[:k], bytes(hurt), *parts[k + 1 :]])
            records, gaps = salvaged(data)
            whole = {(f"<urn:{i}>", b) for i, b in enumerate(bodies) if i != k}
            assert whole <= set(records) and len(records) <= 25
            start = sum(map(len, parts[:k]))
            assert all(start <= a and a + n <= start + len(hurt) for a, n in gaps)
            if kind == 3:
                assert len(records) == 25 and gaps == [(start, 50)]


def test_empty_and_hopeless_files():
    assert salvaged(b"") == ([], [])
    assert salvaged(b"nothing here" * 100) == ([], [(0, 1200)])
    assert salvaged(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort") [0] == []


def test_awkward_pages(spark):
    long = "wörd " * 200_000
    pages = [(1, "http://a", None), (2, "http://b\r\nX: y", ""), (3, None, long), (4, "http://d", "same"), (9, "http://e", "same"), (9, "http://e", "same"), (None, "http://f", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS sha", "2 AS payload")
    manifest = archive_pages(df, fresh_path(spark, "warc-test"))
    rows = read_warc(manifest).collect()
    assert manifest.agg({"records": "sum"}).head()[0] == len(rows) == 7 and {r["kind"] for r in rows} == {"record"}
    got = {(r["record_id"][14:], r["warc_type"], (r["refers_to"] or "")[14:], r["payload_bytes"]) for r in rows}
    assert got == {
        ("1", "revisit", "2", 0), ("2", "response", "", 0), ("3", "response", "", len(long.encode())),
        ("4", "revisit", "9", 4), ("9", "response", "", 4), ("", "revisit", "9", 4),
    }
    assert {r["record_id"][14:]: r["payload"].decode() for r in rows if r["warc_type"] == "response"} == {"2": "", "3": long, "9": "same"}
    digests = {r["payload_bytes"]: r["payload_digest"] for r in rows}
    assert digests[4] == base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    back = pages_round_trip(spark, df).collect()
    assert sorted((str(r["page_id"]), str(r["refers_to"])) for r in back) == sorted(
        [("1", "2"), ("2", "None"), ("3", "None"), ("4", "9"), ("9", "None"), ("9", "None"), ("None", "9")]
    )
    empty = archive_pages(df.limit(0), fresh_path(spark, "warc-test"))
    assert empty.count() == 0 and read_warc(empty).count() == 0
    assert pages_round_trip(spark, df.limit(0)).collect() == []


def test_small_payloads_may_all_be_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    rows = read_warc(archive_pages(df, fresh_path(spark, "warc-test"), least_bytes=3)).collect()
    assert [r["warc_type"] for r in rows] == ["response"] * 2


def test_query_equals_its_sql(spark):
    assert compare(spark, connect(SF), entry.queries()["op6_warc"], entry.oracle_sql()["op6_warc"], SF) is None


def test_members_of_several_records_are_salvaged_inside():
    rng = random.Random(5)
    bodies = [f"page {i} ".encode() * rng.randint(1, 900) + rng.randbytes(200) for i in range(40)]
    parts = [record(i, b) for i, b in enumerate(bodies)]
    want = [(f"<urn:{i}>", b) for i, b in enumerate(bodies)]
    whole = gzip_member(b"".join(parts))
    assert salvaged(whole) == (want, [])
    assert salvaged(whole + gzip_member(parts[0]) + b"".join(parts[:3])) == (want + want[:1] + want[:3], [])
    # junk between two records of a member
    records, gaps = salvaged(gzip_member(b"".join(parts[:20]) + b"junk" * 5 + b"".join(parts[20:])))
    assert records == want and gaps == [(0, 20)]
    # what stood before a damaged place is kept, and reading goes on behind the member
    for at in (len(whole) // 3, len(whole) // 2, len(whole) - 3):
        hurt = bytearray(whole)
        hurt[at : at + 3] = bytes(b ^ 0x5A for b in hurt[at : at + 3])
        records, gaps = salvaged(bytes(hurt) + gzip_member(parts[7]))
        before = records[:-1]
        # a flipped letter may spoil its record alone
        assert records[-1] == want[7] and before == [r for r in want if r in before] and gaps
        assert len(before) >= (40 if at > len(whole) - 10 else 5)
        records, gaps = salvaged(whole[:at])
        assert records == want[: len(records)] and len(records) >= 5 and gaps


def test_plain_records_with_many_headers_are_whole():
    data = encode_record({"WARC-Record-ID": "<urn:0>", "X-Long": "y" * (3 << 20)}, b"body") + record(1, b"next")
    assert salvaged(data) == ([("<urn:0>", b"body"), ("<urn:1>", b"next")], [])
    broken = b"WARC/1.1\r\nno colon here" + b"z" * 100 + b"\r\n" + record(2, b"after")
    assert salvaged(broken)[0] == [("<urn:2>", b"after")]


def test_random_bytes_between_members():
    rng = random.Random(6)
    data, want = b"", []
    for i in range(30):
        junk = bytes(rng.choices(b"\x1f\x8b\x08WARC/1.\r\n:x", k=rng.randint(0, 60)))
        body = rng.randbytes(rng.randint(0, 3000))
        data += junk + gzip_member(record(i, body))
        want.append((f"<urn:{i}>", body))
    assert salvaged(data)[0] == want


def test_gaps_are_a_table_and_a_lost_page_is_an_error(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(20)] + [(30, None, "page 3 " * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = archive_pages(pages, fresh_path(spark, "warc-test"))
    records, gaps = read_back(spark, manifest)
    assert records.count() == 21 and gaps.count() == 0 and gaps.columns == ["path", "start", "length", "reason"]
    path = manifest.head()["path"].removeprefix("file://")
    with open(path, "r+b") as f:
        f.seek(40)
        f.write(b"\xff" * 8)
    records, gaps = read_back(spark, manifest, strict=False)
    assert records.count() < 21 and [r["start"] for r in gaps.collect()] == [0]
    with pytest.raises(DamagedArchive, match="of 21 records"):
        read_back(spark, manifest)


def test_payloads_of_revisits_stay_behind(spark):
    """Of equal payloads one a map task is shuffled, beside narrow rows."""
    pages = spark.range(0, 4000, 1, 4).selectExpr("id AS page_id", "'u' AS url", "repeat('same payload ', 100) AS html")
    rows = read_warc(archive_pages(pages, fresh_path(spark, "warc-test")), keep_payload=False)
    counts = {r["warc_type"]: r["count"] for r in rows.groupBy("warc_type").count().collect()}
    assert counts == {"response": 1, "revisit": 3999}
    assert {r["refers_to"] for r in rows.where("warc_type = 'revisit'").collect()} == {"urn:clearwell:3999"}
