import hashlib
import io
from collections import defaultdict

from palmyra.llm import warc
from palmyra.sources.writers import scratch_path

LONG = "<html>" + "payload é " * 30


def rows_of(spark, rows):
    pages = spark.createDataFrame([(*r, "x") for r in rows],
                                  "page_id long, url string, html string, digest string")
    return warc.captured_pages(spark, pages, scratch_path(spark, "test-warc")).collect()


def test_responses_and_revisits(spark):
    rows = [(5, "http://a/x", LONG), (3, "http://b/", LONG), (9, "http://c", LONG), (1, None, None),
            (2, "u", ""), (6, "u", "short"), (4, "u\r\nEvil: x", "short"), (8, "http://d", LONG + "!"),
            (20, "http://e", "z" * 300_000), (21, "http://e", "\r\n\r\n" + "w" * 200)]
    by = defaultdict(list)
    for i, _, html in rows:
        by[(html or "")].append(i)
    got = {r.page_id: r for r in rows_of(spark, rows)}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        first = min(by[html or ""])
        revisit = len(raw) >= 100 and i != first
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
    assert got[5].request_path == "/x" and got[3].request_path == "/"


def test_null_key_and_repeated_rows(spark):
    """A record and a row for every row given."""
    got = rows_of(spark, [(None, "u", LONG), (7, "u", LONG), (7, "u", LONG), (7, "u", LONG + "?"), (9, "v", LONG),
                          (9, "v", LONG), (3, None, None), (3, None, None), (None, None, ""), (None, None, "")])
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got) == [
        ("3", "response", None, 0), ("3", "response", None, 0), ("7", "response", None, 336),
        ("7", "response", None, 336), ("7", "response", None, 337), ("9", "revisit", 7, 336),
        ("9", "revisit", 7, 336), ("None", "response", None, 0), ("None", "response", None, 0),
        ("None", "revisit", 7, 336)]


def test_many_copies_of_one_page(spark):
    rows = [(i // 50, "u", LONG) for i in range(500)] + [(1000 + i, "v", f"{LONG}{i}") for i in range(100)]
    got = rows_of(spark, rows)
    assert len(got) == 600
    assert sum(r.record_type == "response" for r in got) == 150
    assert all(r.refers_to == 0 for r in got if r.record_type == "revisit")


def test_empty_table(spark):
    assert rows_of(spark, []) == []


def test_records_join_by_either_direction(spark):
    records = spark.createDataFrame([
        ("response", "r1", ["q1"], None, "u", "d", 1, {}),      # names its request
        ("request", "q1", [], None, "u", None, None, {"method": "GET"}),
        ("metadata", "m1", ["r1"], None, "u", None, None, {"key": "1"}),
        ("metadata", "m2", ["r1"], None, "u", None, None, {"key": "2"}),
        ("request", "q9", ["gone"], None, "u", None, None, {}),  # its response is lost
    ], warc.RECORD)
    got = {r.capture_id: r for r in warc.assemble(records).collect()}
    assert [x.record_id for x in got["r1"].requests] == ["q1"]
    assert sorted(x.record_id for x in got["r1"].metadata) == ["m1", "m2"]
    assert got["gone"].response is None and len(got) == 2


def test_a_changed_payload_is_noticed():
    raw = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: r\r\nWARC-Payload-Digest: sha256:00\r\n" \
          b"Content-Length: 10\r\n\r\nH\r\n\r\nbody!\r\n\r\n"
    (headers, block), = warc.parse(io.BytesIO(raw))
    try:
        warc._row(headers, block)
    except ValueError as e:
        assert "digest" in str(e)
    else:
        raise AssertionError("accepted")
