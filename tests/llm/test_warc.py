import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm.common import scratch
from plumbline.llm.warc import SEP, read_archives, records, resolved, write_archives


def record(payload: bytes) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % (len(http) + len(payload)) + http + payload + SEP.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("\r\na W", max_size=30), max_size=5))
def test_a_stream_cut_at_blank_lines_is_put_together(payloads):
    whole = b"".join(record(p.encode()) for p in payloads)
    pieces = whole.split(SEP.encode())
    if pieces and not pieces[-1]:
        pieces.pop()
    assert [p for _, _, p in records(iter(pieces))] == [p.encode() for p in payloads]


def run(spark, rows, **options):
    folder = scratch(spark, "test-warc")
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"), folder, **options)
    return folder, {(r.id, r.record_type, r.bytes, r.digest, r.refers_to) for r in resolved(read_archives(spark, folder)).collect()}


def test_revisits_round_trip(spark):
    big, other, tricky = "x" * 100, "é" * 50, "\r\n\r\nWARC/1.1\r\n" * 20 + "\r\n"
    rows = [(5, "u", big, "q"), (2, "v\r\nX: y", big, None), (9, None, big, "q"), (3, "u", other, "q"), (4, "u", tricky, "q"), (6, "u", tricky, "q"), (7, "u", "x" * 99, "q"), (8, "u", "x" * 99, "q"), (10, "u", None, "q"), (11, "u", "", "q")]
    folder, got = run(spark, rows, records_per_file=3)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    first = {big: 2, tricky: 4}
    want = set()
    for i, _, t, _ in rows:
        again = t in first and first[t] != i
        want.add((i, "revisit" if again else "response", len((t or "").encode()), sha(t), first[t] if again else None))
    assert got == want
    back = {r.id: bytes(r.payload) for r in read_archives(spark, folder, payloads=True).collect() if r.record_type == "response"}
    assert back[4].decode() == tricky and back[3].decode() == other


def test_repeated_and_missing_ids(spark):
    big = "y" * 200
    _, got = run(spark, [(1, "u", big, ""), (1, "u", big, ""), (None, "u", big, ""), (2, "u", big, "")])
    assert {(g[0], g[1], g[4]) for g in got} == {(1, "response", None), (None, "revisit", 1), (2, "revisit", 1)}
    _, got = run(spark, [(None, None, big, ""), (None, None, big, "")])
    assert {(g[0], g[1], g[4]) for g in got} == {(None, "response", None)}


def test_empty(spark):
    assert run(spark, [])[1] == set()


def test_fresh_headers(spark):
    """A revisit names its response's record, address and date; every record id is one of its own."""
    big, other = "z" * 150, "w" * 150
    rows = [(5, "http://b/", big, "q"), (2, "http://a/", big, None), (None, "http://c/", big, ""), (None, "http://d/", other, ""), (2, "http://a/", other, "")]
    folder, _ = run(spark, rows, date="2026-01-02T03:04:05Z")
    text = spark.read.option("lineSep", SEP).text(folder).collect()
    heads = [dict(x.split(": ", 1) for x in r.value.split("\r\n")[1:]) for r in text if r.value.startswith("WARC/")]
    assert {h["WARC-Date"] for h in heads} == {"2026-01-02T03:04:05Z"} and len({h["WARC-Record-ID"] for h in heads}) == 5
    first = next(h["WARC-Record-ID"] for h in heads if h["WARC-Target-URI"] == "http://a/" and h["WARC-Payload-Digest"].endswith(hashlib.sha256(big.encode()).hexdigest()))
    again = [h for h in heads if h["WARC-Type"] == "revisit" and h["WARC-Refers-To"] == first]
    assert len(again) == 2 and all(h["WARC-Refers-To-Target-URI"] == "http://a/" and h["WARC-Refers-To-Date"] == h["WARC-Date"] for h in again)
