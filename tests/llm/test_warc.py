import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import pytest
from tripmart.llm import warc as W

NASTY = "\r\n\r\nWARC/1.1\r\nWARC-Record-ID: <urn:uuid:0>\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>größe 🙂</p>" * 90, "x" * 1000
    rows = [(1, "http://a.example/x?y#z", big), (2, "http://b.example", big), (3, None, big), (4, "u", None), (5, "v", ""),
            (6, "http://c/\r\nX: y", "short"), (7, "w", "short"), (8, "n", NASTY), (9, "n", NASTY * 40), (10, "n", NASTY * 40),
            (11, "l", "long page " * 200_000), (12, "o", other), (12, "o", other), (5, "o", other), (5, "o", other), (None, "q", other),
            (None, "q", other), (None, None, None), (13, "y", "y" * 999), (14, "y", "y" * 999), (7, "w", other + "y")]
    return spark.createDataFrame([(*r, 1, "t", "r") for r in rows], "page_id long, url string, html string, id int, type string, response string")


def refers(rows):
    """(row, page_id that it refers to) of every page."""
    holders = defaultdict(list)
    for r in rows:
        if r.page_id is not None:
            holders[r.html or ""].append(r.page_id)
    for r in rows:
        top = max(holders[r.html or ""], default=None)
        yield r, top if r.page_id is not None and len((r.html or "").encode()) >= W.LEAST and r.page_id < top else None


def plain(rows):
    out = []
    for r, to in refers(rows):
        data = (r.html or "").encode()
        out.append((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(pages):
    got = W.captures(pages).select("page_id", "response.payload_bytes", "response.payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == plain(pages.collect())


def test_archives_hold_three_records_a_page_and_whole_payloads(spark, pages, tmp):
    W.write_archives(pages.repartition(3), f"{tmp}/a", compression="none")
    records = W.read_records(spark, f"{tmp}/a").collect()
    assert len(records) == 3 * pages.count() and len({r.record_id for r in records}) == len(records)
    main = {r.record_id: r for r in records if r.type in ("response", "revisit")}
    assert all(r.concurrent_to in main for r in records if r.type in ("request", "metadata"))
    whole = sorted((r.payload.decode(), r.digest) for r in main.values() if r.type == "response")
    texts = [r.html or "" for r, to in refers(pages.collect()) if to is None]
    assert whole == sorted((t, "sha256:" + hashlib.sha256(t.encode()).hexdigest()) for t in texts)
    assert all(r.payload == b"" for r in main.values() if r.type == "revisit")
    assert any(r.uri == "http://c/%0D%0AX: y" for r in main.values())
    nested = W.assemble(W.read_records(spark, f"{tmp}/a")).collect()
    assert len(nested) == pages.count() and all(r.n_requests == r.n_metadata == 1 for r in nested)
    assert {r.request.http_head.split("\r\n")[0] for r in nested if r.page_id == 1} == {"GET /x?y#z HTTP/1.1"}
    assert {bytes(r.response.payload).decode() for r in nested if r.page_id in (1, 3)} == {"<p>größe 🙂</p>" * 90}


def test_reader_takes_members_and_steps_over_damage(spark, tmp):
    def record(i, block):
        return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{i}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    good = [record(i, b"z" * (i * 700_000)) for i in range(4)]
    Path(tmp, "members.warc.gz").write_bytes(b"".join(map(gzip.compress, good)))
    Path(tmp, "plain.warc").write_bytes(good[0] + b"rubbish" * 300_000 + b"\r\n" + good[3] + good[1][:-900] + b"\r\n" + good[2])
    Path(tmp, "cut.warc.gz").write_bytes(b"".join(map(gzip.compress, good[:2]))[:-30])
    Path(tmp, "empty.warc").write_bytes(b"")
    rows = [(r.type, r.record_id, len(r.payload)) for r in W.read_records(spark, tmp).collect()]
    whole = [("resource", f"<{i}>", i * 700_000) for i in range(4)]
    assert all(rows.count(x) >= 1 for x in whole)
    assert rows.count(whole[0]) == 3 and rows.count(whole[3]) == 2
    assert any(t == "damaged" and n > 2_000_000 for t, _, n in rows)


def test_many_records_of_one_capture_and_empty_tables(spark, pages, tmp):
    rows = [("m", "response", None, "u", "sha256:1", None, "", b"p")] + [
        (f"q{i:03}", k, "m", "u", None, 7, "", b"") for i in range(300) for k in ("request", "metadata")]
    got = W.assemble(spark.createDataFrame(rows, W.RECORDS)).collect()
    assert [(r.n_requests, r.n_metadata, r.request.record_id, r.page_id) for r in got] == [(300, 300, "q000", 7)]
    assert W.captures(pages.limit(0)).collect() == []
