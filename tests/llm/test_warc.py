"""Archives written, read by an independent reader and by the operator; transactions against plain Python."""

import gzip
import io
import random
from collections import Counter
from hashlib import sha256

import pytest

from passagemill.llm import warc
from passagemill.llm.shared import store

SCHEMA = "page_id long, url string, html string, digest string, key long"


def pages(n=60):
    rng = random.Random(4)
    bodies = [f"<p>{i}</p>" * rng.choice([1, 30]) for i in range(n // 4)] + ["é" * 50, "e" * 99, "e" * 100, "\r\n\r\nWARC/1.1\r\n" * 20, "", None]
    rows = [(i, rng.choice([None, f"http://h{i % 5}.org/a b?q=é&x={i}\r\nEvil: 1", "no url", "http://[bad", ""]), rng.choice(bodies), "x", 0) for i in range(n)]
    hot = "hot page " * 100
    return rows + [(1000 + i, "http://x.org/", hot, "x", 0) for i in range(40)] + [rows[3]] * 3 + [(None, None, hot, "", 1), (1000, "http://x.org/", hot, "x", 0)]


def expected(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        groups.setdefault(r[2] or "", []).append(r)
    out = Counter()
    for body, group in groups.items():
        raw = body.encode()
        for i, r in enumerate(group):
            again = len(raw) >= 100 and i > 0
            out[r[0], r[1], len(raw), sha256(raw).hexdigest(), "revisit" if again else "response", group[0][0] if again else None] += 1
    return out


@pytest.fixture(scope="module")
def archives(spark):
    return warc.write_archives(spark.createDataFrame(pages(), SCHEMA).repartition(4), archive_bytes=4000, date="2024-01-02T03:04:05Z")


def test_captures_tell_the_pages(spark, archives):
    records = store(warc.read_records(archives), "records")
    captures = warc.assemble_transactions(records)
    found = warc.page_captures(captures)
    assert found.columns == ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, found.collect())) == expected(pages())
    rows = captures.collect()
    assert len({r.record_id for r in rows}) == len(pages())
    assert all(r.n_requests == r.n_metadata == 1 and r.request.head.startswith("GET /") and r.metadata.record_id != r.record_id for r in rows)
    assert Counter(bytes(r.response.payload).decode() for r in rows if r.type == "response") == Counter(
        body for (_, _, _, d, kind, _), n in expected(pages()).items() if kind == "response" for body in [{sha256((p[2] or "").encode()).hexdigest(): p[2] or "" for p in pages()}[d]] * n
    )
    light = warc.read_records(archives, payloads=False)
    assert light.drop("payload").exceptAll(records.drop("payload")).isEmpty() and light.where("payload IS NOT NULL").isEmpty()


def test_archives_are_gzip_members_of_bounded_size(archives):
    rows = archives.collect()
    assert len(rows) > 4 and sum(r.n_records for r in rows) == 3 * len(pages())
    for r in rows:
        raw = open(r.path.removeprefix("file://"), "rb").read()
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and raw.count(b"\x1f\x8b\x08") >= r.n_records
        plain = list(warc.parse_archive(io.BytesIO(text)))
        assert plain == list(warc.parse_archive(io.BytesIO(raw))) and len(plain) == r.n_records
        with pytest.raises(ValueError):
            list(warc.parse_archive(io.BytesIO(raw[:-5])))


def test_transactions_of_other_writers(spark):
    def row(record_id, kind, concurrent_to, head=""):
        return (record_id, kind, None, None, concurrent_to, None, None, None, head, None)

    rows = [
        row("r1", "response", ["q1"]), row("q1", "request", [], "named by r1"), row("m1", "metadata", ["r1", "r2"], "shared"),
        row("m0", "metadata", ["r1"], "smaller"), row("r2", "revisit", []), row("q9", "request", ["gone"]), row("i", "warcinfo", ["r1"]), row("r3", "response", ["q1", "q1"]),
    ] + [row(f"x{i:05d}", "metadata", ["r3"]) for i in range(3000)]
    found = {r.record_id: r for r in warc.assemble_transactions(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    assert set(found) == {"r1", "r2", "r3"} and found["r2"].request is None and found["r2"].metadata.record_id == "m1"
    assert (found["r1"].request.record_id, found["r1"].metadata.record_id, found["r1"].n_requests, found["r1"].n_metadata) == ("q1", "m0", 1, 2)
    assert (found["r3"].n_requests, found["r3"].n_metadata, found["r3"].metadata.record_id) == (1, 3000, "x00000")


def test_wrong_digest_is_an_error(spark, tmp_path):
    record = warc._record("response", "<urn:x>", "d", {"WARC-Payload-Digest": "sha256:00"}, b"HTTP/1.1 200 OK\r\n\r\nbody")
    (tmp_path / "a.warc").write_bytes(record)
    archives = spark.createDataFrame([(f"file://{tmp_path}/a.warc",)], "path string")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_records(archives).collect()


def test_empty_and_long(spark):
    none = warc.write_archives(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and warc.page_captures(warc.assemble_transactions(warc.read_records(none))).collect() == []
    text = "long " * 1_000_000
    one = warc.write_archives(spark.createDataFrame([(1, "http://a/", text, "", 0)], SCHEMA))
    assert warc.page_captures(warc.assemble_transactions(warc.read_records(one))).first().payload_bytes == len(text)
