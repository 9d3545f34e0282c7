"""Archives: round trips, records of other writers, and assembly against the definition."""

import base64
import gzip
import hashlib
import random

from tablecraft.llm.warc import assemble, page_captures, read_records, write_pages

SCHEMA = "page_id long, url string, html string, type string, digest string"


def pages():
    pick = random.Random(2)
    odd = ["\r", "\n", "\r\n", "\r\n\r\n", "WARC/1.1\r\n", "x", "é", "\x00", "Content-Length: 5"]
    rows = [(i, f"http://h{i % 3}.org/a b\r\n{i}", "".join(pick.choices(odd, k=pick.randint(0, 40))), "t", "d") for i in range(200)]
    rows += [(500 + i, None, "<p>same</p>", "t", None) for i in range(20)] + [(600 + i, "http://none", None, None, "d") for i in range(5)]
    rows += [(700, "http://long", "long \r\n\r\n" * 200_000, "t", "d"), (None, "http://lost", "<p>same</p>", None, None), (None, "http://gone", "only here", None, None)]
    return rows + [rows[0], rows[205]]


def want(rows):
    first = {}
    for k, _, h, *_ in rows:
        if k is not None:
            first[h or ""] = min(first.get(h or "", k), k)
    out = []
    for k, _, h, *_ in rows:
        data = (h or "").encode()
        top = first.get(h or "", k)
        revisit = k != top
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return out


def test_round_trip(spark, tmp_path, rows):
    write_pages(spark.createDataFrame(pages(), SCHEMA).repartition(3), str(tmp_path / "a"))
    records = read_records(spark, str(tmp_path / "a"))
    captures = assemble(records)
    assert rows(page_captures(captures)) == sorted(want(pages()), key=repr)
    kept = {r.page: r.html for r in captures.where("response.type = 'response'").selectExpr(
        "metadata.fields['page'] as page", "cast(response.payload as string) as html").collect()}
    assert all(kept[str(k)] == (h or "") for k, _, h, *_ in pages() if str(k) in kept and k < 500)
    assert captures.where("request is null or metadata is null").count() == 0
    light = page_captures(assemble(read_records(spark, str(tmp_path / "a"), payloads=False)))
    assert rows(light) == sorted(want(pages()), key=repr)


def test_small_payloads_are_not_revisited(spark, tmp_path):
    write_pages(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string"), str(tmp_path / "b"), least=3)
    got = page_captures(assemble(read_records(spark, str(tmp_path / "b"))))
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got.collect()) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_records_of_other_writers(spark, tmp_path):
    def record(kind, block, **more):
        head = {"WARC-Type": kind, **{k.replace("_", "-"): v for k, v in more.items()}, "Content-Length": len(block)}
        return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nX-Long: a\r\n  b\r\n\r\n\xff\xfe\r\n\r\nbody\r\n"
    stored = [record("warcinfo", b"software: x\r\n", WARC_Record_ID="<i>", Content_Type="application/warc-fields"),
              record("response", http, WARC_Record_ID="<r>", Content_Type="application/http;msgtype=response"),
              record("metadata", b"", WARC_Record_ID="<m>", WARC_Concurrent_To="<r>"), record("request", b"q", WARC_Record_ID="<q>", WARC_Concurrent_To="<other>"),
              record("resource", b"\r\n\r\n\r\n", WARC_Record_ID="<s>")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in stored) + gzip.compress(b"junk\r\n\r\nWARC/1.0\r\nContent-Length: 99\r\n\r\nshort"))
    records = read_records(spark, str(tmp_path / "x.warc.gz"))
    got = {r.record_id: r for r in records.collect()}
    assert set(got) == {"<i>", "<r>", "<m>", "<q>", "<s>"}
    assert got["<r>"].payload == b"\xff\xfe\r\n\r\nbody\r\n" and got["<r>"].fields["x-long"] == "a b"
    assert got["<s>"].payload == b"\r\n\r\n\r\n" and got["<m>"].payload_bytes == 0 and got["<i>"].fields == {"software": "x"}
    one = assemble(records).collect()
    assert [(r.record_id, r.copies, r.request, r.metadata.record_id) for r in one] == [("<r>", 1, None, "<m>")]


def test_no_pages(spark, tmp_path):
    write_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert page_captures(assemble(read_records(spark, str(tmp_path / "none")))).count() == 0
