import gzip
import hashlib
import io
import zlib

from tests.llm.conftest import SF
from voxloom.llm import warc

DATE = "20240102030405"


def arcs(data):
    return list(warc.parse_arc(io.BytesIO(data)))


def test_arc_versions():
    for version in (1, 2):
        body = [b"plain", "é\n\nhttp://x 1 2 3 4\nURL".encode(), b"", b"\r\n\r\n" * 3, bytes(range(256)) * 9000]
        data = warc.arc_version_block(version, DATE, "f.arc") + b"\n"
        offsets = []
        for i, b in enumerate(body):
            offsets.append(len(data))
            data += warc.arc_record(version, f"http://a/{i} b", str(i), b, DATE, len(data), "f.arc") + b"\n"
        for packed in (data, gzip.compress(data), gzip.compress(data[: offsets[1]]) + gzip.compress(data[offsets[1] :])):
            found = arcs(packed)
            assert [r["offset"] for r in found] == offsets and [r["url"] for r in found] == [f"http://a/{i}%20b" for i in range(5)]
            assert [warc.split_http(r["block"])[1] for r in found] == body and {r["date"] for r in found} == {DATE} and not any(r["error"] for r in found)


def foreign(version, line, block):
    """A record as other tools write it."""
    return line.encode("latin-1") + f" {len(block)}\n".encode() + block + b"\n"


GONE = b"HTTP/1.0 404 Not Found\r\nServer: Apache/1.3\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<p>caf\xe9 nicht da</p>"
IMAGE = b"HTTP/1.1 200 OK\nContent-Type: image/gif\n\nGIF89a" + bytes(range(256))
OLD = {
    1: b"filedesc://IA-001.arc 0.0.0.0 19961019000000 text/plain 69\n1 0 InternetArchive\nURL IP-address Archive-date Content-type Archive-length\n",
    2: b"filedesc://IA-002.arc 0.0.0.0 19970101000000 text/plain 200 - - 0 IA-002.arc 122\n2 0 InternetArchive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n",
}


def old_file(version):
    tail = "" if version == 1 else " 404 - - 300 IA-002.arc"
    head = OLD[version]
    line, _, block = head.partition(b"\n")
    head = line.rsplit(b" ", 1)[0] + f" {len(block)}\n".encode() + block + b"\n"
    return head + b"".join([
        foreign(version, f"http://a.example/caf\xe9 bar.html 10.0.0.1 19961019120000 text/html; charset=iso-8859-1{tail}", GONE),
        foreign(version, f"http://a.example/x.gif 10.0.0.1 19961019120001 image/gif{tail}", IMAGE),
        foreign(version, f"dns:a.example 10.0.0.2 19961019120002 text/dns{tail}", b"a.example. 60 IN A 10.0.0.1\n"),
        foreign(version, f"http://b.example/y.gif - 19961019120003 image/gif{tail}", IMAGE.replace(b"200 OK", b"203 Copy")),
    ])


def test_files_of_other_tools(spark, tmp_path):
    """Headers, statuses and bytes are kept; blanks in URLs and types are read; broken records are reported."""
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "one.arc").write_bytes(old_file(1))
    (tmp_path / "arc" / "two.arc.gz").write_bytes(gzip.compress(old_file(2)))
    broken = old_file(1)
    cut = broken.index(b"http://a.example/x.gif")
    (tmp_path / "arc" / "bad.arc").write_bytes(broken[:cut] + b"no header at all\n\xff\xfe\x00 1 2 3\n" + broken[cut:] + b"http://late/ 10.0.0.1 19961019120009 text/html 5000\nshort")
    (tmp_path / "arc" / "worse.arc.gz").write_bytes(gzip.compress(old_file(1))[:-200])
    found = {(r["file"].rsplit("/", 1)[-1], r["error"]) for r in warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc").collect()}
    assert {f for f, _ in found} >= {"bad.arc"} and any("that are no ARC record" in e for _, e in found) and any("before a declared length" in e for _, e in found)
    rows = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    assert not any(r["error"] for r in rows)
    for name in ("one", "two", "bad"):
        own = {r["url"].rsplit("/", 1)[-1]: r for r in rows if f"-{name}." in r["file"]}
        assert set(own) == {"caf%E9%20bar.html", "x.gif", "dns:a.example", "y.gif"}
        gone = own["caf%E9%20bar.html"]
        assert gone["header"] + (gone["payload"] or b"") in (GONE, warc.split_http(GONE)[0])
        assert own["y.gif"]["header"].startswith(b"HTTP/1.1 203 Copy") and own["y.gif"]["type"] == "revisit"
        assert own["dns:a.example"]["header"] == b"" and own["dns:a.example"]["type"] in ("resource", "revisit")
    whole = [r for r in rows if r["type"] == "response" and r["url"].endswith("x.gif")]
    assert len(whole) == 1 and whole[0]["header"] + whole[0]["payload"] == IMAGE and whole[0]["digest"] == hashlib.sha256(warc.split_http(IMAGE)[1]).hexdigest()
    assert {r["digest"] for r in rows if r["url"].endswith(".gif")} == {whole[0]["digest"]} and {r["size"] for r in rows if r["url"].endswith(".gif")} == {whole[0]["size"]}
    assert any(r["payload"] and r["payload"] == warc.split_http(GONE)[1] for r in rows)


def test_members_and_types(tmp_path, spark):
    """A gzip member per record, each of which can be read alone."""
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "one.arc").write_bytes(old_file(1))
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", least=10**6)
    (file,) = (tmp_path / "warc").glob("*.warc.gz")
    data, members = file.read_bytes(), []
    while data:
        d = zlib.decompressobj(31)
        members.append(d.decompress(data))
        data = d.unused_data
    assert len(members) == 5 and all(m.startswith(b"WARC/1.1\r\nWARC-Type: ") and m.endswith(b"\r\n\r\n") for m in members)
    assert b"WARC-Type: resource" in members[3] and b"Content-Type: text/dns\r\n" in members[3] and b"WARC-IP-Address" not in members[4]
    assert GONE in members[1] and b"Content-Type: application/http; msgtype=response\r\n" in members[1]


def test_broken_archives():
    good = warc.arc_version_block(1, DATE, "f.arc") + b"\n"
    for bad in (b"http://a 127.0.0.1 20240101 text/html x\n", b"http://a 127.0.0.1 20240101 text/html 50\nshort", b"too few 5\n12345"):
        assert [bool(r["error"]) for r in arcs(good + bad)] == [True]
        more = arcs(good + bad[: bad.index(b"\n") + 1] + b"\n" + warc.arc_record(1, "http://b", "1", b"x" * 60, DATE, 0, "f") + b"\n")
        assert more[-1]["error"] is None or b"50" in bad
    assert arcs(b"filedesc://f 0 1 text/plain 8\n9 0 own\n")[0]["error"] and arcs(b"") == []
    assert list(warc.parse_warc(io.BytesIO(b"")))== []
    (one, two) = warc.parse_warc(io.BytesIO(b"junk\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"))
    assert one["error"] and two["block"] == b"abc" and two["offset"] == 5


def test_dates():
    assert warc.iso_date(DATE) == "2024-01-02T03:04:05Z" and warc.iso_date("20240102") == "2024-01-02T00:00:00Z"


def brute(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        other = first.get(p) if len(p) >= 100 and first.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if other is None else "revisit", other))
    return sorted(out, key=repr)


def test_edge_rows(spark):
    html = ["<p>" + "x" * n + "é\r\n\r\nWARC/1.1\r\n</p>" for n in (10, 90, 200, 300_000)] + [None, "", "\n", "\r\n\r\n"]
    rows = [(10 * k + i, f"http://h/{i}", h) for k in range(3) for i, h in enumerate(html)]
    rows += [(None, "http://none/", html[2]), (2, "http://again/", html[2]), (2, None, html[2]), (99, "bad url\nwith é", html[3]), (98, "", "only " * 40)]
    df = spark.createDataFrame([(*r, "extra", 5) for r in rows], "page_id long, url string, html string, id string, size int").repartition(3)
    assert sorted((tuple(r) for r in warc.archive_round_trip(df).collect()), key=repr) == brute(rows)


def test_table(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert sorted((tuple(r) for r in warc.archive_round_trip(df).collect()), key=repr) == brute([(r["page_id"], r["url"], r["html"]) for r in df.collect()])


def test_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "same " * 30), (2, "http://b/", "same " * 30)], "page_id long, url string, html string").coalesce(1)
    warc.write_arc(pages, f"{tmp_path}/arc")
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    records = [(r["head"], r["block"]) for f in (tmp_path / "warc").glob("*.gz") for r in warc.parse_warc(io.BytesIO(f.read_bytes()))]
    heads = {h["x-refers-to-page-id"] if h["warc-type"] == "revisit" else h["warc-type"]: h for h, _ in records if h["warc-type"] != "warcinfo"}
    assert heads["1"]["warc-refers-to"] == heads["response"]["warc-record-id"] and heads["1"]["warc-target-uri"] == "http://b/"
    assert len({h["warc-record-id"] for h, _ in records}) == len(records) and heads["response"]["warc-date"] == "2024-01-01T00:00:00Z"
    for head, block in records:
        assert head["warc-block-digest"] == "sha256:" + hashlib.sha256(block).hexdigest() and int(head["content-length"]) == len(block)


def test_empty(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
