"""Archives written and read back, and archives of others."""

from __future__ import annotations

import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

pytest.importorskip("strataflux.llm")
from strataflux.llm import queries, warc  # noqa: E402

PAGES = "page_id long, url string, html string, record_type string, payload string"
BIG = "<p>é" + "x" * 200 + "</p>"


def rows():
    out = [(k, f"http://h{k % 3}/{k}", f"<p>page {k} ü {'y' * (k * 37)}</p>", "t", "p") for k in range(60)]
    out += [(100 + k, None, BIG, None, None) for k in range(30)] + [(99, "http://a/\r\nInjected: 1", BIG, None, None)]
    out += [(200, "u", None, None, None), (201, "u", "", None, None), (202, "u", "short", None, None), (203, "u", "short", None, None), (None, None, None, None, None), (None, "n", BIG, None, None)]
    out += [(300, "u", "z" * 100, None, None), (301, "u", "z" * 100, None, None), (302, "u", "é" * 50, None, None), (303, "u", "w" * 99, None, None), (304, "u", "w" * 99, None, None)]
    out += [(400, "u", "twice" * 40, None, None)] * 2 + [(401, "u", "twice" * 40, None, None), (None, "u", "nulls" * 40, None, None), (None, "v", "nulls" * 40, None, None)]
    return out + [(500, "u", "\r\n\r\nWARC/1.1\r\n" * 40_000, None, None)]


def brute(rows):
    first = {}
    for i, _, html, *_ in rows:
        if html and len(html.encode()) >= 100 and i is not None:
            first[html] = min(first.get(html, i), i)
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        to = first.get(html) if len(data) >= 100 and first.get(html) != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    spark.createDataFrame(rows(), PAGES).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op11_warc(spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows())


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc"))
    warc.register(spark)
    warc.with_revisits(spark.createDataFrame(rows(), PAGES).repartition(3)).write.format("warc").mode("append").option("filebytes", "2000").save(path)
    return path


def test_records_are_as_the_format_has_them(archive):
    """Every file is gzip that others read, with a member for each record whose length the member tells."""
    seen = 0
    for name in os.listdir(archive):
        if not name.endswith(".gz"):
            continue
        raw = open(f"{archive}/{name}", "rb").read()
        text = gzip.decompress(raw)
        at = 0
        while at < len(raw):
            size = int.from_bytes(raw[at + 16 : at + 20], "little")
            record = gzip.decompress(raw[at : at + size])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            head, _, rest = record.partition(b"\r\n\r\n")
            assert int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0]) == len(rest) - 4
            at, seen = at + size, seen + (b"warcinfo" not in head)
        assert at == len(raw) and text.startswith(b"WARC")
    assert seen == len(rows())


def test_pushdown_and_decoding(spark, archive):
    """Filters reach the source, and those it does not know stay with Spark."""
    with warc.pushdown(spark):
        df = lambda: warc.read(spark, archive)
        picked = df().where((F.col("record_type") == "revisit") & F.col("target_uri").isNull())
        assert " Filter " not in picked._jdf.queryExecution().executedPlan().toString()
        assert picked.count() == 30
        some = df().where(F.col("record_id").startswith("urn:page:10") & ~F.col("record_type").isin("warcinfo") & (F.size("headers") > 3)).select("record_id", "payload").collect()
        assert sorted(r[0] for r in some) == ["urn:page:10", *(f"urn:page:10{k}" for k in range(10))]
        assert {len(r[1]) for r in some if r[0] != "urn:page:10"} == {0}
        parts = [~(F.col("target_uri") == "u"), F.col("target_uri") == "u", F.col("target_uri").isNull()]
        assert sum(df().where(p).count() for p in parts) == df().count()


def test_payloads_are_skipped(archive):
    """What is not wanted is not inflated: only headers of members are."""
    import pyarrow.fs as fs
    from pyspark.sql.datasource import EqualTo

    local, inflated = fs.LocalFileSystem(), []
    for name in os.listdir(archive):
        if name.endswith(".gz"):
            with local.open_input_file(f"{archive}/{name}") as f:
                got = list(warc.records(f, True, [EqualTo(("record_id",), "urn:page:500")], {"payload"}))
                inflated += got
    assert len(inflated) == 1 and len(inflated[0]["payload"]) == 40_000 * 14


def test_lost_tasks_leave_nothing(spark, archive):
    """Files without a manifest's word do not count, and overwriting replaces all."""
    stray = f"{archive}/stray.warc"
    with open(stray, "wb") as f:
        f.write(b"no record at all")
    with warc.pushdown(spark):
        assert warc.read(spark, archive).where("record_type <> 'warcinfo'").count() == len(rows())
        spark.createDataFrame([(1, "u", "only")], "page_id long, url string, html string").transform(warc.with_revisits).write.format("warc").mode("overwrite").option("compression", "none").save(archive)
        got = warc.read(spark, archive).where("record_type <> 'warcinfo'").collect()
    assert [(r["record_id"], bytes(r["payload"]), r["payload_bytes"]) for r in got] == [("urn:page:1", b"only", 4)]
    names = os.listdir(archive)
    assert len([n for n in names if n.startswith("_manifest")]) == 1 and json.load(open(f"{archive}/{next(n for n in names if n.startswith('_manifest'))}"))["files"]


@pytest.mark.parametrize("form", ["plain", "one member", "members", "members at odd places"])
def test_archives_of_others(spark, tmp_path, form):
    """Plain files, one member for all records, members without lengths, folded lines, other types, no HTTP."""
    parts = []
    for k in range(40):
        block = b"" if k % 5 == 0 else (f"HTTP/1.0 404 No\r\nX: y\r\n\r\n{'b' * k * 999}".encode() if k % 2 else b"plain \r\n\r\n " + b"c" * k * 5000)
        kind = "application/http; msgtype=response" if k % 2 else "text/plain"
        parts.append(f"WARC/1.0\r\nwarc-type: {'response' if k % 2 else 'resource'}\r\nWARC-Record-ID: <urn:x:{k}>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nX-Long: a\r\n b\r\nContent-Type: {kind}\r\ncontent-length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    data = b"".join(parts)
    if form == "plain":
        name = "a.warc"
    else:
        pieces = [data] if form == "one member" else parts if form == "members" else [data[k : k + 7777] for k in range(0, len(data), 7777)]
        data, name = b"".join(map(gzip.compress, pieces)), "a.warc.gz"
    (tmp_path / name).write_bytes(data)
    warc.register(spark)
    with warc.pushdown(spark):
        want = {}
        for k in range(40):
            want[f"urn:x:{k}"] = 0 if k % 5 == 0 else k * 999 if k % 2 else 11 + k * 5000
        assert {r["record_id"]: (r["payload_bytes"], len(r["payload"]), r["headers"]["x-long"]) for r in warc.read(spark, str(tmp_path)).collect()} == {k: (n, n, "a b") for k, n in want.items()}
        assert warc.read(spark, str(tmp_path)).where("record_type = 'resource'").select("record_id").count() == 20
        short = warc.read(spark, str(tmp_path), "record_id string, payload_bytes long").where("record_id > 'urn:x:3'")
        assert {r[0]: r[1] for r in short.collect()} == {k: n for k, n in want.items() if k > "urn:x:3"}
