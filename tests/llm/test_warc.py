import gzip
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In
from pyspark.sql.types import StructType

from emporia.llm import warc
from emporia.llm.queries import QUERIES

BIG = "<html>" + "näher " * 40 + "</html>"
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://a/ 4\r\nX: y", "small"),
         (5, "http://a/5", "small"), (6, "http://a/6", None), (7, "http://a/7", ""), (None, "http://a/8", BIG),
         (9, "http://a/9", "WARC/1.0\r\nWARC-Type: fake\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5),
         (10, "http://a/10", "x" * 99), (11, "http://a/11", "x" * 99), (12, "http://a/12", "é" * 50),
         (13, "http://a/13", "é" * 50), (14, "http://a/14", "long " * 100_000)]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    warc.register_warc(spark)
    paths = {}
    for kind in ("none", "gzip"):
        path = paths[kind] = str(tmp_path_factory.mktemp("warc") / kind)
        df = spark.createDataFrame([(*p, "a", "b") for p in PAGES],
                                   "page_id long, url string, html string, id string, payload string")
        warc.write_warc(df.repartition(3), path, compression=kind)
    return paths


def first_of(i, html):
    same = [p for p, _, h in PAGES if p is not None and (h or "") == (html or "")]
    return min(same) if i is not None and len((html or "").encode()) >= 100 and min(same) != i else None


@pytest.mark.parametrize("kind", ["none", "gzip"])
def test_round_trip(spark, archive, kind):
    rows = {r["record_id"]: r for r in spark.read.format("warc").load(archive[kind]).collect()}
    assert len(rows) == len(PAGES)
    for i, url, html in PAGES:
        r, payload = rows[f"<urn:page:{'null' if i is None else i}>"], (html or "").encode()
        first = first_of(i, html)
        assert r["record_type"] == ("response" if first is None else "revisit")
        assert r["refers_to"] == (None if first is None else f"<urn:page:{first}>")
        assert r["payload_digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
        assert r["payload_length"] == len(payload)
        assert bytes(r["payload"]) == (payload if first is None else b"")
        assert r["target_uri"] == (None if url is None else url.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A"))


def test_files_are_warc(spark, archive):
    raw = b"".join(p.read_bytes() for p in sorted(__import__("pathlib").Path(archive["none"]).glob("part-*")))
    assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")
    packed = b"".join(gzip.decompress(p.read_bytes())
                      for p in __import__("pathlib").Path(archive["gzip"]).glob("part-*"))
    assert packed.count(b"WARC-Record-ID:") == raw.count(b"WARC-Record-ID:") == len(PAGES)


def test_predicates_are_pushed_down(spark, archive):
    df = warc.read_revisits(spark, archive["none"])
    assert "payload" not in df.columns
    assert {r["record_id"] for r in df.collect()} == {"<urn:page:2>", "<urn:page:3>", "<urn:page:13>"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter " not in plan.replace("RuntimeFilters", "")
    some = spark.read.format("warc").load(archive["gzip"]).where(
        "record_id in ('<urn:page:4>', '<urn:page:6>') and payload_length > 0 and target_uri like 'http%'")
    assert [bytes(r["payload"]) for r in some.collect()] == [b"small"]


def test_rejected_payloads_are_passed_over(archive):
    class Counting(warc.WarcReader):
        seen = 0

        @staticmethod
        def _batch(rows, arrow):
            Counting.seen += sum(len(v) for r in rows for v in r if isinstance(v, bytes))
            return warc.WarcReader._batch(rows, arrow)

    reader = Counting(StructType.fromDDL(warc.SCHEMA), {"path": archive["none"]})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("<urn:page:4>",)),
                                    GreaterThan(("payload_length",), 1)]))
    assert len(left) == 1
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert pa.Table.from_batches(batches).num_rows == 1 and Counting.seen == 5


def test_partitions_group_files_by_size(archive):
    one = warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": "file:" + archive["none"]}).partitions()
    many = warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": archive["none"], "groupBytes": "1"}).partitions()
    assert len(one) == 1 and len(many) == sum(len(p.files) for p in one)


def test_empty_table(spark, tmp_path):
    warc.register_warc(spark)
    path = str(tmp_path / "empty")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert spark.read.format("warc").load(path).count() == 0


@pytest.mark.parametrize("damage", [b"garbage\r\n", b"WARC/1.0\r\nWARC-Type: response\r\n",
                                    b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"WARC/1.0\r\nA: b\r\n\r\n"])
def test_damaged_archives_fail(tmp_path, damage):
    (tmp_path / "a.warc").write_bytes(damage)
    reader = warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": str(tmp_path)})
    with pytest.raises(ValueError):
        [list(reader.read(p)) for p in reader.partitions()]


def test_hot_payloads_and_rare_ones(spark):
    rows = [(i, "same " * 30 if i % 3 == 0 else f"page {i % 400} " * 20) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, html string").repartition(5)
    keys = df.select("id", F.octet_length("html").alias("bytes"), F.sha2("html", 256).alias("digest"))
    first = {}
    for i, h in rows:
        first.setdefault(h, i)
    got = {r["id"]: r["first"] for r in warc.find_revisits(keys).collect()}
    assert got == {i: first[h] for i, h in rows if first[h] != i}


def rows_of(reader):
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def test_members_are_records(archive):
    for p in __import__("pathlib").Path(archive["gzip"]).glob("part-*"):
        raw, at = p.read_bytes(), 0
        while at < len(raw):
            assert raw[at:at + len(warc.MEMBER)] == warc.MEMBER
            size = int.from_bytes(raw[at + len(warc.MEMBER):at + len(warc.MEMBER) + 4], "little")
            record = gzip.decompress(raw[at:at + size])
            assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
            at += size
        assert at == len(raw)


def packed(spark, tmp_path, pages):
    path = tmp_path / "packed"
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), str(path))
    return path


def test_rejected_payloads_are_not_decompressed(spark, tmp_path):
    noise = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(2000))
    path = packed(spark, tmp_path, [(1, "http://a/1", noise), (2, "http://a/2", "wanted")])
    for f in path.glob("part-*"):  # damage the middle of the long payload
        raw = bytearray(f.read_bytes())
        if len(raw) > 10_000:
            raw[5000:6000] = b"\xff" * 1000
            (tmp_path / "damaged").mkdir(exist_ok=True)
            (tmp_path / "damaged" / f.name).write_bytes(raw)
    broken = str(tmp_path / "damaged")
    headers = warc.WarcReader(StructType.fromDDL("record_id string"), {"path": broken})
    assert "<urn:page:1>" in {r["record_id"] for r in rows_of(headers)}
    other = warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": broken})
    assert not list(other.pushFilters([In(("record_id",), ("<urn:page:2>",))]))
    assert all(r["payload"] == b"wanted" for r in rows_of(other))
    with pytest.raises(ValueError):
        rows_of(warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": broken}))


def test_records_beyond_16_mb_and_members_without_length(spark, tmp_path):
    big = "0123456789abcdef" * (1 << 20) + "the end"  # the size's highest byte isn't 0
    path = packed(spark, tmp_path, [(1, None, big), (2, None, "after it"), (3, None, big)])
    want = {"<urn:page:1>": big.encode(), "<urn:page:2>": b"after it", "<urn:page:3>": b""}

    def payloads(p):
        return {r["record_id"]: r["payload"] for r in rows_of(
            warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": str(p)}))}

    assert payloads(path) == want
    raw = b"".join(f.read_bytes() for f in sorted(path.glob("part-*")))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(gzip.decompress(raw)))
    assert payloads(tmp_path / "whole.warc.gz") == want
    mixed = raw + gzip.compress(b"WARC/1.0\r\nWARC-Record-ID: x\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    (tmp_path / "mixed.warc.gz").write_bytes(mixed)
    assert payloads(tmp_path / "mixed.warc.gz") == want | {"x": b"hi"}


def test_damaged_members_fail(spark, tmp_path):
    path = packed(spark, tmp_path, [(1, None, "one"), (2, None, "two")])
    raw = b"".join(f.read_bytes() for f in sorted(path.glob("part-*")))
    for k, damaged in enumerate([raw[:-3], raw[:40], raw[:-2] + b"\1\0", raw + b"garbage"]):
        (tmp_path / f"{k}.gz").write_bytes(damaged)
        with pytest.raises(ValueError):
            rows_of(warc.WarcReader(StructType.fromDDL(warc.SCHEMA), {"path": str(tmp_path / f"{k}.gz")}))


def test_query(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op5_warc"](spark, sf_small).collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]]["payload_digest"] == hashlib.sha256((p["html"] or "").encode()).hexdigest()
