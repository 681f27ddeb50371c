"""Large CSV files: many tasks, the same records as the one-task reader."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from emporia.sources import csv_ranges, files
from emporia.sources.csv_ranges import ends_quoted
from emporia.sources.files import READ_OPTIONS, csv_header, read_csv, read_source_csv, scan_csv
from emporia.sources.schemas import SOURCE_SCHEMAS

REVIEWS = SOURCE_SCHEMAS["order_reviews"]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    held = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def by_characters(line, quoted):
    state = "quoted" if quoted else "begin"
    for c in line:
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif c == ",":
            state = "begin"
        else:
            state = "quoted" if c == '"' and state in ("begin", "quote") else "plain"
    return state == "quoted"


def test_quoting_of_lines_character_by_character():
    for n in range(8):
        for line in map("".join, itertools.product('",x', repeat=n)):
            for quoted in (False, True):
                assert ends_quoted(line, quoted) == by_characters(line, quoted), (line, quoted)


WORDS = ["good", "bad", 'say "so"', "a,b", "line\nbreak", "cr\r\nlf", '"', '""', "\n", ",\n,", "é中😀", "x" * 300, "",
         "lone\rreturn", '",\n"', "tail\\"]


def field(rng, text):
    kind = rng.random()
    if kind < 0.1:
        return rng.choice(["", '""', "plain", '5" pipe', 'a"b"c', '"shut"open', " spaced "])
    return '"' + text.replace('"', '""') + '"'


def reviews(path, seed, n, end="\n"):
    rng = random.Random(seed)
    rows = [",".join(REVIEWS.fieldNames())]
    for k in range(n):
        comment = " ".join(rng.choices(WORDS, k=rng.choice([0, 1, 3, 8] if k % 97 else [60])))
        rows.append(f"r{k},o{k % 50},{rng.randrange(1, 6)},{field(rng, rng.choice(WORDS))},{field(rng, comment)},2017-01-0{1 + k % 9},")
        if rng.random() < 0.02:
            rows.append("")
    path.write_bytes((end.join(rows) + (end if seed % 2 else "")).encode())


def one_task(spark, path, header):
    ddl = ", ".join(f"`{h}` string" for h in header)
    return spark.read.options(**READ_OPTIONS).option("multiLine", "true").schema(ddl).csv(str(path))


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_equal_to_the_one_task_reader(spark, tmp_path, small_ranges, seed, end):
    path = tmp_path / "order_reviews.csv"
    reviews(path, seed, 1500, end)
    header = csv_header(spark, str(path))
    scan = scan_csv(spark, str(path), REVIEWS, "order_reviews")
    assert scan.files is not None  # not the one-task reader
    assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() >= 4
    want = sorted(map(str, one_task(spark, path, header).withColumn("review_score", F.col("review_score").cast("int")).collect()))
    assert sorted(map(str, scan.good().collect())) == want and len(want) == 1500
    assert scan.bad().count() == 0
    crossing = csv_ranges.range_states(spark, str(path)).where("quoted").count()
    assert crossing > 2


def test_many_files_and_bad_records(spark, tmp_path, small_ranges):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    for k in range(3):
        reviews(folder / f"part-{k}.csv", 10 + k, 400)
    with open(folder / "part-1.csv", "a") as f:
        f.write('\nr,o,five,,"two\nlines",,\nr,o\n')
    scan = scan_csv(spark, str(folder), REVIEWS, "order_reviews")
    assert scan.good().count() == 1200
    bad = sorted(map(tuple, scan.bad().collect()))
    assert [(t, f.rsplit("/", 1)[1], r) for t, f, _, r in bad] == [
        ("order_reviews", "part-1.csv", "order_reviews: the record doesn't have 7 fields"),
        ("order_reviews", "part-1.csv", "order_reviews.review_score: not int: five")]
    assert bad[0][2] == "r,o" and 'five' in bad[1][2] and "two\nlines" in bad[1][2]
    with pytest.raises(Exception, match="7 fields|not int: five"):
        read_source_csv(spark, str(tmp_path), "order_reviews").collect()


def test_files_without_line_breaks_are_read_by_lines(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f'{k},"x ""{k}"", y"\n' for k in range(2000)))
    schema = SOURCE_SCHEMAS["sellers"].__class__.fromDDL("a int, b string")
    scan = scan_csv(spark, str(path), schema)
    assert scan.files is None and scan.rows.rdd.getNumPartitions() >= 4
    assert scan.good().agg(F.sum("a"), F.count_if(F.col("b") == F.concat(F.lit('x "'), "a", F.lit('", y')))).first() == (1999000, 2000)


def test_another_header_and_a_quote_never_closed_fail(spark, tmp_path, small_ranges, monkeypatch):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    reviews(folder / "a.csv", 21, 400)
    text = (folder / "a.csv").read_text()
    (folder / "b.csv").write_text(text.replace("review_score", "score", 1))
    with pytest.raises(Exception, match="another header"):
        scan_csv(spark, str(folder), REVIEWS, "order_reviews").good().collect()
    monkeypatch.setattr(csv_ranges, "MAX_RECORD", 20_000)
    (folder / "b.csv").write_text(text + '\nr,o,1,"never closed\n' + "x,y\n" * 10_000)
    with pytest.raises(Exception, match="quote not closed"):
        scan_csv(spark, str(folder), REVIEWS, "order_reviews").good().collect()


def test_compressed_files_and_small_ones_take_one_task(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write('a\n"x\ny"\n' * 1 + "z\n" * 5000)
    schema = SOURCE_SCHEMAS["sellers"].__class__.fromDDL("a string")
    assert not files._larger_than_a_split(spark, files._data_files(spark, str(tmp_path)))
    assert read_csv(spark, str(tmp_path / "t.csv.gz"), schema).count() == 5001
