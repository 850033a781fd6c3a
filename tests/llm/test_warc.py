import io

import duckdb
import pytest
from check_oracle import compare
from pyspark.sql import functions as F

from grainframe.llm.queries import ORACLES, QUERIES
from grainframe.llm.warc import convert_and_read, members, read_archives, read_warc, warc_record

SCHEMA = "page_id long, url string, html string, key string, payload int, original string"
LARGE = "<p>é" * 500


def _pages():
    """Nulls in every column, equal rows, equal pages under other addresses, sizes around the bound."""
    rows = [(1, "http://a", LARGE), (1, "http://a", LARGE), (1, "http://b", LARGE), (2, "http://c", LARGE), (9, None, LARGE),
            (None, "http://d", LARGE), (None, None, LARGE), (None, None, None), (3, "bad url\n\x7f", ""), (4, "http://e", None),
            (5, "u#record=77", "x" * 999), (6, "u", "x" * 999), (7, "u", "y" * 1000), (8, "u", "y" * 1000), (-5, "u", "y" * 1000),
            (11, "long", "word " * 400_000), (None, "only nulls", "z" * 2000), (None, "only nulls", "z" * 2000)]
    return [(*r, "clash", 5, "clash") for r in rows]


def test_query_of_odd_pages_equals_its_sql(spark, tmp_path):
    spark.createDataFrame(_pages(), SCHEMA).write.parquet((tmp_path / "pages.parquet").as_uri())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(QUERIES["op5_warc"](spark, tmp_path.as_uri()), con, ORACLES["op5_warc"]) is None


def test_payloads_survive_and_revisits_refer(spark):
    rows = [(r[0], r[1], r[2].encode() if r[2] is not None else None) for r in _pages()]
    df = spark.createDataFrame(rows, "key long, url string, payload binary")
    found = convert_and_read(df).collect()
    stored = sorted((str(r.key), bytes(r.payload)) for r in found if r.record_type == "response")
    sent = {(str(k), p or b"") for k, _, p in rows}
    assert set(stored) <= sent and len(found) == len(rows)
    assert {r.key: r.refers_to for r in found if r.record_type == "revisit"} == {1: 9, 2: 9, 7: 8, -5: 8}
    assert convert_and_read(df.limit(0)).count() == 0


def test_archives_are_read_as_streams(spark, tmp_path):
    """Many alike pages in one archive, which packs well, leave in small batches."""
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 9000\r\n\r\n" + b"a" * 9000
    sha = "sha1:" + "A" * 32
    one = warc_record("revisit", [("WARC-Target-URI", "u#record=5"), ("WARC-Record-ID", "i"), ("WARC-Date", "d"),
                                  ("WARC-Payload-Digest", sha)], block)
    (tmp_path / "a.warc.gz").write_bytes(one * 300)
    taken = []
    stream = io.BytesIO(one * 300)
    found = sum(1 for _ in read_warc(lambda n: taken.append(n) or stream.read(n)))
    assert found == 300 and set(taken) == {1 << 16}
    files = spark.createDataFrame([("a.warc.gz",)], "file string")
    sizes = read_archives(files, tmp_path.as_uri(), batch_bytes=30_000)
    assert sizes.count() == 300 and sizes.agg(F.sum("payload_bytes")).first()[0] == 300 * 9000
    with pytest.raises(ValueError, match="cut off"):
        list(members(io.BytesIO(one[:-3]).read))
