import csv

import pytest
from helpers import rows
from pyspark.sql import functions as F

from grainframe.sources import infer_types, quoted_records, quoted_to_parquet, scan_csv, scan_quoted

ODD = (
    'id,"a ""long""\nname",note\r\n'
    '1,plain,x\r\n'
    '2,"two\nlines, and ""quotes""",\r\n'
    '\r\n'
    '\n'
    '3,"a\r\nb\n\n\nc",""\n'
    '4,"ends here\n",é\n'
    ',,\n'
    '5,"' + "long line of a very long field\n" * 400 + '",last\n'
    '6,no line feed at the end,z'
)
NAMES = ["id", 'a "long"\nname', "note"]
FIELDS = "id int, name string, note string"


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        for n, v in zip(names, (size, "1")):
            spark.conf.set(n, v)

    yield use
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", ["7", "64", "1000", "128m"])
def test_equal_to_a_sequential_reader(spark, tmp_path, small_splits, size):
    for i in range(2):
        (tmp_path / f"part{i}.csv").write_bytes(ODD.encode())
    small_splits(size)
    path = tmp_path.as_uri()
    with open(tmp_path / "part0.csv", newline="") as file:
        fields = [r for r in csv.reader(file) if r][1:]
    expected = [(int(i) if i else None, n or None, x or None) for i, n, x in fields] * 2
    assert len(expected) == 14 and set(rows(scan_quoted(spark, path, FIELDS))) == set(expected)
    records = quoted_records(spark, path)
    assert records.where("first").count() == 2 and records.count() == 16
    if size == "64":
        assert records.sparkSession.read.text(path).rdd.getNumPartitions() > 100


def test_equal_to_the_whole_file_reader(spark, tmp_path, small_splits):
    (tmp_path / "one.csv").write_bytes(ODD.replace("\r", "").encode())
    small_splits("50")
    expected = rows(scan_csv(spark, tmp_path.as_uri(), FIELDS))
    assert len(expected) == 7 and rows(scan_quoted(spark, tmp_path.as_uri(), FIELDS)) == expected


def test_names_and_types_from_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(ODD.encode())
    found = quoted_to_parquet(spark, tmp_path.as_uri(), (tmp_path / "out").as_uri())
    assert found.columns == NAMES
    assert [f.dataType.simpleString() for f in found.schema] == ["int", "string", "string"]
    (tmp_path / "b.tsv").write_text("k\td\tt\tb\tempty\tmixed\tbig\n1\t2001-01-01\t2001-01-01 10:00:00\ttrue\t\t1\t5000000000\n2.5\t\t\t\t\tx\t1\n")
    typed = scan_quoted(spark, (tmp_path / "b.tsv").as_uri(), sep="\t")
    assert dict(typed.dtypes) == {"k": "double", "d": "date", "t": "timestamp", "b": "boolean", "empty": "string",
                                  "mixed": "string", "big": "bigint"}


def test_no_rows_and_no_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,name,note\n")
    assert scan_quoted(spark, (tmp_path / "h.csv").as_uri(), FIELDS).count() == 0
    (tmp_path / "e.csv").write_text("")
    assert scan_quoted(spark, (tmp_path / "e.csv").as_uri(), FIELDS).count() == 0
    with pytest.raises(ValueError, match="no header"):
        scan_quoted(spark, (tmp_path / "e.csv").as_uri())


def test_unclosed_quotes_are_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,name,note\n1,"never closed,x\n2,b,y\n')
    with pytest.raises(ValueError, match="never closed in .*bad.csv"):
        scan_quoted(spark, tmp_path.as_uri(), FIELDS)


def test_types_of_text_columns(spark):
    df = spark.createDataFrame([("1", None, "0"), ("-7", None, "1e3")], "a string, b string, `c.d` string")
    assert infer_types(df) == {"a": "int", "b": "string", "c.d": "double"}
    assert infer_types(df.where(F.lit(False))) == {"a": "string", "b": "string", "c.d": "string"}
    loose = spark.createDataFrame([("yes", "12:30", "2001-1")], "a string, b string, c string")
    assert set(infer_types(loose).values()) == {"string"}
