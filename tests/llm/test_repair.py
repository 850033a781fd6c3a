import random
import time

import brute_repair
import duckdb
import pytest
from check_oracle import compare, connect

from grainframe.llm.conversations import BLANK, DUPLICATE, TRUNCATED, cheapest_edits, code_of, damaged, repair_report
from grainframe.llm.queries import ORACLES, QUERIES

FAULTS = {"sound": 0, "blank": BLANK, "duplicate": DUPLICATE, "truncated": TRUNCATED}
SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost int"


def test_search_against_brute_force():
    rng = random.Random(11)
    for n in [*range(8)] * 150 + [15, 16, 17, 33, 80] * 20:
        rows = [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), "t", rng.choice([*FAULTS, "sound"])) for _ in range(n)]
        cost, audit, _ = brute_repair.cheapest(rows)
        assert cheapest_edits(bytes(code_of(r, FAULTS[f]) for r, _, f in rows)) == (cost, audit)


def test_search_time_grows_with_rows():
    codes = bytes(random.Random(1).choices(range(16), k=40_000))
    start = time.time()
    cost, audit = cheapest_edits(codes)
    assert cost > 0 and len(audit) - audit.count("I") == 40_000 and time.time() - start < 60


@pytest.fixture(scope="module")
def conversations(spark):
    """Nulls in every column, ties, repeated rows, gaps, a very long text, one long conversation."""
    rng = random.Random(5)
    rows = [(None, None, None, None, "x", 1)] * 3 + [(7, None, "user", "Hi.", "x", 1)] * 2
    rows += [(8, t, None if t % 5 == 0 else "user", None if t % 7 == 0 else "Same.", "x", 1) for t in range(30)]
    rows += [(9, 3, r, t, "x", 1) for r in ("user", "assistant", "") for t in ("One.", "two", "Ünï? ", "  \n")]
    rows += [(10, 1, "user", "word " * 200_000 + ".", "x", 1), (10, 5, "assistant", "Ok!\x0b\t", "x", 1)]
    rows += [(c, 0, "user", "Alone.", "x", 1) for c in range(100, 140)]
    rows += [(11, rng.randrange(90), rng.choice(["system", "user", "assistant", "tool"]),
              rng.choice(["A.", "b", "", "c!"]), "x", 1) for _ in range(400)]
    return rows


def _found(df):
    return {tuple(r) for r in df.collect()}


def test_report_against_brute_force(spark, folder, conversations):
    odd = spark.createDataFrame(conversations, SCHEMA)
    assert _found(repair_report(damaged(odd))) == brute_repair.report([r[:4] for r in conversations])
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_conversation_repair"](spark, folder)
    assert _found(found) == brute_repair.report(rows) and found.count() == table.select("conv_id").distinct().count()


def test_no_conversations(spark, conversations):
    empty = spark.createDataFrame(conversations, SCHEMA).where("false")
    assert repair_report(damaged(empty)).count() == 0


def test_query_equals_its_sql(spark, folder, conversations, tmp_path):
    name = "op11_conversation_repair"
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None
    spark.createDataFrame(conversations, SCHEMA).write.parquet((tmp_path / "conversations.parquet").as_uri())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert compare(QUERIES[name](spark, tmp_path.as_uri()), con, ORACLES[name]) is None
