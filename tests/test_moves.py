from readloom import sources
from readloom.plans import QUERIES


def test_long_reads_keep_all_events(spark, tmp_path):
    n = 12_000
    rows = spark.range(n).selectExpr("id event_id", "cast(id as timestamp) ts", "1l user_id", "'a' event_type", "cast(id % 100 as double) value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, QUERIES["src_moves_to_events"](spark, str(tmp_path)).select("i", "pos", "kmer").collect()))
    pos, want = -1, []
    total = 1 + sum(i % 3 for i in range(1, n))
    assert total > 10_000
    text = ("ACGUUGCAGU" * total)[: total + 4].replace("U", "T")[::-1]
    for i in range(n):
        pos += 1 if i == 0 else i % 3
        want.append((i, pos, text[pos : pos + 5]))
    assert got == want


def test_reads_with_a_wrong_k_give_status_rows(spark):
    reads = spark.createDataFrame([("a", "ACGUACG", "IIIIIII", [1, 1, 1]), ("b", "ACGUACG", "IIIIIII", [1, 1]), ("c", "ACG", "III", [1, 1, 1])], "read_id string, seq string, qual string, moves array<bigint>")
    events, wrong = sources.moves_to_events(reads)
    assert {r["read_id"] for r in events.select("read_id").distinct().collect()} == {"a", "c"}
    assert [tuple(r) for r in wrong.collect()] == [("b", 6, "irregular_moves")]
