"""Rejected texts and column profiles."""

import time

from pyspark.sql import functions as F

from pontualis import schemas
from pontualis.operators import audits, scoring
from pontualis.sources.matched import load_matched_csv, read_matched_csv

GOOD = "006;006;2024-12-02 08:00:00;2024-12-02 08:01:00;2024-12-02 08:10:00;2024-12-02 08:12:00;10;11"


def test_rejected_texts_of_a_broken_csv(spark, tmp_path):
    header = ";".join(schemas.MATCHED.names)
    broken = ["006;006;yesterday;2024-12-02 08:01:00;;2024-12-02 08:12:00;ten;11",
              "007;007;2024-12-02 08:00:00;2024-13-02 08:01:00;\\N;\\N;10;99999999999999999999"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_text("\n".join([header, GOOD, *broken]) + "\n", encoding="utf-8")
    typed, rejects = load_matched_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert typed.schema.names == schemas.MATCHED.names and typed.count() == 3
    assert sorted(map(tuple, rejects.collect())) == [
        ("datetime_partida_VP", "yesterday"), ("datetime_partida_VR", "2024-13-02 08:01:00"),
        ("tempo_viagem_VP", "ten"), ("tempo_viagem_VR", "99999999999999999999")]
    plain = read_matched_csv(spark, str(tmp_path / "in"))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, typed.collect()))


def test_null_is_no_reject(spark):
    raw = spark.createDataFrame([(None,) * 8, ("a", "b", *(" ",) * 4, "", "5")],
                                ", ".join(f"{n} string" for n in schemas.MATCHED.names))
    counts = {(r.coluna, r.valor): r.linhas for r in scoring.reject_counts(scoring.cast_with_rejects(raw)).collect()}
    assert counts == {**{(c, " "): 1 for c in schemas.MATCHED.names if c.startswith("datetime")},
                      ("tempo_viagem_VP", ""): 1}


def test_profile_counts_and_sketches(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.concat((F.col("id") % 5000).cast("string"),
                                                                      F.lit(" "))).alias("t"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hot"),
        F.lit("").alias("empty"), (F.col("id") % 7).alias("n"), F.array("id").alias("list"),
        F.col("id").cast("double").alias("a`b.c"))
    rows = rows.withColumnRenamed("a`b.c", "a.b")
    parts = [audits.table_quality(rows.where(F.col("n") % 2 == k), "x") for k in (0, 1)]
    merged = audits.merged_quality(parts[0].unionByName(parts[1]))
    for quality in (audits.table_quality(rows, "x"), merged):
        got = {r.coluna: r for r in audits.estimated_quality(quality).collect()}
        assert set(got) == set(rows.columns) and all(r.linhas == n for r in got.values())
        assert got["t"].nulos == n // 10 and got["t"].brancos_no_fim == n - n // 10
        assert got["t"].nao_inteiros == 0  # blanks around an integer do not count
        assert got["empty"].vazios == n and got["hot"].nao_inteiros == n // 3 and got["n"].nao_inteiros == 0
        # Five standard deviations of the stated error.
        for column, distinct in (("t", 4500), ("hot", 20001), ("n", 7), ("list", n)):
            assert abs(got[column].distintos - distinct) <= max(1, 5 * 1.04 / 64 * distinct), column
        assert got["hot"].frequentes[0].item == "hot"
        assert abs(got["hot"].frequentes[0]["count"] - n // 3) <= n // audits.HITTERS


def test_profile_is_one_scan(spark, tmp_path):
    spark.range(9).select("id", F.col("id").cast("string").alias("s")).write.parquet(str(tmp_path / "t"))
    frame = audits.table_quality(spark.read.parquet(str(tmp_path / "t")), "x")
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_integers_are_told_by_the_cast_alone(spark):
    texts = [None, "", " ", "7", " 7 ", "\t7\n", "+7", "-7", "7-", "1-2", "2024-01-01", "05:00:00", "1.5", "7.", ".", "-",
             "+-7", "9223372036854775807", "9223372036854775808", "1e3", "x7", " 7", "٣", "0x1", "7 "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    told = rows.select(audits._no_integer(F.col("t")).alias("a"),
                       (F.col("t").isNotNull() & F.col("t").try_cast("bigint").isNull()).alias("b")).collect()
    assert [r.a for r in told] == [r.b for r in told] and {r.a for r in told} == {True, False}


def test_texts_that_cannot_be_integers_are_not_cast(spark):
    """Such casts took a second for 60,000 values."""
    rows = spark.range(0, 400_000, 1, 1).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("t"))
    audits.column_quality(rows.limit(10), ["t"]).collect()
    start = time.perf_counter()
    assert audits.column_quality(rows, ["t"]).first().nao_inteiros == 400_000
    assert time.perf_counter() - start < 3
