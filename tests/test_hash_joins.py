"""Hash parity with the SQL oracle, and the size-checked join's two paths."""

import duckdb
from pyspark.sql import functions as F

from hearth.functions.hashing import bucket32, sql_bucket32
from hearth.operators.joins import bounded, join_small


def test_md5_bucket_matches_duckdb(spark):
    rows = [(i, i * 7 + 3, f"k{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "a BIGINT, b INT, c STRING")
    got = {(r.a, r.b, r.c): r.h for r in df.select("a", "b", "c", bucket32(["a", "b", "c"], 42).alias("h")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a BIGINT, b INTEGER, c VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    want = {(a, b, c): h for a, b, c, h in con.execute(f"SELECT a, b, c, {sql_bucket32(['a', 'b', 'c'], 42)} FROM t").fetchall()}
    assert got == want


def test_join_small_both_paths_agree(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    a = sorted(join_small(big, small, "k").select("id", "v").collect())
    b = sorted(join_small(big, small, "k", max_rows=0).select("id", "v").collect())   # over the bound: shuffle join
    assert a == b and len(a) == 1000
    plan = join_small(big, small, "k", max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan or "AdaptiveSparkPlan" in plan
    assert "ResolvedHint" not in bounded(small, 0)._jdf.queryExecution().analyzed().toString()


def test_written_tables_are_dropped(spark):
    from hearth.operators.joins import _TABLES, cut_lineage, drop_tables
    cut_lineage(spark.range(3))
    path = _TABLES[-1]
    assert spark.read.parquet(path).count() == 3
    kept = _TABLES[:-1]
    _TABLES[:] = [path]
    drop_tables(spark)
    _TABLES[:] = kept
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop)
