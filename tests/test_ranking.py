"""Top n with ties and positions, on rows of which very many tie."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from collabstats.operators import ranking
from collabstats.operators.fractional import countries_of_cube, country_cube, new_repos_by_country_year
from collabstats.operators.ranking import numbered, top_with_ties
from tests.conftest import first_df, users_df


@pytest.mark.parametrize("scores", [[], [3.0], [1.0] * 20, [5.0, 4.0, 4.0, 4.0, 3.0, None], [None, None], list(range(30)), [9.0, 9.0, 8.0, 7.0, 7.0, 7.0, 1.0]])
@pytest.mark.parametrize("n", [1, 3, 10])
def test_top_with_ties_is_rank(spark, scores, n):
    rows = spark.createDataFrame([(i, None if s is None else float(s)) for i, s in enumerate(scores)], "i int, s double").repartition(4)
    held = [s for s in scores if s is not None]
    want = sorted(i for i, s in enumerate(scores) if s is not None and sum(x > s for x in held) < n)
    assert sorted(r.i for r in top_with_ties(rows, "s", n).collect()) == want


@pytest.mark.parametrize("size, limit", [(0, 4), (1, 4), (1000, 100), (1000, 10_000), (3000, 1), (5000, 700)])
def test_positions_are_those_of_a_sort(spark, size, limit, monkeypatch):
    monkeypatch.setattr(ranking, "PARTS", 16)
    rng = random.Random(size)
    rows = [(float(rng.randrange(4)), f"n{i:05d}", i) for i in range(size)]
    got = numbered(spark.createDataFrame(rows, "s double, k string, v int").repartition(5), [-F.col("s"), F.col("k")], "pos", limit).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted((r.pos, r.k, r.v) for r in got) == [(i + 1, r[1], r[2]) for i, r in enumerate(order)]


def test_a_million_ties_do_not_meet(spark):
    """10^6 countries of one score: all of them rank, and none of the tasks that number them has the bulk."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tied = spark.range(1_000_000).select(F.format_string("country %07d", "id").alias("country"), F.lit(0.5).alias("score"))
        top = top_with_ties(tied, "score", 10)
        placed = numbered(top, [-F.col("score"), F.col("country")], "pos").withColumn("task", F.spark_partition_id())
        wrong = F.format_string("country %07d", F.col("pos") - 1) != F.col("country")
        tasks = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(wrong, 1)).alias("wrong")).collect()
        assert sum(r.n for r in tasks) == 1_000_000 and not any(r.wrong for r in tasks)
        assert len(tasks) > 3 and max(r.n for r in tasks) < 500_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_cube_report_equals_the_direct_one(spark):
    """Ties across all buckets of the direct ranking: 300 countries with one branch each, a few with more."""
    people = users_df(spark, [(i, f"C{i:03d}" if i % 50 else "C000, C001", "", "") for i in range(1, 400)] + [(900, "", "", "")])
    first = first_df(spark, [(f"b{i}", i, 2009 + i % 15) for i in range(1, 400)] + [("b1", 900, 2009), ("x1", 5, 2010), ("x2", 7, 2011), ("y", 900, 2012), ("z", 5000, 2013)])
    path = tempfile.mkdtemp(prefix="collabstats-test-") + "/cube"
    country_cube(first, people, commits_distinct=True).write.parquet(path)
    for n in (1, 2, 3, 10, 1000):
        a = countries_of_cube(spark.read.parquet(path), top_n=n)
        b = new_repos_by_country_year(first, people, top_n=n, commits_distinct=True)
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), n
