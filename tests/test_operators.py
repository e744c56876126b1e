"""Core operators on small tables: ties, nulls, empty tables, brute force."""

import random

from pyspark.sql import functions as F

from edicta.operators import dedup, graph, matching


def test_keep_best(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "b", 1), (4, None, 1), (5, None, 1)], "id long, k string, s int")
    assert sorted(r.id for r in dedup.keep_best(df, ["k"], F.desc("s"), F.col("id")).collect()) == [1, 3, 4, 5]
    assert dedup.keep_best(df.limit(0), ["k"], F.desc("s")).count() == 0


def test_upsert_and_delta(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, k string, t int")
    new = spark.createDataFrame([(3, "b", 2), (4, "c", 2), (5, "c", 3), (6, None, 1)], "id long, k string, t int")
    assert sorted(r.id for r in dedup.upsert(old, new, ["k"], "t").collect()) == [1, 3, 5, 6]
    assert sorted(r.id for r in dedup.append_delta(old, new, ["k"], "id").collect()) == [4, 6]
    assert sorted(r.id for r in dedup.replace_partition(old, new, "k").collect()) == [1, 3, 4, 5, 6]
    assert [(r.k, r.rows) for r in dedup.violations(new, ["k"]).collect()] == [("c", 2)]


def test_exactly_one(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id long, k string")
    right = spark.createDataFrame([("a", 9), ("b", 8), ("b", 7)], "k string, v int")
    assert [(r.id, r.v, r.matched) for r in matching.exactly_one(left, right, "k", "v").orderBy("id").collect()] == [(1, 9, True), (2, None, False), (3, None, False), (4, None, False)]


def test_longest_contained(spark):
    texts = spark.createDataFrame([(1, "Ruidos en San Pedro de la Paz"), (2, "San Pedro"), (3, "sanpedro"), (4, None), (5, "")], "id long, t string")
    names = spark.createDataFrame([("San Pedro",), ("San Pedro de la Paz",), ("Paz",), ("",)], "n string")
    assert {(r.id, r.n) for r in matching.longest_contained(texts, "id", "t", names, "n").collect()} == {(1, "San Pedro de la Paz"), (2, "San Pedro")}


def test_best_similar_is_brute_force(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    typed = ["".join(rng.choice("abcde") for _ in range(rng.randint(0, 10))) for _ in range(60)]
    a, b = spark.createDataFrame([(x,) for x in typed], "t string"), spark.createDataFrame([(x,) for x in names], "n string")
    got = {r.t: (r.distance, r.n) for r in matching.best_similar(a, "t", b, "n", 2).collect()}
    pairs = a.distinct().crossJoin(b.distinct()).select("t", "n", F.levenshtein("t", "n").alias("d")).where("d <= 2").collect()
    want = {}
    for r in pairs:
        want[r.t] = min(want.get(r.t, (9, "")), (r.d, r.n))
    assert got == want


def test_sized_marks_small_sides_only(spark):
    assert "broadcast" in matching.sized(spark.range(5), 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in matching.sized(spark.range(50), 10)._jdf.queryExecution().logical().toString().lower()


def test_reachable(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert {(r.node, r.depth) for r in graph.reachable(seeds, edges, 5).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert graph.reachable(seeds, edges, 1).count() == 2
    assert graph.reachable(seeds, edges, 9, guard=2).count() == 2
    assert graph.reachable(seeds.limit(0), edges, 3).count() == 0
