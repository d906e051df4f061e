"""Sketches kept for each file against exact counts."""

import pytest
from pyspark.sql import functions as F

from tessella.operators import evaluate as E
from tessella.operators import sketches as S
from tessella.queries import QUERIES


def ids(spark, a, z, zeros=False):
    number = F.col("id").cast("string")
    return spark.range(a, z).select(F.when(F.lit(zeros) & (F.col("id") % 3 == 0), F.lpad(number, 9, "0")).otherwise(number).alias("key"))


def test_small_sets_are_exact(spark):
    left, right = ids(spark, 0, 900), ids(spark, 500, 1500, zeros=True)
    exact = E.id_overlap(E.id_set(left, "key"), E.id_set(right, "key"))
    some = S.sketched_overlap(S.file_sketches(left, "key", F.lit("l")), S.file_sketches(right, "key", F.lit("r")))
    assert some.select(*exact.columns).first().asDict() == exact.first().asDict()
    none = S.file_sketches(left.filter("key = 'x'"), "key", F.lit("l"))
    assert S.sketched_overlap(none, none).first()["n_left"] == 0


def test_large_sets_are_within_the_bounds(spark):
    left, right = ids(spark, 0, 400_000), ids(spark, 250_000, 700_000)
    files = S.file_sketches(left, "key", F.lit("l"))
    got = S.sketched_overlap(files, S.file_sketches(right, "key", F.lit("r"))).first()
    off = 4 * 2 ** (-S.LG_K / 2) * 700_000  # four standard errors of the union
    for name, want in (("n_left", 400_000), ("n_right", 450_000), ("n_both", 150_000), ("n_left_only", 250_000), ("n_right_only", 300_000)):
        assert abs(got[name] - want) < off, name
    lengths = {r["quantile"]: (r["length"], r["n_distinct"]) for r in S.length_quantiles(files).collect()}
    exact = {q: r for q, r in zip((0.0, 0.25, 0.5, 0.75, 1.0), left.select(F.expr("percentile_disc(0) within group (order by length(key))"), *[F.expr(f"percentile_disc({q}) within group (order by length(key))") for q in (0.25, 0.5, 0.75)], F.max(F.length("key"))).first())}
    assert {q: n for q, (n, _) in lengths.items()} == exact and all(abs(d - 400_000) < 0.05 * 400_000 for _, d in lengths.values())


def test_old_files_are_not_read_again(spark, tmp_path):
    tables = {"a": ids(spark, 0, 100), "b": ids(spark, 50, 200), "c": ids(spark, 150, 300)}
    seen = []

    def read(path):
        seen.append(path)
        return tables[path]

    store = f"file://{tmp_path}/sketches"
    update = lambda paths: S.update_sketches(spark, store, paths, read, lambda df: df.columns[0])
    assert {r["file"] for r in update(["a", "b"]).collect()} == {"a", "b"} and seen == ["a", "b"]
    three = update(["a", "b", "c"])
    assert seen == ["a", "b", "c"] and three.count() == 3 and update(["b"]).count() == 1
    assert S.sketched_overlap(three, update(["a"])).first()["n_both"] == 100 and S.merged(three).first()["n"] == 400


@pytest.mark.parametrize("parts", [1, 4])
def test_merging_is_the_same_in_any_order(spark, parts):
    df = ids(spark, 0, 5000).withColumn("f", (F.crc32("key") % parts).cast("string"))
    got = S.merged(S.file_sketches(df, "key", F.col("f")).orderBy(F.rand(1))).select(F.theta_sketch_estimate("ids").alias("n")).first()["n"]
    assert got == 5000


def test_slots_count_large_sets_exactly(spark, tmp_path):
    left, right = ids(spark, 0, 200_000), ids(spark, 120_000, 330_000, zeros=True)
    slots = max(S.slots_for(left, "key"), S.slots_for(right, "key"))
    exact = E.id_overlap(E.id_set(left, "key"), E.id_set(right, "key"))
    sides = S.file_sketches(left, "key", F.lit("l"), slots), S.file_sketches(right, "key", F.concat(F.lit("r"), F.length("key")), slots)
    assert slots > 1 and S.sketched_overlap(*sides, slots).select(*exact.columns).first() == exact.first()
    with pytest.raises(Exception, match="more ids than are counted exactly"):
        S.sketched_overlap(S.file_sketches(left, "key", F.lit("l"), 2), sides[1], 2).collect()
    with pytest.raises(Exception, match="fewer than"):
        S.sketched_overlap(S.file_sketches(left, "key", F.lit("l")), sides[1], slots).collect()
    store, update = f"file://{tmp_path}/sketches", lambda n: S.update_sketches(spark, store, ["a"], lambda path: left, lambda df: "key", n)
    assert update(1).count() == 1 and update(slots).count() == slots and S.sketched_overlap(update(slots), sides[1], slots).select(*exact.columns).first() == exact.first()


def test_a_side_without_ids(spark):
    some, none = S.file_sketches(ids(spark, 0, 90), "key", F.lit("l")), S.file_sketches(ids(spark, 0, 0), "key", F.lit("r"))
    assert [S.sketched_overlap(*sides).first()[c] for sides in ((some, none), (none, some)) for c in ("n_left_only", "n_right_only")] == [90, 0, 0, 90]


def test_the_query_is_exact_beyond_one_sketch(spark, tmp_path):
    spark.range(80_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(100_000).select((F.col("id") % 90_000).alias("o_custkey"), F.expr("timestamp_seconds(id * 3000)").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    assert QUERIES["id_overlap_sketches"](spark, str(tmp_path)).first() == QUERIES["id_overlap"](spark, str(tmp_path)).first()
