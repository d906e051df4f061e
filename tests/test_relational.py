import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from tessella.operators import relational as R


def diag(spark, rows, cols):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], [R.ORDER, *cols])


def test_diagnosis_records_are_chronological(spark):
    df = diag(spark, [("P1", "late", "2026-02-01", "F1"), ("P1", "early", "2026-01-01", None), ("P2", "x", "bad date", "F2"), ("P1.0", "y", "01.01.2026", ""), ("", "gone", "", ""), ("P2", "nan", "", "")], ["PatientID", "Diagnose_Value", "Diagnose_Time", "FallNummer"])
    got = {r["patient_id"]: r for r in R.diagnosis_records(df).collect()}
    assert got["P1"]["report_text"] == "[Diagnoseliste]\n\n[#1 | time=2026-01-01]\nearly\n\n[#2 | time=2026-02-01 | FallNummer=F1]\nlate"
    assert got["P1"]["n_diagnosis_entries"] == 2 and got["P2"]["n_diagnosis_entries"] == 1 and [got[p]["source_row_id"] for p in ("P1", "P1.0", "P2")] == ["patient_0", "patient_1", "patient_2"]


def test_order_without_times_is_first_appearance(spark):
    df = diag(spark, [("B", "1"), ("A", "2"), ("B", "3")], ["patientid ", "Diagnose"])
    got = {r["patient_id"]: (r["source_row_id"], r["report_text"]) for r in R.diagnosis_records(df).collect()}
    assert got["B"] == ("patient_0", "[Diagnoseliste]\n\n[#1]\n1\n\n[#2]\n3") and got["A"][0] == "patient_1"


def test_find_column():
    assert R.find_column(["x", "PATIENTID "], R.PATIENT_ALIASES, "id") == "PATIENTID "
    with pytest.raises(ValueError, match="value"):
        R.find_column(["x"], R.VALUE_ALIASES, "value")
    with pytest.raises(R.SchemaValidationError, match="missing column"):
        R.require_columns(type("D", (), {"columns": ["a"]})(), ["b"], "here")


def test_latest_transfer(spark):
    df = diag(spark, [("P1", "2026-01-01", "old", "1"), ("P1", "2026-03-01", "new", ""), ("P1", None, "undated", "3"), ("P2", None, "a", "4"), ("P2", "", "b", "5")], ["patnr", "berdat", "Diag", "fallnr"])
    got = {r["patient_id"]: r for r in R.latest_transfer(df).collect()}
    assert got["P1"]["verlegung_text"] == "[Verlegungsbericht] berdat=2026-03-01\n\n[diag]\nnew" and got["P1"]["n_verlegung_rows"] == 3 and got["P1"]["verlegung_fallnr"] == ""
    assert got["P2"]["verlegung_text"].endswith("b")


def test_attach_and_text_sources(spark):
    left = spark.createDataFrame([("P1", "P1", "D1", "[Diagnoseliste] one", "k", "a.csv"), ("P2", "P2", "D2", "two", "k", "")], ["patient_id", "report_id", "report_text", "diagnoseliste_text", "input_kind", "source_files"])
    right = spark.createDataFrame([("P1", "[Verlegungsbericht] t", "d", "f", 2)], "patient_id string, verlegung_text string, verlegung_berdat string, verlegung_fallnr string, n_verlegung_rows int")
    out = {r["patient_id"]: r for r in R.attach_transfer(left, right, "b.csv").collect()}
    assert out["P1"]["source_files"] == "a.csv, b.csv" and out["P1"]["input_kind"] == "patient_diagnoseliste_verlegung" and out["P2"]["verlegung_text"] == "" and out["P2"]["source_files"] == ""
    df = R.attach_transfer(left, right, "b.csv")
    texts = df.orderBy("patient_id").select(*[R.text_for_source(df.columns, s).alias(s) for s in ("diagnoseliste", "verlegung", "both", "report")]).collect()
    assert tuple(texts[0]) == ("[Diagnoseliste] one", "[Verlegungsbericht] t", "[Diagnoseliste] one\n\n[Verlegungsbericht] t", "D1")
    assert tuple(texts[1]) == ("two", "", "two", "D2")
    old = spark.createDataFrame([("[Verlegungsbericht] v",), ("plain",)], ["report_text"])
    assert [tuple(r) for r in old.select(*[R.text_for_source(old.columns, s) for s in ("diagnoseliste", "verlegung", "both")]).collect()] == [("[Verlegungsbericht] v",) * 3, ("plain", "", "plain")]
    assert R.attach_transfer(left, None) is left


def test_row_order_is_dense(spark):
    df = spark.createDataFrame([(x,) for x in (5, 3, 9, 1, 7)], ["x"])
    assert sorted(map(tuple, R.with_row_order(df, "x").collect())) == [(1, 0), (3, 1), (5, 2), (7, 3), (9, 4)]
    assert sorted(r["source_row_id"] for r in R.assign_row_ids(df, "x").collect()) == [f"row_{k}" for k in range(5)]
    assert R.with_row_order(df.filter("x > 99"), "x").collect() == []


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_row_order_is_exact_over_a_million_wide_rows(spark, adaptive, tmp_path):
    n, path = 1_000_000, f"file://{tmp_path}/rows"
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.range(n).select((F.xxhash64("id") % 400_000).alias("x"), "id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("text")).write.parquet(path)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        rows = R.with_row_order(spark.read.parquet(path), "x", "id")
        got = rows.agg(F.count(R.ORDER), F.count_distinct(R.ORDER), F.min(R.ORDER), F.max(R.ORDER)).first()
        assert tuple(got) == (n, n, 0, n - 1)
        after = F.lead(F.struct("x", "id")).over(Window.partitionBy(F.floor(F.col(R.ORDER) / 1000)).orderBy(R.ORDER))
        assert rows.withColumn("after", after).filter(F.struct("x", "id") > F.col("after")).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_row_order_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("b", 1, 2, 3.0), ("a", 4, 5, 6.0)], "x string, _part int, _place int, `_start` double")
    assert sorted(map(tuple, R.with_row_order(df, "x").collect())) == [("a", 4, 5, 6.0, 0), ("b", 1, 2, 3.0, 1)]


def test_filters_and_ids(spark):
    df = spark.createDataFrame([(1, " a "), (2, None), (3, "b"), (4, "nan")], "i int, report_type string")
    assert [r["i"] for r in R.exclude_types(df, ["a", " "]).orderBy("i").collect()] == [2, 3, 4]
    told = Observation("types")
    R.exclude_types(df, ["a", "b"], told=told).collect()
    assert told.get == {"excluded": 2}
    assert R.exclude_types(df, [], "report_type") is df and R.exclude_types(df, ["a"], "other") is df
    assert R.normalize_id_column(df, "nope") is df


def result(spark, rows):
    return spark.createDataFrame(rows, f"source_row_id string, report_id string, status string, v string, {R.ORDER} long")


def test_resume_retry_upsert(spark):
    old = result(spark, [("r0", "A", "extracted", "1", 0), ("r1", "B", "Failed", "2", 1), (None, "C", "partial", "3", 2)])
    new = result(spark, [("r0", "A", "", "", 0), ("r1", "B", "", "", 1), ("", "C", "", "", 2), ("r9", "B", "", "", 3), ("r5", "D", "", "", 4)])
    assert sorted(r["source_row_id"] for r in R.unprocessed(new, R.keep_done(old)).collect()) == ["r1", "r5", "r9"]
    assert sorted(r[R.ORDER] for r in R.to_retry(new, old).collect()) == [1, 2, 3]
    updates = result(spark, [("r1", "B", "extracted", "x", 0), ("r1", "B", "extracted", "y", 1), ("r7", "Z", "extracted", "z", 2)])
    merged = R.upsert(old, updates).orderBy(R.ORDER).collect()
    assert [(r["report_id"], r["v"]) for r in merged] == [("A", "1"), ("B", "y"), ("C", "3"), ("Z", "z")]
    assert {r["status"]: r["n"] for r in R.count_statuses(old).collect()} == {"extracted": 1, "Failed": 1, "partial": 1}
    kinds = [r[0]["kind"] for r in old.select(R.resume_key(old)).collect()]
    assert kinds == ["source_row_id", "source_row_id", "report_id"]


def test_sample_is_stable(spark):
    df = spark.range(1000)
    a, b = (R.seeded_sample(df.repartition(n), 10, 3, "id").collect() for n in (1, 7))
    assert a == b and len(a) == 10 and R.seeded_sample(df, 10, 4, "id").collect() != a and R.seeded_sample(df.limit(3), 10, 4, "id").count() == 3


def test_union_keeps_missing_columns(spark):
    one = spark.createDataFrame([(1,)], "id int")
    got = R.union_all([one, one.withColumn("x", F.lit("y"))])
    assert sorted(r["x"] or "" for r in got.collect()) == ["", "y"]


def hot(spark, n=4000, keys=40):
    """Rows of which one key holds half."""
    key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % keys))
    return spark.range(n).select(key.alias("key"), (F.xxhash64("id") % 10_000).alias("at"), F.col("id"), F.concat(F.lit("e"), F.col("id")).alias("entry"))


@pytest.mark.parametrize("entries", [7, 1000])
def test_a_key_with_half_of_the_rows_is_joined_in_two_steps(spark, monkeypatch, entries):
    monkeypatch.setattr(R, "ENTRIES", entries)
    df = hot(spark)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r["at"], r["id"])):
        want.setdefault(r["key"], []).append(r["entry"])
    got = R.ordered_concat(df, "key", "entry", [F.col("at"), F.col("id")], ", ")
    assert {r["key"]: (r["text"], r["n"]) for r in got.collect()} == {k: (", ".join(v), len(v)) for k, v in want.items()}


def test_a_hot_key_lies_in_many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = R.numbered_within(hot(spark, 40_000), ["key"], ["at", "id"])
        sizes = sorted(r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        blocks = rows.groupBy("key", F.floor((F.col("_rn") - 1) / R.ENTRIES).alias("b")).count().repartition("key", "b")
        assert max(r["count"] for r in blocks.collect()) <= R.ENTRIES
        first = R.with_row_order(hot(spark, 40_000), "key", "at", "id")
        first = sorted(r["n"] for r in first.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert first[-1] <= 2 * first[len(first) // 2] and sum(sizes) == 40_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("intervals", [5, 100_000])
def test_intervals_of_a_hot_key_equal_a_plain_union(spark, monkeypatch, intervals):
    from tessella.operators.evidence import merge_intervals, merge_spans

    monkeypatch.setattr(R, "INTERVALS", intervals)
    df = hot(spark, 1500).select("key", F.col("at").alias("start"), (F.col("at") + F.col("id") % 23).alias("end")).unionByName(spark.createDataFrame([(None, 1, 5), (None, 5, 6), (None, 9, 9)], "key string, start long, end long"))
    want = {}
    for r in df.collect():
        want.setdefault(r["key"], []).append((r["start"], r["end"]))
    got = sorted(((r["key"], r["start"], r["end"]) for r in merge_intervals(df, ["key"]).collect()), key=repr)
    assert got == sorted(((k, a, b) for k, v in want.items() for a, b in merge_spans(v)), key=repr)
