import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessella.config import Settings, env_bool, env_int, parse_max_reports
from tessella.functions.text import clean_text
from tessella.operators import model
from tessella.operators.model import ScriptedClient
from tessella.plans import pipeline as P
from tessella.plans import prompts
from tessella.plans.tasks import REGISTRY, EvidenceGroup, ExtractionTask, SchemaField, available_tasks, load_task
from tessella.sources.sinks import current_version

DEMO, CARDIO = load_task("demo_extraction"), load_task("cardiology_smoke")
FEVER = '{"fever_present": true, "fever_grade": "hoch", "fever_negated": false, "max_temperature_c": 39.2}'


def reports(spark, rows):
    return spark.createDataFrame(rows, "report_id string, report_text string").withColumn("source_row_id", F.concat(F.lit("row_"), F.col("report_id")))


def run(spark, rows, client, task=DEMO, **kw):
    flat, nested = P.run_task(reports(spark, rows), task, client, wait=False, **kw)
    assert flat.columns == P.fieldnames(task)
    return {r["report_id"]: r for r in flat.collect()}, {r["report_id"]: r for r in nested.collect()}


def test_positive_negated_and_skipped(spark):
    rows = [("a", "[Assessment]\nhigh fever 39.2 C, chills."), ("b", "Afebrile. No fever."), ("c", "")]
    flat, nested = run(spark, rows, ScriptedClient(default=FEVER))
    a, b, c = flat["a"], flat["b"], flat["c"]
    assert (a["status"], a["llm_called"], a["fever_present"], a["fever_grade"], a["max_temperature_c"], a["fever_grade__hoch"]) == ("extracted", "True", True, "hoch", 39.2, 1)
    assert (b["status"], b["llm_called"], b["has_negation"], b["has_positive_evidence"], b["fever_negated"]) == ("skipped_no_evidence", "False", "True", "False", False)
    assert (c["status"], c["fever_grade"], c["keyword_hits_count"]) == ("skipped_no_evidence", "keine", 0)
    assert json.loads(a["evidence_snippets"])[0]["section"] == "assessment" and a["stage_path"].startswith("preprocessing -> rule_evidence")
    assert [s["stage"] for s in nested["a"]["audit"]["stages"]] == ["preprocessing", "rule_evidence", "llm_extraction", "schema_validation", "guardrails"]


def test_retries(spark):
    sleeps = []
    task, ok = DEMO, ScriptedClient({"[HINWEIS": ""}, FEVER)
    client = ScriptedClient({"Fieber": ["nonsense", FEVER]})
    got = model.extract(client, task, "fever", sleep=sleeps.append)
    assert got["attempts"] == 2 and not got["failed"] and sleeps == [2.0]
    got = model.extract(ScriptedClient(default=""), task, "fever", Settings(max_retries=2), sleeps.append)
    assert got["failed"] and got["attempts"] == 3 and got["schema_errors"][0].startswith("llm_extraction_failed: ") and sleeps == [2.0, 2.0, 4.0]
    assert model.pause(9) == 6.0 and ok.complete("", "") == FEVER


def test_failed_row_keeps_defaults_and_says_so(spark):
    flat, nested = run(spark, [("a", "fever")], ScriptedClient(default="no"))
    assert flat["a"]["status"] == "failed" and flat["a"]["fever_grade"] == "keine" and "llm_extraction_failed" in flat["a"]["schema_errors"]
    assert [s["detail"]["ok"] for s in nested["a"]["audit"]["stages"] if s["stage"] == "schema_validation"] == ["false"]


def patient(spark):
    return spark.createDataFrame(
        [("P1", "P1", "[Diagnoseliste]\n\n[#1]\nVorhofflimmern postoperativ. Leberzirrhose.", "[Diagnoseliste]\n\n[#1]\nVorhofflimmern postoperativ. Leberzirrhose.", "[Verlegungsbericht]\n\n[diag]\nRe-Thorakotomie bei Nachblutung.", "patient_0")],
        "report_id string, patient_id string, report_text string, diagnoseliste_text string, verlegung_text string, source_row_id string",
    )


def answer(name, value, **more):
    return json.dumps({name: value, "information_sufficient": True, "reasoning": f"because {name}", "evidence_quotes": [f"q {name}", "shared"]} | more)


def test_nine_variables_merge_into_one_row(spark):
    answers = {f'"{v.name}"': answer(v.name, "Yes" if v.fields[0].type == "enum" else "ctx") for v in CARDIO.variables}
    answers['"cerebrovascular_event"'] = "broken"
    flat, nested = P.run_task(patient(spark), CARDIO, ScriptedClient(answers), wait=False)
    row, record = flat.first(), nested.first()
    assert row["status"] == "partial" and row["postop_atrial_fibrillation"] == "Ja" and row["cerebrovascular_event"] == "Keine" and row["reoperation_context"] == "ctx"
    assert row["information_sufficient"] is False  # one variable failed
    assert row["reasoning"].count("### ") == 8 and json.loads(row["evidence_quotes"]).count("shared") == 1
    assert row["schema_errors"].startswith("cerebrovascular_event: llm_extraction_failed") and row["liver_cirrhosis__Ja"] == 1
    modes = {s["variable"]: s["detail"]["input_mode"] for s in record["audit"]["stages"] if s["stage"] == "llm_extraction"}
    assert modes["rethoracotomy"] == "evidence_snippets" and modes["new_permanent_pacemaker"] == "full_text_fallback" and len(modes) == 9
    assert record["audit"]["used_full_text_fallback"] and record["audit"]["per_variable_llm"]


def test_variables_fall_back_to_the_report(spark):
    df = reports(spark, [("x", "Schrittmacher implantiert.")])
    rows = P.variable_rows(df, CARDIO, Settings()).filter("variable = 'new_permanent_pacemaker'").first()
    assert rows["text"] == "Schrittmacher implantiert." and rows["input_mode"] == "evidence_snippets"


def test_duplicate_reports_stay_apart(spark):
    flat, _ = P.run_task(reports(spark, [("a", "fever"), ("a", "fever")]), DEMO, ScriptedClient(default=FEVER), wait=False)
    assert flat.count() == 2 and {r["keyword_hits_count"] for r in flat.collect()} == {1}


def test_job_with_resume_and_retry(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a", "high fever"), ("b", "fever"), ("c", "nothing")):
        (tmp_path / "in" / f"{name}.txt").write_text(text)
    out, settings = f"file://{tmp_path}/out", Settings(task="demo_extraction")
    first = P.run_job(spark, str(tmp_path / "in"), out, client=ScriptedClient({"high fever": "bad"}, FEVER), settings=settings, wait=False)
    table = lambda: {r["report_id"]: r["status"] for r in spark.read.parquet(f"{current_version(spark, out)}/rows").collect()}
    failure, = spark.read.json(f"{first.rpartition('/')[0]}/failures").collect()  # what was asked and answered can be looked into
    assert failure["record_id"] == "a" and failure["name"].endswith("_extraction_a_a") and failure["system_prompt"] and "high fever" in failure["user_prompt"] and failure["raw_output"] == "bad" and failure["error_message"]
    assert table() == {"a": "failed", "b": "extracted", "c": "skipped_no_evidence"} and spark.read.option("header", True).csv(first).count() == 3
    P.run_job(spark, str(tmp_path / "in"), out, retry_failed=True, client=ScriptedClient(default=FEVER), settings=settings, wait=False)
    assert table()["a"] == "extracted" and len(table()) == 3
    (tmp_path / "in" / "d.txt").write_text("fever")
    P.run_job(spark, str(tmp_path / "in"), out, client=ScriptedClient(default="bad"), settings=Settings(resume=True), wait=False)
    assert Counter(table().values()) == {"extracted": 2, "skipped_no_evidence": 1, "failed": 1}
    assert P.run_job(spark, str(tmp_path / "in"), f"{out}2", max_reports=1, client=ScriptedClient(default=FEVER), settings=settings, wait=False)


def test_registry_and_fields():
    assert {"demo_extraction", "cardiology_smoke"} <= set(available_tasks())
    with pytest.raises(KeyError):
        load_task("nope")
    REGISTRY["bad"] = "tessella.config"
    try:
        with pytest.raises(TypeError):
            load_task("bad")
    finally:
        del REGISTRY["bad"]
    with pytest.raises(ValueError):
        SchemaField("x", "date")
    with pytest.raises(ValueError):
        SchemaField("x", "enum")
    with pytest.raises(ValueError):
        EvidenceGroup("g", (), "odd")
    assert DEMO.field_by_name("fever_grade").enum[0] == "keine" and DEMO.field_by_name("x") is None and DEMO.schema_dict()["fields"][1]["enum"] == ["keine", "niedrig", "hoch"]
    assert DEMO.schema()["max_temperature_c"].dataType.typeName() == "double" and len(set(P.fieldnames(CARDIO))) == len(P.fieldnames(CARDIO))


def test_prompts():
    german, english = prompts.build_system_prompt(DEMO), prompts.build_system_prompt(ExtractionTask(name="e", fields=(SchemaField("a", required=True),)))
    assert "eines von: keine, niedrig, hoch" in german and "required" in english
    assert prompts.retry_suffix(DEMO, 0) == "" != prompts.retry_suffix(DEMO, 1)
    with pytest.raises(FileNotFoundError):
        prompts.load_prompt("nope")


def test_clients(monkeypatch):
    assert model.chat_url("http://h/") == "http://h/api/chat" == model.chat_url("http://h/api/generate") == model.chat_url("http://h/api") == model.chat_url("http://h/api/chat")
    sent = []
    monkeypatch.setattr(model, "_post", lambda url, payload, timeout: sent.append((url, payload)) or {"response": ["x", '{"a": 1} y'], "message": {"content": " hi "}})
    assert model.GenerateClient(Settings(url="u")).complete("s", " p ") == '{"a": 1}' and sent[-1][1]["prompt"] == "p"
    assert model.ChatClient(Settings(url="http://h")).complete("s", "p") == "hi" and sent[-1][0] == "http://h/api/chat"
    assert model.split_messages([{"role": "System", "content": "a"}, {"role": "user", "content": 1}, "odd", {"role": "x"}]) == ("a", "1")
    assert isinstance(model.client_for(Settings(provider="offline")), model.OfflineClient)
    with pytest.raises(ValueError):
        model.client_for(Settings(provider="odd"))

    class Broken:
        def complete(self, system, user):
            raise OSError("down")

    assert model.call_model(Broken(), []) == ""


def test_settings():
    assert Settings.from_env({}) == Settings() and Settings.from_env({"LLM_PROVIDER": "http_chat"}).timeout == 120
    s = Settings.from_env({"EVIDENCE_MAX_SNIPPET_CHARS": "5", "EVIDENCE_WINDOW_SENTENCES": "0", "MAX_REPORTS": "7", "PIPELINE_RESUME": "auto", "EVIDENCE_MAX_SNIPPETS": "x"})
    assert (s.max_snippet_chars, s.window_sentences, s.max_reports, s.resume, s.max_snippets) == (80, 0, 7, True, 12)
    assert parse_max_reports("all") is None and parse_max_reports(" 3 ") == 3 and env_int({}, "x", 4, 1) == 4 and env_bool({"x": "yes"}, "x")
    for bad in ("0", "-1", "x"):
        with pytest.raises(ValueError):
            parse_max_reports(bad)


def test_stream(spark, tmp_path, sf):
    from tessella.streaming.incremental import current_rows, latest_in_window, stream_evidence, upsert_sink

    events = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").alias("report_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type", F.concat(F.lit("high fever "), F.col("event_type")).alias("report_text")).limit(200)
    events.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = latest_in_window(stream().drop("report_text"), "report_id", "ts").writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from latest").first()[0] == 200
    out = stream_evidence(stream(), DEMO).select(F.col("report_id").cast("string"), "evidence.has_positive_evidence")
    q = out.writeStream.foreachBatch(upsert_sink(spark, f"file://{tmp_path}/out")).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    held = current_rows(spark, f"file://{tmp_path}/out")
    assert held.count() == events.select("report_id").distinct().count() and held.filter("has_positive_evidence").count() > 0
    assert clean_text is not None


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    from tessella.sources.sinks import current_version
    from tessella.streaming.incremental import _buckets, current_rows, upsert_sink

    out = f"file://{tmp_path}/out"
    assert current_rows(spark, out) is None
    sink = upsert_sink(spark, out, buckets=8)
    rows = lambda pairs: spark.createDataFrame(pairs, "report_id string, v int")
    sink(rows([(f"r{k}", k) for k in range(40)]), 0)
    first = _buckets(spark, current_version(spark, out))
    sink(rows([("r7", 100), ("r7", 101)]), 1)
    sink(rows([]), 2)
    second = _buckets(spark, current_version(spark, out))
    assert len(first) == 8 == len(second) and sum(first[b] != second[b] for b in first) == 1
    assert {r["report_id"]: r["v"] for r in current_rows(spark, out).collect()} == {f"r{k}": k for k in range(40)} | {"r7": 101}
