"""Calls in flight, their pace, and the ledger that keeps answers."""

import json
import os
import threading
import time
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tessella.config import Settings
from tessella.operators import model
from tessella.operators.ledger import Ledger
from tessella.plans import pipeline as P
from tessella.plans.tasks import load_task

DEMO = load_task("demo_extraction")
FEVER = '{"fever_present": true, "fever_grade": "hoch", "fever_negated": false, "max_temperature_c": 39.2}'


@pytest.fixture
def slow_server():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            time.sleep(0.25)
            text = asked["prompt"]
            body = json.dumps({"response": FEVER.replace("39.2", text.rsplit("degrees ", 1)[1].split()[0])}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/"
    server.shutdown()


def asked(spark, n, parts=1):
    return spark.range(n).repartition(parts).select(F.col("id"), F.lit("demo").alias("variable"), F.concat(F.lit("fever of degrees "), F.col("id"), F.lit(" C")).alias("llm_text"))


def test_calls_in_flight_keep_the_order(spark, slow_server):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    took = {}
    try:
        for flight in (1, 8):
            settings = Settings(url=slow_server, calls_in_flight=flight)
            began = time.time()
            rows = model.call_rows(asked(spark, 24), {"demo": DEMO}, model.client_for(settings), settings).collect()
            took[flight] = time.time() - began
            assert [json.loads(r["fields"])["max_temperature_c"] for r in rows] == [float(r["id"]) for r in rows] and len(rows) == 24
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert took[1] > 6 and took[8] < took[1] / 3


def test_pace():
    now, waits = [0.0], []
    pace = model.Pace(2.0, 3, lambda: now[0], waits.append)
    for _ in range(5):
        pace.take()
    assert waits == [0.5, 1.0]  # three at once, then two a second
    now[0] = 10.0
    for _ in range(3):
        pace.take()
    assert waits == [0.5, 1.0]
    model.Pace(0).take()


@dataclass
class Counted:
    """Counts calls in a file; after ``dies`` of them the worker is killed; ``bad`` texts get no answer."""

    log: str
    dies: int = 0
    bad: str = "\0"

    def __repr__(self):
        return "Counted"

    def complete(self, system, user):
        if self.dies and os.path.exists(self.log) and len(open(self.log).readlines()) >= self.dies:
            os._exit(3)
        with open(self.log, "a") as file:
            file.write(user.rsplit("degrees ", 1)[-1].split()[0] + "\n")
        return "none" if self.bad in user else FEVER


def test_a_resumed_run_repeats_no_answered_call(spark, tmp_path):
    ledger, log = f"file://{tmp_path}/ledger", str(tmp_path / "log")
    call = lambda client, settings, ledger: model.call_rows(asked(spark, 20, 2), {"demo": DEMO}, client, settings, wait=False, ledger=ledger).collect()
    with pytest.raises(Exception):
        call(Counted(log, dies=11), Settings(), Ledger(ledger))
    first = open(log).read().split()
    assert 11 <= len(first) < 20
    rows = call(Counted(log), Settings(resume=True), Ledger(ledger))
    calls = open(log).read().split()
    assert len(rows) == 20 and len(calls) <= 20 + 2 and set(calls) == {str(k) for k in range(20)}  # a call that was in flight at the end has no answer
    assert {json.loads(r["fields"])["max_temperature_c"] for r in rows} == {39.2} and not any(r["failed"] for r in rows)
    call(Counted(log), Settings(resume=True, calls_in_flight=4), Ledger(ledger))
    assert open(log).read().split() == calls
    call(Counted(log), Settings(), Ledger(ledger))  # a run that does not resume asks anew
    assert len(open(log).read().split()) == len(calls) + 20


def test_a_repeated_task_repeats_no_answered_call(spark, tmp_path):
    log, ledger = str(tmp_path / "log"), Ledger(f"file://{tmp_path}/ledger")
    rows = lambda client: model.call_rows(asked(spark, 12), {"demo": DEMO}, client, Settings(), wait=False, ledger=ledger).collect()
    with pytest.raises(Exception):
        rows(Counted(log, dies=5))
    assert len(rows(Counted(log))) == 12  # the same run: as an attempt after the one that was killed
    assert sorted(open(log).read().split(), key=int) == [str(k) for k in range(12)]


def test_failed_calls_are_not_kept(spark, tmp_path):
    log, path = str(tmp_path / "log"), f"file://{tmp_path}/ledger"
    client = Counted(log, bad="degrees 3 ")
    for _ in range(2):
        found = model.call_rows(asked(spark, 5), {"demo": DEMO}, client, Settings(resume=True, max_retries=0), wait=False, ledger=Ledger(path)).collect()
        assert [r["id"] for r in found if r["failed"]] == [3]
    assert sorted(open(log).read().split()) == sorted(["0", "1", "2", "3", "4", "3"])
    known = Ledger(path).known(spark)
    assert known.count() == 4 and known.columns == ["key", "answer"]
    changed = Settings(resume=True, temperature=0.9)
    assert model.question(model.GenerateClient(changed), DEMO, changed) != model.question(model.GenerateClient(Settings()), DEMO, Settings())


def test_jobs_keep_a_ledger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"{k}.txt").write_text(f"high fever of degrees {k} C")
    log, out = str(tmp_path / "log"), f"file://{tmp_path}/out"
    run = lambda **kw: P.run_job(spark, str(tmp_path / "in"), out, client=Counted(log), settings=Settings(task="demo_extraction", **kw), wait=False)
    run()
    os.rename(tmp_path / "out" / "current.txt", tmp_path / "out" / "lost.txt")  # as if the run had ended before it published
    run(resume=True)
    assert len(open(log).read().split()) == 4
