"""Callers: a local chat server, a program, calls that are made once, steps that go on where they stopped."""

from __future__ import annotations

import collections
import json
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from talkloom import schemas
from talkloom.operators import responders, workflow
from talkloom.sources import sinks
from talkloom.sources.keyed_table import KeyedTable


class Server:
    """Answers chat completions, counts them by prompt, and sees how many are open at once."""

    def __init__(self):
        self.calls, self.open, self.most, self.bodies = collections.Counter(), 0, 0, []
        self.fail_first: set[str] = set()
        lock, server = threading.Lock(), self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                prompt = body["messages"][1]["content"]
                with lock:
                    server.calls[prompt] += 1
                    server.bodies.append(body)
                    server.open += 1
                    server.most = max(server.most, server.open)
                threading.Event().wait(0.05)
                with lock:
                    server.open -= 1
                refused = prompt in server.fail_first and server.calls[prompt] == 1
                reply = json.dumps({"choices": [{"message": {"content": prompt.upper()}}]}).encode()
                self.send_response(503 if refused else 200)
                self.end_headers()
                self.wfile.write(b"" if refused else reply)

            def log_message(self, *args):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.http.server_port}/v1/chat/completions"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()


@pytest.fixture
def server():
    s = Server()
    yield s
    s.http.shutdown()


def test_chat_completion(server):
    call = responders.ChatCompletion(server.url, "m", "be brief", 0.1)
    assert call("hé") == "HÉ"
    assert server.bodies == [{"model": "m", "messages": [{"role": "system", "content": "be brief"}, {"role": "user", "content": "hé"}], "temperature": 0.1, "stream": False}]
    with pytest.raises(OSError):
        responders.ChatCompletion("http://127.0.0.1:9/none", "m", "s", timeout=1)("x")


def test_command_line(monkeypatch):
    monkeypatch.setenv("SECRET", "s")
    code = "import os, sys; t = sys.stdin.read(); print(t.upper(), os.environ.get('SECRET')); sys.exit(3 if t == 'bad' else 0)"
    call = responders.CommandLine([sys.executable, "-c", code], without=("SECRET",))
    assert call("good") == "GOOD None"
    with pytest.raises(RuntimeError, match="exit status 3"):
        call("bad")
    with pytest.raises(Exception, match="timed out"):
        responders.CommandLine([sys.executable, "-c", "import time; time.sleep(9)"], timeout=0.5)("x")


def test_each_prompt_is_called_once_though_tasks_fail(spark, server, tmp_path):
    """A task dies in the midst of its calls; the next run of the job finds what was answered."""
    rows = spark.createDataFrame([(i, f"p{i % 25}") for i in range(40)], "i int, prompt string")
    dead = tmp_path / "dead"
    inner = responders.ChatCompletion(server.url, "m", "s")

    def dying(prompt):
        import os
        import time

        if prompt in ("p7", "p19") and not dead.exists():
            time.sleep(0.5)  # the others go on calling
            dead.mkdir(exist_ok=True)
            os._exit(1)
        return inner(prompt)

    once = responders.CallOnce(dying, "m", str(tmp_path / "log"), tasks=2, at_once=3, wait=0.01)
    with pytest.raises(Exception, match="(?i)abort|exit|crash"):
        once.respond(rows, "prompt").collect()
    before = dict(server.calls)
    assert before
    got = once.respond(rows, "prompt").collect()
    assert sorted((r["i"], r["reply"]) for r in got) == [(i, f"P{i % 25}") for i in range(40)]
    assert all(r["error"] is None and r["duration_ms"] > 0 for r in got)
    # calls that were open when the worker died may have reached the server; no reply that was logged is asked for again
    again = [p for p, n in server.calls.items() if n > 1]
    assert set(server.calls) == {f"p{i}" for i in range(25)} and len(again) <= 4
    assert server.most <= 6
    total = sum(server.calls.values())
    assert once.respond(rows, "prompt").count() == 40 and sum(server.calls.values()) == total
    assert not (tmp_path / "log" / "calls").exists()


def test_calls_that_fail_are_tried_again_then_reported(spark, server, tmp_path):
    server.fail_first = {"p1"}
    rows = spark.createDataFrame([("p1",), ("p2",), (None,)], "prompt string")
    call = responders.ChatCompletion(server.url, "m", "s")
    got = {r["prompt"]: (r["reply"], r["error"]) for r in responders.CallOnce(call, "m", str(tmp_path / "a"), wait=0.01).respond(rows.where("prompt is not null"), "prompt").collect()}
    assert got == {"p1": ("P1", None), "p2": ("P2", None)} and server.calls == {"p1": 2, "p2": 1}
    server.calls.clear()
    one = responders.CallOnce(call, "m", str(tmp_path / "b"), tries=1)
    got = {r["prompt"]: (r["reply"], bool(r["error"])) for r in one.respond(rows.where("prompt is not null"), "prompt").collect()}
    assert got == {"p1": ("", True), "p2": ("P2", False)}
    got = {r["prompt"]: (r["reply"], bool(r["error"])) for r in one.respond(rows.where("prompt is not null"), "prompt").collect()}
    assert got == {"p1": ("P1", False), "p2": ("P2", False)} and server.calls == {"p1": 2, "p2": 1}


def log(spark, n):
    from talkloom.functions import chat

    system, asked = chat.system_text(F.lit("p"), F.lit("w"), F.lit("")), F.concat(F.lit("say "), F.col("id").cast("string"))
    return spark.range(n).select(
        F.format_string("r%02d", "id").alias("request_id"), F.lit("t").alias("timestamp"), F.lit("m").alias("model"), F.lit("old").alias("response_text"),
        chat.envelope(system, chat.transcript_text(asked), "m").alias("raw_request_json"), F.col("id").alias("pos"),
    )


def test_a_step_goes_on_where_it_stopped(spark, server, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), f"{schemas.LABELED}, pos long", buckets=4)
    call = responders.ChatCompletion(server.url, "m", "s")
    stop = tmp_path / "stop"
    stop.mkdir()

    def stopping(prompt):
        if prompt == "say 7" and stop.exists():
            import os

            os._exit(1)
        return call(prompt)

    once = responders.CallOnce(stopping, "big", str(tmp_path / "log"), tasks=1, at_once=1, wait=0.01)
    with pytest.raises(Exception, match="(?i)abort|exit|crash"):
        workflow.label_into(table, log(spark, 12), once, "{transcript}", "big", rows_at_once=5)
    assert sorted(r["request_id"] for r in table.read().collect()) == [f"r{i:02d}" for i in range(5)]
    stop.rmdir()
    assert workflow.label_into(table, log(spark, 12), once, "{transcript}", "big", rows_at_once=5) == {"given": 7, "done": 7, "errors": 0, "total": 12}
    assert {r["request_id"]: (r["label"], r["pos"]) for r in table.read().collect()} == {f"r{i:02d}": (f"SAY {i}", i) for i in range(12)}
    assert server.calls == {f"say {i}": 1 for i in range(12)}
    assert workflow.label_into(table, log(spark, 12), once, "{transcript}", "big") == {"given": 0, "done": 0, "errors": 0, "total": 12}
    # verdicts are set on the rows, which keep their labels
    review = responders.Call(lambda p: "PASS" if p.endswith("1") else "FAIL A: b" if p.endswith("2") else "")
    counts = workflow.validate_into(table, review, "{label}", "v", rows_at_once=4)
    assert counts == {"given": 12, "done": 12, "errors": 0, "total": 12}
    found = {r["request_id"]: (r["label"], r["validation"]["status"], r["pos"]) for r in table.read().collect()}
    assert found["r01"] == ("SAY 1", "pass", 1) and found["r02"] == ("SAY 2", "fail", 2)


def test_generation_makes_what_is_lacking(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), f"{schemas.LABELED}, pos long", buckets=2)
    reply = responders.Call(lambda p: "" if p == "about 3" else f"<RAW_TRANSCRIPT>{p}</RAW_TRANSCRIPT><CLEAN_TRANSCRIPT>c</CLEAN_TRANSCRIPT>")
    assigned = spark.range(1, 6).select(F.col("id").alias("index"), F.col("id").alias("topic"))
    made = lambda rows: workflow.generate_into(table, rows, reply, "about {topic}", "p", "v", "m")
    assert made(assigned.where("index < 4")) == {"given": 3, "done": 2, "errors": 1, "total": 2}
    assert made(assigned) == {"given": 3, "done": 2, "errors": 1, "total": 4}
    assert sorted((r["request_id"], r["label"]) for r in table.read().collect()) == [(f"syn-00{i}", "c") for i in (1, 2, 4, 5)]


def test_backup_copies_the_current_file(spark, tmp_path):
    for name in ("m.gguf", "m.v4.gguf", "m-BF16.gguf"):
        (tmp_path / name).write_text(name)
    assert sinks.backup(spark, str(tmp_path), "m") == "m.v5.gguf" and (tmp_path / "m.v5.gguf").read_text() == "m.gguf"
    assert sinks.backup(spark, str(tmp_path), "n") is None
