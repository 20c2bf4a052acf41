from __future__ import annotations

import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from talkloom.functions import chat, verdicts
from talkloom.operators import evaluation, reports, responders, workflow


def request(transcript):
    return chat.envelope(chat.system_text(F.lit("p"), F.lit("w"), F.lit("")), chat.transcript_text(F.lit(transcript)), "m")


def test_label_and_validate(spark):
    log = spark.range(2).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.lit("t").alias("timestamp"), F.lit("m").alias("model"), F.lit("old").alias("response_text"),
        F.when(F.col("id") == 0, request("um hello")).otherwise(request("")).alias("raw_request_json"),
    )
    labelled = workflow.label(log, responders.Call(lambda p: f" {p} "), "{window_context}|{custom_vocabulary}|{clipboard_context}|{transcript}", "big")
    rows = labelled.collect()
    assert [(r["request_id"], r["label"], r["original_response"]) for r in rows] == [("r0", "w|(none provided)|(empty)|um hello", "old")]
    checked = workflow.validate(labelled, responders.Call(lambda p: "FAIL A: " + p), "{custom_vocabulary} {label}", "global").first()
    assert checked["validation"]["type"] == "A" and checked["validation"]["reason"].startswith("global w|")
    assert tuple(workflow.outcome(log, labelled, "request_id").first()) == (2, 1, 1)
    assert workflow.preview(workflow.label_prompts(log, "{transcript}"), chars=2).first()["prompt"] == "um"


def test_judge_maps_back_and_retries(spark):
    samples = spark.createDataFrame([(i, "t", "g", "v", "base", "cand") for i in range(6)], "sample_index int, raw_transcript string, gold_label string, custom_vocabulary string, baseline_output string, candidate_output string")

    def reply(prompt):
        a, b = prompt.split("|")
        return json.dumps({f"output_{k}": {"conciseness": 1 if x == "base" else 5} for k, x in (("a", a), ("b", b))})

    scores, failed = workflow.judge(samples, responders.Call(reply), "{output_a}|{output_b}")
    rows = scores.collect()
    assert len(rows) == 6 and all(r["baseline_scores"]["conciseness"] == 1 and r["candidate_scores"]["conciseness"] == 5 for r in rows)
    assert failed.count() == 0
    scores, failed = workflow.judge(samples, responders.Call(lambda p: "no"), "{output_a}")
    assert scores.count() == 0 and sorted((r["attempt"], r["raw_response"]) for r in failed.collect()) == [(k, "no") for k in (0, 1) for _ in range(6)]


@pytest.mark.parametrize(("kind", "calls"), [("good", 6), ("fails", 6), ("never", 12), ("once", 9)])
def test_judge_asks_only_open_rows_again(spark, tmp_path, kind, calls):
    samples = spark.createDataFrame([(i, "t", "g", "v", "base", f"c{i}") for i in range(6)], "sample_index int, raw_transcript string, gold_label string, custom_vocabulary string, baseline_output string, candidate_output string")
    log = tmp_path / "calls"

    def reply(prompt):
        with log.open("a") as f:
            f.write(prompt + "\n")
        if kind == "fails":
            raise ValueError("no connection")
        if kind == "never" or kind == "once" and int(prompt[1]) % 2 and log.read_text().split("\n").count(prompt) == 1:
            return "?"
        return json.dumps({"output_a": {"conciseness": 1}, "output_b": {"conciseness": 5}})

    named = samples.withColumn("raw_transcript", F.concat(F.lit("s"), F.col("sample_index").cast("string")))
    scores, failed = workflow.judge(named, responders.Call(reply), "{raw_transcript}", folder=str(tmp_path / "f"))
    assert (scores.count(), failed.count()) == {"good": (6, 0), "fails": (0, 0), "never": (0, 12), "once": (6, 3)}[kind]
    assert len(log.read_text().split()) == calls


def test_whole_summary(spark):
    rng = random.Random(1)
    rows = [(i, {"conciseness": float(rng.randint(1, 3))}, {"conciseness": float(rng.randint(2, 5))}) for i in range(60)]
    judged = spark.createDataFrame(rows, "id int, baseline_scores map<string,double>, candidate_scores map<string,double>")
    sides = [spark.createDataFrame([(float(x),) for x in xs], "duration_ms double") for xs in ([0, *range(100, 160)], range(50, 105))]
    row = evaluation.whole_summary(spark, judged, *sides, "id", n_draws=400).first()
    assert row["n_samples"] == 60 and row["winner"] in ("candidate", "tie") and row["gap_low"] <= row["candidate_avg_score"] - row["baseline_avg_score"] + 0.1 <= row["gap_high"] + 0.2
    assert row["overall_p_value"] < 0.001 and row["p_conciseness"] < 0.001 and row["p_grammar_fluency"] is None and row["latency_p_value"] < 0.001
    assert (row["baseline_latency_avg"], row["candidate_latency_avg"], row["speed_ratio"]) == (129.5, 77.0, round(129.5 / 77.0, 2))


def test_signed_rank_p(spark):
    """Exact for few differences of different sizes, by enumeration of all signs; else normal."""
    for n in (10, 12):
        diffs = [(-1.0 if i % 4 == 0 else 1.0) * (i + 1) for i in range(n)]
        row = evaluation.with_p(evaluation.wilcoxon(spark.createDataFrame([(d,) for d in diffs], "d double"))).first()
        least = min(sum(abs(d) for d in diffs if d > 0), sum(abs(d) for d in diffs if d < 0))
        sums = [sum(i + 1 for i in range(n) if bits >> i & 1) for bits in range(1 << n)]
        assert row["p"] == pytest.approx(min(1.0, 2 * sum(s <= least for s in sums) / 2**n))
    tied = [1.0, -2.0, 2.0, 3.0, -3.0, 3.0, 4.0, 5.0, 6.0, 7.0, -1.0]
    row = evaluation.with_p(evaluation.wilcoxon(spark.createDataFrame([(d,) for d in tied], "d double"))).first()
    ranks = {s: sum(i + 1 for i, x in enumerate(sorted(map(abs, tied))) if x == s) / [abs(x) for x in tied].count(s) for s in map(abs, tied)}
    w, n = min(sum(ranks[abs(d)] for d in tied if (d > 0) == up) for up in (True, False)), len(tied)
    spread = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - sum(t**3 - t for t in (2, 2, 3)) / 48)
    assert row["p"] == pytest.approx(math.erfc(abs(w - n * (n + 1) / 4) / spread / math.sqrt(2)))


def test_calls_time_out(spark):
    def slow(prompt):
        time.sleep(3 if prompt == "b" else 0)
        return prompt

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string")
    got = {r["prompt"]: (r["reply"], r["error"]) for r in responders.Call(slow, timeout=0.5).respond(rows, "prompt").collect()}
    assert got == {"a": ("a", None), "b": ("", "TimeoutError"), "c": ("c", None)}
    assert responders.chat_request("m", "s")("hi") == {"model": "m", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "hi"}], "temperature": 0.3, "stream": False}


def test_rounding_as_the_reports_do(value):
    for x in (2.675, 0.125, 0.375, 1.005, 2.885, 3.065, -0.5, 1e9 + 0.05):
        for n in (0, 1, 2):
            assert value(verdicts.rounded(F.lit(x), n)) == round(x, n)
    assert value(verdicts.rounded(F.lit(None).cast("double"), 1)) is None


def test_generate(spark):
    assigned = spark.createDataFrame([(1, "x")], "index long, topic string")
    row = workflow.generate(assigned, responders.Call(lambda p: f"<RAW_TRANSCRIPT>{p}</RAW_TRANSCRIPT><CLEAN_TRANSCRIPT>c</CLEAN_TRANSCRIPT>"), "about {topic}", "p", "v", "m").first()
    assert row["request_id"] == "syn-001" and "about x" in row["raw_request_json"] and row["label"] == "c"


def test_reports(spark):
    scores = F.create_map(F.lit("conciseness"), F.lit(5.0))
    judged = spark.range(3).select(F.create_map(F.lit("conciseness"), F.lit(1.0)).alias("baseline_scores"), scores.alias("candidate_scores"))
    sides = [spark.createDataFrame([(x,), (x,)], "duration_ms double") for x in (30.0, 15.0)]
    row = evaluation.whole_summary(spark, judged.withColumn("id", F.monotonically_increasing_id()), *sides, "id", n_draws=100)
    texts = [r["text"] for r in reports.evaluation_report(row, "small", "big").orderBy("line").collect()]
    assert len(texts) == 16 and texts[0] == "small against big, samples: 3" and texts[6].startswith("conciseness (weight 1): 1.00 -> 5.00 (+4.00), p n/a")
    assert texts[9] == "candidate wins: 100% of 3, 95% interval 44% to 100%, ties: 0" and texts[10] == "latency avg: 30 ms -> 15 ms, 2.0x"
    assert texts[14] == "latency, p n/a, speed ratio 2.00" and texts[15].startswith("decision: candidate; Candidate wins ")
    silent = evaluation.whole_summary(spark, judged.limit(0).withColumn("id", F.lit(1)), *(s.limit(0) for s in sides), "id", n_draws=100)
    texts = [r["text"] for r in reports.evaluation_report(silent, "small", "big").orderBy("line").collect()]
    assert texts[9] == "candidate wins: none decided, ties: 0" and texts[10] == "latency avg: not measured"
    lines = [r["text"] for r in reports.dimension_report(evaluation.dimension_means(judged)).orderBy("line").collect()]
    assert len(lines) == 6 and "n/a" in lines[0]
    stats = spark.createDataFrame([("baseline", 4.0, 4.0, 4.0, 4.0), ("candidate", 2.0, 2.0, 2.0, 0.0)], "side string, avg double, p50 double, p90 double, p99 double")
    found = {r["stat"]: r["text"] for r in reports.latency_report(stats).collect()}
    assert found["avg"].endswith("2.0x") and not found["p99"].endswith("x")
    rows = spark.createDataFrame([("a", "{}", None, None)], "request_id string, raw_request_json string, label string, validation struct<status:string,type:string,reason:string>")
    assert tuple(reports.inspection(rows).first()) == ("a", "(failed to extract)", "(no label)", "not validated")
