from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from talkloom.functions import chat, text, verdicts


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("<T>\n a b \n</T>", "a b"), ("<T></T>", ""), ("none", ""), ("<t>a</t>", ""), ("<T>open", ""), ("<T>a</T><T>b</T>", "a"),
        ("<T>a <T>b</T>", "a <T>b"), ("<T>\xa0　a\x85\x1c</T>", "a"), ("<T>​a</T>", "​a"),
    ],
)
def test_tag(value, given, expected):
    assert value(text.tag(F.lit(given), "T")) == expected


@pytest.mark.parametrize("given", ["", "  ", "a", " a  b ", "a\x1cb\x85c　d\xa0e", "\n\nx\ty\n"])
def test_words_and_strip(value, given):
    assert value(text.word_count(F.lit(given))) == len(given.split())
    assert value(text.strip(F.lit(given))) == given.strip()


def test_null_text_counts_as_empty(value):
    none = F.lit(None).cast("string")
    assert value(text.word_count(none)) == 0 and value(text.strip(none)) == "" and value(text.tag(none, "T")) == ""


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("PASS", ("pass", None, None)), (" pass ", ("pass", None, None)), ("FAIL OVER_DELETION: x: y", ("fail", "OVER_DELETION", "x: y")),
        ("FAIL something", ("fail", "UNKNOWN", "something")), ("FAILURE: z", ("fail", "URE", "z")), ("PASS.", ("pass", None, None)),
        ("maybe", ("pass", None, None)), ("", ("pass", None, None)),
    ],
)
def test_verdict(value, given, expected):
    assert tuple(value(verdicts.verdict(F.lit(given)))) == expected


def test_judge_reply(value):
    both = {"output_a": {"conciseness": 4.5}, "output_b": {"conciseness": 3}}
    for reply in (json.dumps(both), f"```json\n{json.dumps(both)}\n```", f"```\n{json.dumps(both)}```"):
        assert value(verdicts.judge_reply(F.lit(reply)))["output_a"] == {"conciseness": 4.5}
    assert value(verdicts.judge_reply(F.lit('{"output_a": {}}'))) is None
    assert value(verdicts.judge_reply(F.lit("no"))) is None
    assert value(verdicts.first_reply(F.array(F.lit("no"), F.lit(json.dumps(both)))))["output_b"] == {"conciseness": 3.0}


def scores(**given):
    return F.create_map(*(x for k, v in given.items() for x in (F.lit(k), F.lit(float(v))))) if given else F.create_map().cast("map<string,double>")


def test_weighted_golden(value):
    for n, expected in ((5, 100.0), (1, 20.0)):
        assert value(verdicts.weighted(scores(**dict.fromkeys(verdicts.WEIGHTS, n)))) == expected
    assert value(verdicts.weighted(scores())) == 60.0
    mixed = dict(meaning_preservation=4, instruction_following=5, filler_removal=4, grammar_fluency=5, technical_accuracy=5, conciseness=4)
    assert value(verdicts.weighted(scores(**mixed))) == 90.8


@pytest.mark.parametrize(
    ("wins", "total", "low", "high"),
    [(124, 136, 0.852, 0.949), (121, 135, 0.833, 0.937), (79, 117, 0.586, 0.753), (98, 127, 0.691, 0.836), (0, 10, 0, 0.278), (10, 10, 0.722, 1.0), (0, 0, 0, 0)],
)
def test_wilson_golden(value, wins, total, low, high):
    a, b = verdicts.wilson(F.lit(wins), F.lit(total))
    assert (round(value(a), 3), round(value(b), 3)) == (low, high)


def test_components(value):
    request = {
        "messages": [
            {"role": "system", "content": "<SYSTEM_INSTRUCTIONS>use <CUSTOM_VOCABULARY>no</CUSTOM_VOCABULARY></SYSTEM_INSTRUCTIONS><CUSTOM_VOCABULARY> yes </CUSTOM_VOCABULARY>"},
            {"role": "user", "content": "<TRANSCRIPT>first</TRANSCRIPT>"},
            {"role": "user", "content": "<TRANSCRIPT>last</TRANSCRIPT>"},
        ],
        "model": "m",
    }
    got = {k: value(c) for k, c in chat.components(F.lit(json.dumps(request))).items()}
    assert got["transcript"] == "last" and got["custom_vocabulary"] == "yes" and got["temperature"] == 0.3 and got["clipboard_context"] == ""
    assert value(chat.components(F.lit(json.dumps(request | {"temperature": None})))["temperature"]) is None
    assert value(chat.components(F.lit("[1]"))["transcript"]) == ""
    assert value(chat.components(F.lit('{"messages": [{"role": "user", "content": null}]}'))["transcript"]) == ""


def test_envelope_round_trip(value):
    user = chat.transcript_text(F.lit('quote " and {brace}'))
    raw = chat.envelope(chat.system_text(F.lit("p"), F.lit("w"), F.lit("v")), user, "m")
    got = {k: value(c) for k, c in chat.components(raw).items()}
    assert (got["transcript"], got["window_context"], got["custom_vocabulary"], got["model"]) == ('quote " and {brace}', "w", "v", "m")


@pytest.mark.parametrize(
    ("body", "expected"),
    [('{"choices":[{"message":{"content":"hi"}}]}', "hi"), ("{}", ""), ('{"choices":[]}', ""), ('{"choices":"q"}', ""), ('{"choices":[{"message":{"content":5}}]}', ""), ("{bad", "")],
)
def test_response_text(value, body, expected):
    assert value(chat.response_text(F.lit(body))) == expected


@pytest.mark.parametrize(("body", "expected"), [("null", False), ("", False), ("[1]", True), ("{bad", False), ('{"a":1}', True)])
def test_json_valid(value, body, expected):
    assert value(chat.json_valid(F.lit(body))) is expected


@pytest.mark.parametrize(
    ("stop", "expected"),
    [(None, ["</think>"]), ("x", ["x", "</think>"]), (["x"], ["x", "</think>"]), (["</think>", "x"], ["</think>", "x"]), ([], ["</think>"])],
)
def test_rewritten_request(value, stop, expected):
    body = {"messages": [{"role": "user", "content": 'say "stop": now'}], "seed": 7} | ({} if stop is None else {"stop": stop})
    got = json.loads(value(chat.rewritten_request(F.lit(chat.CHAT_PATH), F.lit(json.dumps(body)))))
    assert got == body | {"stop": expected}
    assert value(chat.rewritten_request(F.lit("/other"), F.lit("{}"))) == "{}"


def test_render_leaves_braces_in_values_alone(value):
    got = value(text.render("a {x} {{y}} {x}", x=F.lit("{label} {{x}}")))
    assert got == "a {label} {{x}} {y} {label} {{x}}"


def test_valid_utf8(value):
    assert value(text.valid_utf8(F.lit(bytearray(b"a\xffb")))) == "a�b"
    assert value(text.md5_int(F.lit("42:1"))) == 1494077868
