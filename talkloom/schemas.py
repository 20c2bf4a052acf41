"""Explicit schemas of all tables; nothing is inferred."""

from __future__ import annotations

REQUEST_LOG = (
    "timestamp string, request_id string, client_ip string, method string, path string, status_code int, "
    "duration_ms double, model string, request_json_valid boolean, response_json_valid boolean, "
    "raw_request_json string, raw_response_json string, response_text string, error string"
)
LABELED = (
    "request_id string, timestamp string, model_used_for_label string, original_model string, "
    "raw_request_json string, original_response string, label string, "
    "validation struct<status:string,type:string,reason:string>, manually_reviewed boolean"
)
#: Content stays text: a string as it is, an array as raw JSON.
REQUEST = "messages array<struct<role:string,content:string>>, model string, temperature double, stream boolean, stop string"
CHAT_SAMPLE = "messages array<struct<role:string,content:array<struct<type:string,text:string>>>>"
SCORES = "map<string,double>"
JUDGE_REPLY = f"output_a {SCORES}, output_b {SCORES}"
EVAL_DETAIL = (
    "sample_index int, raw_transcript string, gold_label string, baseline_output string, candidate_output string, "
    f"baseline_duration_ms double, candidate_duration_ms double, baseline_scores {SCORES}, candidate_scores {SCORES}, "
    "baseline_weighted double, candidate_weighted double"
)
JUDGE_ERROR = "sample_index int, attempt int, raw_response string"
