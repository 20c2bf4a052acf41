"""Chat requests and responses: parsing, components, envelopes, log columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import REQUEST
from .text import from_first, or_else, tag, text_of

#: Stop tokens that chat requests get, and the path of these requests.
STOP_TOKENS = ["</think>"]
CHAT_PATH = "/v1/chat/completions"
#: Headers that belong to one hop.
HOP_HEADERS = ["connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailers", "transfer-encoding", "upgrade"]
DEFAULT_TEMPERATURE = 0.3


def last_content(messages: Column, role: str) -> Column:
    """Content of the last message of a role, empty if there is none."""
    own = F.filter(messages, lambda m: m["role"] == role)
    return F.coalesce(F.try_element_at(own, F.lit(-1))["content"], F.lit(""))


def components(raw: Column | str) -> dict[str, Column]:
    """The seven components of a request: tags of its last system and user message.

    Context tags count only after the instructions, which may name them.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    request = F.from_json(raw, REQUEST)
    system = last_content(request["messages"], "system")
    context = from_first(system, "</SYSTEM_INSTRUCTIONS>")
    given = F.json_object_keys(raw)
    return {
        "transcript": tag(last_content(request["messages"], "user"), "TRANSCRIPT"),
        "custom_vocabulary": tag(context, "CUSTOM_VOCABULARY"),
        "clipboard_context": tag(context, "CLIPBOARD_CONTEXT"),
        "window_context": tag(context, "CURRENT_WINDOW_CONTEXT"),
        "system_prompt": tag(system, "SYSTEM_INSTRUCTIONS"),
        "model": text_of(request["model"]),
        # the default only where the key is absent: an explicit null stays null
        "temperature": F.when(F.array_contains(given, "temperature"), request["temperature"]).otherwise(F.lit(DEFAULT_TEMPERATURE)),
    }


def system_text(prompt: Column, window: Column, vocabulary: Column) -> Column:
    return F.concat(
        prompt, F.lit("\n\n<CURRENT_WINDOW_CONTEXT>\n"), window, F.lit("\n</CURRENT_WINDOW_CONTEXT>\n\n<CUSTOM_VOCABULARY>\n"),
        vocabulary, F.lit("\n</CUSTOM_VOCABULARY>"),
    )


def envelope(system: Column, user: Column, model: str) -> Column:
    """A request as JSON with one system and one user message."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.to_json(
        F.struct(
            F.array(message("system", system), message("user", user)).alias("messages"),
            F.lit(DEFAULT_TEMPERATURE).alias("temperature"), F.lit(model).alias("model"),
            F.lit(True).alias("stream"), F.array(*map(F.lit, STOP_TOKENS)).alias("stop"),
        )
    )


def transcript_text(transcript: Column) -> Column:
    return F.concat(F.lit("<TRANSCRIPT>\n"), transcript, F.lit("\n</TRANSCRIPT>"))


def json_valid(raw: Column | str) -> Column:
    """Whether a body parses to a JSON value other than null."""
    parsed = F.try_parse_json(F.col(raw) if isinstance(raw, str) else raw)
    return F.coalesce(parsed.isNotNull() & ~F.is_variant_null(parsed), F.lit(False))


def response_text(raw: Column | str) -> Column:
    """``choices[0].message.content`` of a response where it is text, else empty."""
    parsed = F.try_parse_json(F.col(raw) if isinstance(raw, str) else raw)
    content = F.try_variant_get(parsed, "$.choices[0].message.content", "variant")
    is_text = F.schema_of_variant(content) == "STRING"
    return F.coalesce(F.when(is_text, F.try_variant_get(parsed, "$.choices[0].message.content", "string")), F.lit(""))


def merged_stop(stop: Column) -> Column:
    """The request's stop tokens, a JSON string or array, then the injected ones, each once."""
    listed = F.when(F.startswith(F.ltrim(stop), F.lit("[")), F.from_json(stop, "array<string>")).when(
        F.coalesce(stop, F.lit("")) != "", F.array(stop)
    )
    own = F.coalesce(listed, F.array().cast("array<string>"))
    return F.array_distinct(F.concat(own, F.array(*map(F.lit, STOP_TOKENS))))


def rewritten_request(path: Column, raw: Column) -> Column:
    """A chat request with its stop tokens merged, all other fields kept as text; others unchanged."""
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    stop = F.to_variant_object(merged_stop(F.get_json_object(raw, "$.stop")))
    kept = F.map_filter(fields, lambda k, v: k != "stop")
    eligible = (path == CHAT_PATH) & F.startswith(F.ltrim(raw), F.lit("{")) & fields.isNotNull()
    return F.when(eligible, F.to_json(F.map_concat(kept, F.create_map(F.lit("stop"), stop)))).otherwise(raw)


def backend_headers(headers: Column, host: str, length: Column) -> Column:
    """Headers as passed on: hop headers out, the backend's host, the body's length."""
    own = F.map_filter(headers, lambda k, v: ~F.lower(k).isin(HOP_HEADERS) & (k != "Content-Length"))
    own = F.transform_values(own, lambda k, v: F.when(F.lower(k) == "host", F.lit(host)).otherwise(v))
    return F.when(length > 0, F.map_concat(own, F.create_map(F.lit("Content-Length"), length.cast("string")))).otherwise(own)


def log_columns(raw_request: Column, raw_response: Column, error: Column) -> dict[str, Column]:
    """Derived columns of a log row; a failed backend call gets status 502 and an error body."""
    failed = F.coalesce(error, F.lit("")) != ""
    body = F.when(failed, F.to_json(F.struct(error.alias("error")))).otherwise(raw_response)
    model = lambda raw: F.nullif(F.get_json_object(raw, "$.model"), F.lit(""))
    return {
        "status_code": F.when(failed, F.lit(502)).otherwise(F.lit(200)),
        "model": F.coalesce(model(raw_request), model(body), F.lit("")),
        "request_json_valid": json_valid(raw_request),
        "response_json_valid": json_valid(body),
        "raw_request_json": raw_request,
        "raw_response_json": body,
        "response_text": response_text(body),
        "error": text_of(error),
    }


def user_message(window: Column, clipboard: Column, vocabulary: Column, transcript: Column) -> Column:
    """Context blocks that have content, then the transcript, a blank line between."""
    block = lambda name, c: F.when(text_of(c) != "", F.concat(F.lit(f"<{name}>\n"), c, F.lit(f"\n</{name}>")))
    return F.concat_ws(
        "\n\n", block("CURRENT_WINDOW_CONTEXT", window), block("CLIPBOARD_CONTEXT", clipboard),
        block("CUSTOM_VOCABULARY", vocabulary), transcript_text(transcript),
    )


def chat_messages(system: Column, user: Column, answer: Column) -> Column:
    """Three messages with typed content blocks."""
    turn = lambda role, text: F.struct(
        F.lit(role).alias("role"), F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content")
    )
    return F.array(turn("system", system), turn("user", user), turn("assistant", answer))


def plain_messages(system: Column, user: Column) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", system), turn("user", user))


#: What prompts say where a record lacks a context.
FALLBACKS = {"custom_vocabulary": "(none provided)", "clipboard_context": "(empty)", "window_context": "(empty)"}


def with_fallbacks(parts: dict[str, Column]) -> dict[str, Column]:
    return {k: or_else(c, FALLBACKS[k]) if k in FALLBACKS else c for k, c in parts.items()}
