"""One query per operator over the driver's whole tables, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import chat, text, verdicts
from ..operators import dataset, evaluation, reports, resampling, select, selection, twister, upsert
from ..sources import jsonl, sinks
from ..sources import text as text_source
from ..streaming import ingest
from .standins import LABELED_SQL, LOG_SQL, MODEL, PROMPT, SCORES_SQL, labeled_rows, load, log_rows, score_maps, work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_COUNT = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> ''))"
_BUCKET = "CASE WHEN words < 50 THEN 0 WHEN words < 100 THEN 1 WHEN words < 200 THEN 2 WHEN words < 500 THEN 3 ELSE 4 END"
_NAMES = "(VALUES (0, '0-50 words'), (1, '50-100 words'), (2, '100-200 words'), (3, '200-500 words'), (4, '500+ words')) b(k, bucket)"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


# ---- lengths ----


@query(f"""
WITH c AS (SELECT {_COUNT} AS words FROM documents), g AS (SELECT {_BUCKET} AS k, count(*) AS n FROM c GROUP BY 1)
SELECT bucket, coalesce(n, 0)::BIGINT AS n, coalesce(n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM c) AS pct_n
FROM {_NAMES} LEFT JOIN g USING (k)
""")
def length_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = load(spark, sf_dir, "documents").select(text.word_count("text").alias("words"))
    return dataset.length_distribution(spark, counts)


@query(f"""
WITH c AS (SELECT {_COUNT} AS words, true AS own FROM documents UNION ALL SELECT {_COUNT}, false FROM conversations),
g AS (SELECT {_BUCKET} AS k, count(*) FILTER (own) AS n_real, count(*) AS n_all FROM c GROUP BY 1)
SELECT bucket, coalesce(n_real, 0)::BIGINT AS n_real, coalesce(n_all, 0)::BIGINT AS n_all,
       coalesce(n_real, 0) * 100.0::DOUBLE / (SELECT count(*) FROM c WHERE own) AS pct_n_real,
       coalesce(n_all, 0) * 100.0::DOUBLE / (SELECT count(*) FROM c) AS pct_n_all
FROM {_NAMES} LEFT JOIN g USING (k)
""")
def length_distribution_two_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [
        load(spark, sf_dir, name).select(text.word_count("text").alias("words"), F.lit(own).alias("own"))
        for name, own in (("documents", True), ("conversations", False))
    ]
    return dataset.length_distribution(spark, both[0].unionAll(both[1]), {"n_real": F.col("own"), "n_all": F.lit(True)})


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\S+') AS l FROM documents),
g AS (SELECT doc_id, array_to_string(list_slice(l, s, s + 7), ' ') AS gram FROM (SELECT doc_id, l, unnest(range(1, len(l) - 6)) AS s FROM w WHERE len(l) >= 8)),
r AS (SELECT doc_id, gram, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) > 1)
SELECT doc_id, count(*)::BIGINT AS repeated, sum(n)::BIGINT AS places FROM r GROUP BY doc_id
""")
def ngram_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", text.ngram_repeats("text").alias("r"))
    return rows.select("doc_id", "r.repeated", "r.places").where("repeated > 0")


# ---- requests and logs ----


@query(f"""
WITH {LOG_SQL}, t AS (
  SELECT request_id, chr(10) || window_text || chr(10) AS w, chr(10) || asked || chr(10) AS a, turn FROM log_v)
SELECT request_id, {_STRIP.format('a')} AS transcript, 'term ' || turn AS custom_vocabulary, '' AS clipboard_context,
       {_STRIP.format('w')} AS window_context,
       'Keep the meaning; <CUSTOM_VOCABULARY>names</CUSTOM_VOCABULARY> may follow.' AS system_prompt,
       'small-chat' AS model, 0.3::DOUBLE AS temperature
FROM t
""")
def extract_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_rows(spark, sf_dir)
    return rows.select("request_id", *(c.alias(k) for k, c in chat.components("raw_request_json").items()))


@query("""
SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'system'), '') AS system_text,
       coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS user_text,
       coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '') AS assistant_text
FROM conversations GROUP BY conv_id
""")
def last_message_per_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations")
    messages = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return messages.select("conv_id", *(chat.last_content(F.col("m"), r).alias(f"{r}_text") for r in ("system", "user", "assistant")))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 6 = 1 THEN text ELSE '' END AS response_text
FROM conversations WHERE role = 'assistant'
""")
def response_text_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole replies, and replies that lack text: empty, mistyped or missing levels."""
    rows = load(spark, sf_dir, "conversations").where("role = 'assistant'")
    message = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"))).alias("choices")))
    body = (
        F.when(F.col("turn") % 6 == 1, message)
        .when(F.col("turn") % 6 == 3, F.lit('{"choices": [{"message": {"content": 5}}]}'))
        .when(F.col("turn") % 6 == 5, F.lit('{"choices": "q"}'))
        .otherwise(F.lit('{"choices": []}'))
    )
    return rows.select("conv_id", "turn", chat.response_text(body).alias("response_text"))


@query("""
SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '</think>' WHEN 1 THEN '</think>|x' WHEN 2 THEN '</think>|a|b'
       WHEN 3 THEN '</think>|x' ELSE '</think>' END AS stop
FROM conversations
""")
def stop_token_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations")
    given = F.element_at(F.array(F.lit(None), F.lit('{"stop": "x"}'), F.lit('{"stop": ["b", "a", "b"]}'), F.lit('{"stop": ["</think>", "x"]}'), F.lit('{"stop": []}')), (F.col("turn") % 5 + 1).cast("int"))
    raw = F.coalesce(given, F.lit("{}"))
    changed = chat.rewritten_request(F.lit(chat.CHAT_PATH), raw)
    stop = F.from_json(F.get_json_object(changed, "$.stop"), "array<string>")
    return rows.select("conv_id", "turn", F.array_join(F.array_sort(stop), "|").alias("stop"))


@query("""
WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN 'null' WHEN 2 THEN '{bad' ELSE '[1]' END AS body FROM events)
SELECT event_id, json_valid(body) AND body <> 'null' AS valid FROM e
""")
def log_validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.expr("case event_id % 4 when 0 then props when 1 then 'null' when 2 then '{bad' else '[1]' end")
    return load(spark, sf_dir, "events").select("event_id", chat.json_valid(body).alias("valid"))


@query("""
SELECT event_id, 'Content-Length=' || length(props) || ';Host=backend:8002;X-Type=' || event_type AS headers FROM events
""")
def header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = {"Host": F.lit("proxy:1"), "Connection": F.lit("close"), "TE": F.lit("x"), "X-Type": F.col("event_type"), "Content-Length": F.lit("0")}
    headers = F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v)))
    sent = chat.backend_headers(headers, "backend:8002", F.length("props"))
    entries = F.array_sort(F.transform(F.map_entries(sent), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return load(spark, sf_dir, "events").select("event_id", F.array_join(entries, ";").alias("headers"))


@query("""
SELECT event_id, CASE WHEN value < 10 THEN 502 ELSE 200 END AS status_code, CASE WHEN value < 10 THEN '' ELSE 'm-' || event_type END AS model,
       CASE WHEN value < 10 THEN '{"error":"refused"}' ELSE '{"model":"m-' || event_type || '"}' END AS raw_response_json,
       CASE WHEN value < 10 THEN 'refused' ELSE '' END AS error
FROM events
""")
def log_row_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    response = F.to_json(F.struct(F.concat(F.lit("m-"), "event_type").alias("model")))
    parts = chat.log_columns(F.lit('{"model": ""}'), response, F.when(F.col("value") < 10, "refused"))
    kept = ("status_code", "model", "raw_response_json", "error")
    return load(spark, sf_dir, "events").select("event_id", *(parts[k].alias(k) for k in kept))


@query(f"WITH {LOG_SQL} SELECT request_id, response_text FROM log_v WHERE request_json_valid AND response_json_valid")
def strict_valid_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.valid_rows(log_rows(spark, sf_dir)).select("request_id", "response_text")


# ---- selection and keyed tables ----


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_labels_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.pending(load(spark, sf_dir, "documents").select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id")


@query(f"WITH {LOG_SQL} SELECT request_id FROM log_v WHERE starts_with(request_id, '1') OR starts_with(request_id, '25-')")
def prefix_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.by_prefixes(log_rows(spark, sf_dir), ["1", "25-"]).select("request_id")


@query(f"WITH {LOG_SQL} SELECT request_id, length(response_text)::BIGINT AS n_chars FROM log_v ORDER BY length(response_text) DESC, conv_id, turn LIMIT 20")
def longest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_rows(spark, sf_dir).withColumn("pos", F.struct("conv_id", "turn"))
    return select.longest(rows, 20).select("request_id", F.length("response_text").cast("long").alias("n_chars"))


@query(f"WITH {LOG_SQL} SELECT request_id FROM log_v ORDER BY conv_id, turn LIMIT 15")
def head_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_rows(spark, sf_dir).withColumn("pos", F.struct("conv_id", "turn"))
    return select.head(rows, 15).select("request_id")


@query("""
WITH u AS (SELECT source AS k, doc_id AS pos, n_chars AS v, 0 AS turn FROM documents
           UNION ALL SELECT source || (doc_id % 2), doc_id, -n_chars, 1 FROM documents WHERE doc_id % 3 = 0
           UNION ALL SELECT source, doc_id, -n_chars, 1 FROM documents WHERE doc_id % 3 = 1)
SELECT k AS source, arg_min(pos, (turn, pos))::BIGINT AS pos, arg_max(v, (turn, pos))::BIGINT AS v FROM u GROUP BY k
""")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    old = docs.select("source", F.col("doc_id").alias("pos"), F.col("n_chars").alias("v"))
    renamed = docs.where("doc_id % 3 = 0").select(F.concat("source", (F.col("doc_id") % 2).cast("string")).alias("source"), F.col("doc_id").alias("pos"), (-F.col("n_chars")).alias("v"))
    replaced = docs.where("doc_id % 3 = 1").select("source", F.col("doc_id").alias("pos"), (-F.col("n_chars")).alias("v"))
    return upsert.upsert(old, renamed.union(replaced), "source")


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'q' || l.quality ELSE lang END AS lang
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def update_matched_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = load(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("lang"))
    unknown = changes.select((-F.col("doc_id") - 1).alias("doc_id"), "lang")
    return upsert.update(load(spark, sf_dir, "documents").select("doc_id", "lang"), changes.union(unknown), "doc_id", "lang")


@query(f"WITH {LABELED_SQL} SELECT count(*) FILTER (NOT coalesce(manually_reviewed, false))::BIGINT AS changed FROM labeled_v")
def mark_reviewed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.mark_reviewed(labeled_rows(spark, sf_dir))[1]


@query(f"WITH {LABELED_SQL} SELECT request_id FROM labeled_v WHERE status IS NULL AND NOT manually_reviewed")
def needs_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.needs_validation(labeled_rows(spark, sf_dir)).select("request_id")


@query("""
WITH r AS (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'PASS' WHEN 1 THEN ' pass ' WHEN 2 THEN 'FAIL OVER_DELETION: x: ' || source
  WHEN 3 THEN 'FAIL something' WHEN 4 THEN 'FAILURE: z' WHEN 5 THEN 'PASS.' WHEN 6 THEN 'maybe' ELSE 'fail  A :b ' END AS k, source FROM documents)
SELECT doc_id, CASE WHEN doc_id % 8 IN (2, 3, 4, 7) THEN 'fail' ELSE 'pass' END AS status,
  CASE doc_id % 8 WHEN 2 THEN 'OVER_DELETION' WHEN 3 THEN 'UNKNOWN' WHEN 4 THEN 'URE' WHEN 7 THEN 'A' END AS type,
  CASE doc_id % 8 WHEN 2 THEN 'x: ' || source WHEN 3 THEN 'something' WHEN 4 THEN 'z' WHEN 7 THEN 'b' END AS reason
FROM r
""")
def parse_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.expr(
        "case doc_id % 8 when 0 then 'PASS' when 1 then ' pass ' when 2 then 'FAIL OVER_DELETION: x: ' || source when 3 then 'FAIL something' "
        "when 4 then 'FAILURE: z' when 5 then 'PASS.' when 6 then 'maybe' else 'fail  A :b ' end"
    )
    return load(spark, sf_dir, "documents").select("doc_id", verdicts.verdict(reply).alias("v")).select("doc_id", "v.*")


@query(f"WITH {LABELED_SQL} SELECT coalesce(type, 'UNKNOWN') AS type, count(*)::BIGINT AS n FROM labeled_v WHERE status = 'fail' AND NOT manually_reviewed GROUP BY 1")
def failures_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.failures_by_type(select.open_failures(labeled_rows(spark, sf_dir)))


@query(f"""WITH {LABELED_SQL}
SELECT request_id, coalesce(nullif({_STRIP.format("label")}, ''), '(failed to extract)') AS transcript, coalesce(nullif(label, ''), '(no label)') AS label,
       upper(status) || ' ' || type || ' ' || reason AS verdict
FROM labeled_v WHERE status = 'fail'""")
def inspect_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole transcripts and labels of failed records, here the same text."""
    content = chat.system_text(F.lit(PROMPT), F.lit(""), F.lit(""))
    request = chat.envelope(content, chat.transcript_text(F.coalesce("label", F.lit(""))), MODEL)
    return reports.inspection(select.all_failures(labeled_rows(spark, sf_dir)).withColumn("raw_request_json", request))


@query(f"""WITH {LABELED_SQL}
SELECT count(*) FILTER (status = 'pass')::BIGINT AS passed, count(*) FILTER (status = 'fail')::BIGINT AS failed,
       count(*) FILTER (status IS NULL)::BIGINT AS open, count(*)::BIGINT AS total FROM labeled_v""")
def validation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.validation_counts(labeled_rows(spark, sf_dir))


# ---- prompts ----


@query(f"""WITH {LOG_SQL}
SELECT request_id, 'Clean this {{json}}.' || chr(10) || 'Terms: term ' || turn || chr(10) || 'Window: ' ||
       coalesce(nullif({_STRIP.format('window_text')}, ''), '(empty)') || chr(10) || 'Clipboard: (empty)' || chr(10) ||
       {_STRIP.format('asked')} AS prompt FROM log_v""")
def render_label_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = "Clean this {{json}}.\nTerms: {custom_vocabulary}\nWindow: {window_context}\nClipboard: {clipboard_context}\n{transcript}"
    parts = chat.with_fallbacks(chat.components("raw_request_json"))
    return log_rows(spark, sf_dir).select("request_id", text.render(template, **parts).alias("prompt"))


@query("""SELECT doc_id, 'Gold: ' || coalesce(text, '') || chr(10) || 'A: {label} ' || source || chr(10) || 'Reply {"output_a": {}}' AS prompt FROM documents""")
def render_judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with the whole text as gold label."""
    template = 'Gold: {gold}\nA: {a}\nReply {{"output_a": {{}}}}'
    prompt = text.render(template, gold=F.coalesce("text", F.lit("")), a=F.concat(F.lit("{label} "), "source"))
    return load(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


# ---- datasets ----


@query(f"""WITH {LABELED_SQL}, a AS (SELECT request_id, manually_reviewed FROM labeled_v
  UNION ALL SELECT printf('syn-%03d', doc_id), NULL FROM labeled_v WHERE doc_id % 7 = 0)
SELECT request_id FROM a WHERE manually_reviewed OR starts_with(request_id, 'syn-')""")
def training_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labeled_rows(spark, sf_dir)
    synthetic = rows.where("doc_id % 7 = 0").select(dataset.synthetic_id(F.col("doc_id")).alias("request_id"))
    return dataset.eligible(rows.unionByName(synthetic, allowMissingColumns=True)).select("request_id")


@query(f"""WITH {LOG_SQL}, t AS (SELECT *, {_STRIP.format('asked')} AS a, {_STRIP.format('window_text')} AS w, {_STRIP.format('response_text')} AS r FROM log_v)
SELECT request_id, 'system' AS role, 'Be brief.' AS text FROM t WHERE a <> '' AND r <> ''
UNION ALL SELECT request_id, 'user', CASE WHEN w <> '' THEN '<CURRENT_WINDOW_CONTEXT>' || chr(10) || w || chr(10) || '</CURRENT_WINDOW_CONTEXT>' || chr(10) || chr(10) ELSE '' END
  || '<CUSTOM_VOCABULARY>' || chr(10) || 'term ' || turn || chr(10) || '</CUSTOM_VOCABULARY>' || chr(10) || chr(10)
  || '<TRANSCRIPT>' || chr(10) || a || chr(10) || '</TRANSCRIPT>' FROM t WHERE a <> '' AND r <> ''
UNION ALL SELECT request_id, 'assistant', r FROM t WHERE a <> '' AND r <> ''""")
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_rows(spark, sf_dir).withColumn("label", F.col("response_text"))
    samples = dataset.chat_samples(rows, "Be brief.")
    # chat samples carry no id: the request is found again by its own columns
    parts = chat.components("raw_request_json")
    user = chat.user_message(parts["window_context"], parts["clipboard_context"], parts["custom_vocabulary"], parts["transcript"])
    ids = rows.select("request_id", user.alias("user"), text.strip("label").alias("answer")).distinct()
    keyed = samples.select("messages", F.col("messages")[1]["content"][0]["text"].alias("user"), F.col("messages")[2]["content"][0]["text"].alias("answer"))
    joined = keyed.join(ids, ["user", "answer"]).select("request_id", "messages").distinct()
    return joined.select("request_id", F.explode("messages").alias("m")).select("request_id", "m.role", F.col("m.content")[0]["text"].alias("text"))


@query("""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS k, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN k < floor(n * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS part FROM r
""")
def split_train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.split(load(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "part")


@query("""
WITH r AS (SELECT text, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS k, count(*) OVER () AS n FROM documents),
p AS (SELECT md5(coalesce(text, '')) AS t, k < floor(n * 0.1::DOUBLE) AS e FROM r)
SELECT count(*)::BIGINT AS leaked FROM (SELECT t FROM p GROUP BY t HAVING count(DISTINCT e) > 1)
""")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = load(spark, sf_dir, "documents").select("doc_id", F.md5(text.text_of("text")).alias("digest"))
    return dataset.leakage(select.split(digests, "doc_id"), "digest")


_DIMS = {"topic": [f"topic {c}" for c in "abcdefghijkl"], "scenario": [f"scenario {c}" for c in "abcdefghijkl"], "target_words": [500, 750, 1000, 1500, 2000, 2500, 3000, 3500]}


@query("""
SELECT 'topic ' || chr((97 + doc_id % 12)::INT) AS topic, 'scenario ' || chr((97 + doc_id % 12)::INT) AS scenario,
       [500, 750, 1000, 1500, 2000, 2500, 3000, 3500][doc_id % 8 + 1]::INT AS target_words, (doc_id + 1)::BIGINT AS seed, printf('syn-%03d', doc_id + 1) AS request_id
FROM documents
""")
def scenario_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An assignment for every document."""
    rows = select.assignments(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("i")), _DIMS)
    return rows.select("topic", "scenario", "target_words", (F.col("i") + 1).alias("seed"), dataset.synthetic_id(F.col("i") + 1).alias("request_id"))


@query("""
SELECT printf('syn-%03d', i + 1) AS request_id FROM (SELECT unnest(range(120))::INT AS i)
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = i + 1)
""")
def synthetic_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = load(spark, sf_dir, "labels").select(dataset.synthetic_id(F.col("doc_id")).alias("request_id"))
    return select.pending(spark.range(120).select(dataset.synthetic_id(F.col("id") + 1).alias("request_id")), done)


@query(f"""SELECT doc_id, {_STRIP.format("text")} AS raw, source AS clean FROM documents WHERE doc_id % 4 <> 3""")
def parse_synthetic_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = F.when(F.col("doc_id") % 4 != 3, F.concat(F.lit("<CLEAN_TRANSCRIPT>\n"), "source", F.lit(" \n</CLEAN_TRANSCRIPT>"))).otherwise("")
    reply = F.concat(F.lit("Here:\n<RAW_TRANSCRIPT>\n"), "text", F.lit("\n</RAW_TRANSCRIPT>\n"), clean)
    rows = load(spark, sf_dir, "documents").withColumn("reply", reply)
    whole = rows.where(text.has_tag("reply", "RAW_TRANSCRIPT") & text.has_tag("reply", "CLEAN_TRANSCRIPT"))
    return whole.select("doc_id", text.tag("reply", "RAW_TRANSCRIPT").alias("raw"), text.tag("reply", "CLEAN_TRANSCRIPT").alias("clean"))


@query(f"""WITH {LOG_SQL}
SELECT request_id, {_STRIP.format('asked')} AS raw_transcript, CASE WHEN turn % 4 = 0 THEN 'term ' || turn ELSE '' END AS custom_vocabulary, response_text AS gold_label FROM log_v""")
def eval_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with the tags, and without them, where the whole user text counts."""
    rows = log_rows(spark, sf_dir)
    parts = chat.components("raw_request_json")
    none = F.lit("")
    tagged = chat.user_message(none, none, parts["custom_vocabulary"], parts["transcript"])
    user = F.when(F.col("turn") % 4 == 0, tagged).otherwise(F.concat(F.lit(" \n"), parts["transcript"], F.lit("\n")))
    samples = rows.select("request_id", chat.chat_messages(F.lit("s"), user, F.col("response_text")).alias("messages"))
    columns = jsonl.eval_columns(F.col("messages"))
    return samples.select("request_id", *(columns[k].alias(k) for k in ("raw_transcript", "custom_vocabulary", "gold_label")))


# ---- evaluation ----


@query("""
WITH c AS (SELECT text, arg_max(doc_id, doc_id) AS v FROM documents WHERE doc_id % 2 = 0 AND coalesce(text, '') <> '' GROUP BY text)
SELECT d.doc_id, c.text IS NOT NULL AS cached, 'b' || c.v AS baseline_output, coalesce(CASE WHEN c.v % 3 = 0 THEN NULL ELSE c.v::DOUBLE END, CASE WHEN c.text IS NOT NULL THEN 0 END)::DOUBLE AS baseline_duration_ms
FROM documents d LEFT JOIN c ON c.text = d.text
""")
def cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_maps(docs.where("doc_id % 2 = 0")).join(docs.select("doc_id", "text"), "doc_id")
    cache = scored.select(
        F.col("doc_id").alias("pos"), F.col("text").alias("raw_transcript"), "baseline_scores", "candidate_scores",
        F.concat(F.lit("b"), F.col("doc_id").cast("string")).alias("baseline_output"), F.lit("").alias("candidate_output"),
        F.when(F.col("doc_id") % 3 != 0, F.col("doc_id").cast("double")).alias("baseline_duration_ms"), F.lit(1.0).alias("candidate_duration_ms"),
    )
    samples = docs.select("doc_id", F.col("text").alias("raw_transcript"))
    return evaluation.cached_samples(samples, jsonl.usable_cache(cache)).select("doc_id", "cached", "baseline_output", "baseline_duration_ms")


@query("SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 2 = 0 THEN 'baseline' ELSE 'candidate' END AS a_is FROM documents")
def ab_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.when(select.coin("doc_id"), "baseline").otherwise("candidate").alias("a_is"))


@query(f"""WITH {SCORES_SQL}
SELECT doc_id, baseline_meaning_preservation AS baseline, candidate_meaning_preservation AS candidate FROM scores_v WHERE doc_id % 11 <> 0""")
def judge_parse_mapback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fenced replies in blind order; a first attempt that fails is tried again, some never parse."""
    rows = score_maps(load(spark, sf_dir, "documents")).withColumn("a_is_baseline", select.coin("doc_id"))
    a = F.when(F.col("a_is_baseline"), F.col("baseline_scores")).otherwise(F.col("candidate_scores"))
    b = F.when(F.col("a_is_baseline"), F.col("candidate_scores")).otherwise(F.col("baseline_scores"))
    whole = F.concat(F.lit("```json\n"), F.to_json(F.struct(a.alias("output_a"), b.alias("output_b"))), F.lit("\n```"))
    attempts = F.when(F.col("doc_id") % 11 == 0, F.array(F.lit("no"), F.to_json(F.struct(a.alias("output_a"))))).when(F.col("doc_id") % 2 == 0, F.array(F.lit("{"), whole)).otherwise(F.array(whole))
    parsed = rows.withColumn("reply", verdicts.first_reply(attempts)).where("reply is not null")
    scores = verdicts.map_back(F.col("a_is_baseline"), F.col("reply"))
    return parsed.select("doc_id", *(verdicts.dimension(scores[f"{s}_scores"], "meaning_preservation").alias(s) for s in ("baseline", "candidate")))


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_maps(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", *(verdicts.weighted(F.col(f"{s}_scores")).alias(f"{s}_weighted") for s in ("baseline", "candidate")))


def _diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.differences(_weighted(spark, sf_dir), "doc_id")


@query(f"WITH {SCORES_SQL} SELECT doc_id, baseline_weighted, candidate_weighted FROM weighted_v")
def weighted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir)


@query(f"""WITH {SCORES_SQL}
SELECT count(*) FILTER (baseline_weighted > candidate_weighted)::BIGINT AS baseline, count(*) FILTER (candidate_weighted > baseline_weighted)::BIGINT AS candidate,
       count(*) FILTER (candidate_weighted = baseline_weighted)::BIGINT AS tie FROM weighted_v""")
def win_tie_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.wins(_weighted(spark, sf_dir))


@query(f"WITH {SCORES_SQL}" + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {w}::INT AS weight, round(avg(baseline_{d}), 6) AS baseline_avg, round(avg(candidate_{d}), 6) AS candidate_avg FROM scores_v"
    for d, w in verdicts.WEIGHTS.items()
))
def per_dimension_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluation.dimension_means(score_maps(load(spark, sf_dir, "documents")))
    return means.select("dimension", "weight", *(F.round(f"{s}_avg", 6).alias(f"{s}_avg") for s in ("baseline", "candidate")))


@query("""
SELECT event_type, round(coalesce(avg(value), 0), 6) AS avg, round(coalesce(quantile_cont(value, 0.5), 0), 6) AS p50,
       round(coalesce(quantile_cont(value, 0.9), 0), 6) AS p90, round(coalesce(quantile_cont(value, 0.99), 0), 6) AS p99
FROM events WHERE value <> 0 GROUP BY event_type
""")
def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = evaluation.latency(load(spark, sf_dir, "events"), "value", ["event_type"])
    return stats.select("event_type", *(F.round(c, 6).alias(c) for c in ("avg", "p50", "p90", "p99")))


@query("""
WITH a AS (SELECT event_type, avg(value) FILTER (value <> 0) AS v FROM events GROUP BY 1)
SELECT x.event_type AS baseline, y.event_type AS candidate, round(CASE WHEN round(y.v, 1) = 0 THEN 0 ELSE round(x.v, 1) / round(y.v, 1) END, 2) AS ratio
FROM a x JOIN a y ON x.event_type < y.event_type
""")
def speed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluation.mean_latency(load(spark, sf_dir, "events"), "value", ["event_type"])
    left, right = means.toDF("baseline", "b"), means.toDF("candidate", "c")
    pairs = left.join(right, F.col("baseline") < F.col("candidate"))
    return pairs.select("baseline", "candidate", evaluation.speed_ratio(F.col("b"), F.col("c")).alias("ratio"))


@query("""
WITH t AS (SELECT event_type, lead(event_type) OVER (ORDER BY event_type) AS next FROM (SELECT DISTINCT event_type FROM events)),
v AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rank FROM events WHERE value <> 0)
SELECT t.event_type AS baseline, a.rank::BIGINT AS rank, a.value AS a, b.value AS b
FROM t JOIN v a ON a.event_type = t.event_type JOIN v b ON b.event_type = t.next AND b.rank = a.rank
""")
def rank_paired_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type next to the one after it in alphabetical order."""
    events = load(spark, sf_dir, "events").where("value <> 0").select("event_type", "value")
    # the names of event types are a handful
    types = load(spark, sf_dir, "events").select("event_type").distinct()
    after = types.select("event_type", F.lead("event_type").over(Window.orderBy("event_type")).alias("after"))
    placed = selection.ranked(events, "value", ["event_type"])
    left = placed.join(F.broadcast(after), "event_type").select(F.col("event_type").alias("baseline"), F.col("after").alias("event_type"), "rank", F.col("value").alias("a"))
    return left.join(placed.withColumnRenamed("value", "b"), ["event_type", "rank"]).select("baseline", "rank", "a", "b")


_WILSON = """round(({p} + 3.8416 / (2 * n) {sign} 1.96 * sqrt({p} * (1 - {p}) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6)"""


@query(f"""WITH {SCORES_SQL}, g AS (SELECT doc_id % 10 AS grp, count(*) FILTER (candidate_weighted > baseline_weighted)::DOUBLE AS w,
  count(*) FILTER (candidate_weighted <> baseline_weighted)::DOUBLE AS n FROM weighted_v GROUP BY 1)
SELECT grp, {_WILSON.format(p='(w / n)', sign='-')} AS low, {_WILSON.format(p='(w / n)', sign='+')} AS high FROM g""")
def wilson_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _weighted(spark, sf_dir).groupBy((F.col("doc_id") % 10).alias("grp")).agg(
        F.count_if(F.col("candidate_weighted") > F.col("baseline_weighted")).alias("w"),
        F.count_if(F.col("candidate_weighted") != F.col("baseline_weighted")).alias("n"),
    )
    low, high = verdicts.wilson(F.col("w"), F.col("n"))
    return grouped.select("grp", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


#: The normal p of a statistic: Simpson's rule over a thousand steps, as SQL has no error function.
_NORMAL_P = """(1 - 2 / sqrt(pi()) * (abs({z}) / sqrt(2) / 3000) * list_sum(list_transform(range(1001),
  lambda k: (CASE WHEN k % 1000 = 0 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(abs({z}) / sqrt(2) * k / 1000.0::DOUBLE, 2)))))"""
#: From differences x(name, d): statistics and p by name.
_RANKS = f"""r AS (SELECT name, d, rank() OVER (PARTITION BY name ORDER BY abs(d)) + (count(*) OVER (PARTITION BY name, abs(d)) - 1) / 2.0 AS k,
  count(*) OVER (PARTITION BY name, abs(d)) AS t FROM x WHERE d <> 0),
s AS (SELECT name, count(*)::DOUBLE AS n, coalesce(sum(k) FILTER (d > 0), 0)::DOUBLE AS wp, coalesce(sum(k) FILTER (d < 0), 0)::DOUBLE AS wm, sum(t * t - 1)::DOUBLE AS tie FROM r GROUP BY name),
zs AS (SELECT *, CASE WHEN n >= 10 THEN (least(wp, wm) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie / 48) END AS z FROM s),
ps AS (SELECT *, {_NORMAL_P.format(z="z")} AS p FROM zs)"""


@query(f"""WITH {SCORES_SQL}, x AS (SELECT 'all' AS name, round(d, 1) AS d FROM diffs_v), {_RANKS}
SELECT n::BIGINT AS n, wp AS w_plus, wm AS w_minus, tie::BIGINT AS tie_term, round(z, 6) AS z, round(p, 6) AS p FROM ps""")
def wilcoxon_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = evaluation.with_p(evaluation.wilcoxon(_diffs(spark, sf_dir).select(F.round("d", 1).alias("d"))))
    return stats.withColumns({"z": F.round("z", 6), "p": F.round("p", 6)})


@query("""WITH t AS (SELECT event_type, lead(event_type) OVER (ORDER BY event_type) AS next FROM (SELECT DISTINCT event_type FROM events)),
v AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rank FROM events WHERE value <> 0),
x AS (SELECT t.event_type AS name, round(b.value - a.value, 2) AS d FROM t JOIN v a ON a.event_type = t.event_type JOIN v b ON b.event_type = t.next AND b.rank = a.rank),
""" + _RANKS + " SELECT name AS baseline, n::BIGINT AS n, round(z, 6) AS z, round(p, 6) AS p FROM ps")
def latency_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency test between every event type and the one after it."""
    pairs = rank_paired_latency(spark, sf_dir).select("baseline", F.round(F.col("b") - F.col("a"), 2).alias("d"))
    stats = evaluation.with_p(evaluation.wilcoxon(pairs, by=["baseline"]))
    return stats.select("baseline", "n", F.round("z", 6).alias("z"), F.round("p", 6).alias("p"))


#: Keys of draws and hashes of places as ``resampling`` has them within a block; these tables have fewer rows than one.
_KEY = resampling.mixed_sql("xor(({})::UBIGINT, (SELECT base FROM bb))")
_WORD = resampling.mixed_sql(f"(key + (pos::UBIGINT * {resampling.GOLDEN})) & 4294967295")
_BLOCK = f"bb AS (SELECT {resampling.mixed_sql(f'{42 * resampling.GOLDEN % 2**32}::UBIGINT')} AS base)"
_BOOTSTRAP = f"""{_BLOCK}, bn AS (SELECT count(*) AS n FROM diffs_v),
bk AS (SELECT draw, {_KEY.format('draw')} AS key FROM (SELECT unnest(range(10000))::INT AS draw)),
bg AS (SELECT draw, ({_WORD} % n::UBIGINT)::BIGINT AS pick FROM bk, diffs_v, bn),
bm AS (SELECT draw, avg(d) AS mean FROM bg JOIN diffs_v ON diffs_v.pos = bg.pick GROUP BY draw),
bo AS (SELECT mean, row_number() OVER (ORDER BY mean) AS k FROM bm),
gap AS (SELECT round(min(mean) FILTER (k = 251), 6) AS gap_low, round(min(mean) FILTER (k = 9750), 6) AS gap_high FROM bo)"""


@query(f"WITH {SCORES_SQL}, {_BOOTSTRAP} SELECT gap_low AS low, gap_high AS high FROM gap")
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval of all 10,000 draws of the original."""
    ci = resampling.bootstrap_ci(_diffs(spark, sf_dir))
    return ci.select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(f"""WITH {SCORES_SQL}, {_BLOCK}, x AS (SELECT pos, round(d * 10)::BIGINT AS d FROM diffs_v),
k AS (SELECT word, {_KEY.format('word')} AS key FROM (SELECT unnest(range(313))::INT AS word)),
b AS (SELECT word, d, {_WORD} AS bits FROM k, x),
s AS (SELECT word, bit, abs(sum(CASE WHEN (bits >> bit) & 1 = 1 THEN -d ELSE d END)) AS s, abs(sum(d)) AS o
      FROM b, (SELECT unnest(range(32)) AS bit) WHERE word * 32 + bit < 10000 GROUP BY ALL)
SELECT count(*) FILTER (s >= o)::BIGINT AS hits, count(*) FILTER (s >= o) / 10000.0::DOUBLE AS p FROM s""")
def permutation_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The p value of all 10,000 draws of the original."""
    diffs = _diffs(spark, sf_dir).select("pos", F.round(F.col("d") * 10).cast("long").alias("d"))
    return resampling.permutation_p(diffs).select("hits", "p")


@query()
def sequential_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval and p from the original's own seeded stream, bit for bit; SQL has no such generator, a test has the loop."""
    diffs = _diffs(spark, sf_dir).select("pos", F.round(F.col("d") * 10).cast("long").alias("d"))
    return twister.bootstrap_ci(diffs).crossJoin(F.broadcast(twister.permutation_p(diffs).select("hits", "p")))


_VETO = " ".join(
    f"WHEN candidate_{d} < 3 AND baseline_{d} >= 3 THEN 'baseline' WHEN baseline_{d} < 3 AND candidate_{d} >= 3 THEN 'candidate'" for d in verdicts.CRITICAL
)
_MEANS = ", ".join(f"avg({s}_{d}) AS {s}_{d}" for s in ("baseline", "candidate") for d in verdicts.WEIGHTS)
_WINNER = f"CASE {_VETO} WHEN abs(round(b, 1) - round(c, 1)) < 2 THEN 'tie' WHEN round(c, 1) > round(b, 1) THEN 'candidate' ELSE 'baseline' END"


@query(f"""WITH {SCORES_SQL}, g AS (SELECT doc_id % 50 AS grp, avg(baseline_weighted) AS b, avg(candidate_weighted) AS c, {_MEANS} FROM weighted_v GROUP BY 1)
SELECT grp, {_WINNER} AS winner FROM g""")
def winner_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_maps(load(spark, sf_dir, "documents"))
    sides = ("baseline", "candidate")
    means = [F.avg(verdicts.weighted(F.col(f"{s}_scores"))).alias(s) for s in sides]
    means += [F.avg(verdicts.dimension(F.col(f"{s}_scores"), d)).alias(f"{s}_{d}") for s in sides for d in verdicts.WEIGHTS]
    grouped = rows.groupBy((F.col("doc_id") % 50).alias("grp")).agg(*means)
    dims = [{d: F.col(f"{s}_{d}") for d in verdicts.WEIGHTS} for s in sides]
    return grouped.select("grp", verdicts.winner(F.round("baseline", 1), F.round("candidate", 1), *dims).alias("winner"))


_DIM_MEANS = ", ".join(f"round({side}_{d}, 6) AS {side}_{d}" for d in verdicts.WEIGHTS for side in ("baseline", "candidate"))
_LATENCY = """l{s} AS (SELECT round(avg(v), 6) AS {s}_latency_avg, round(quantile_cont(v, 0.5), 6) AS {s}_latency_p50,
  round(quantile_cont(v, 0.9), 6) AS {s}_latency_p90, round(quantile_cont(v, 0.99), 6) AS {s}_latency_p99 FROM (SELECT {v} AS v FROM documents) WHERE v <> 0)"""
_DURATIONS = {"baseline": "n_chars / 4.0::DOUBLE", "candidate": "(n_chars % 97) * 8.0::DOUBLE"}
_DIM_DIFFS = " ".join(f"UNION ALL SELECT 'p_{d}', candidate_{d} - baseline_{d} FROM scores_v" for d in verdicts.WEIGHTS)
_P_NAMES = ["overall_p_value", "latency_p_value", *(f"p_{d}" for d in verdicts.WEIGHTS)]
_P_COLUMNS = ", ".join(f"round(max(p) FILTER (name = '{n}'), 6) AS {n}" for n in _P_NAMES)


def _sorted_sql(expression: str) -> str:
    return f"(SELECT v, row_number() OVER (ORDER BY v) AS k FROM (SELECT {expression} AS v FROM documents) WHERE v <> 0)"


@query(f"""WITH {SCORES_SQL}, g AS (SELECT count(*) AS n_samples, avg(baseline_weighted) AS b, avg(candidate_weighted) AS c,
  count(*) FILTER (baseline_weighted > candidate_weighted) AS wb, count(*) FILTER (candidate_weighted > baseline_weighted) AS wc,
  count(*) FILTER (candidate_weighted = baseline_weighted) AS wt, {_MEANS} FROM weighted_v), h AS (SELECT *, (wb + wc)::DOUBLE AS n, wc::DOUBLE AS w FROM g),
{", ".join(_LATENCY.format(s=s, v=v) for s, v in _DURATIONS.items())},
x(name, d) AS (SELECT 'overall_p_value', round(d, 1) FROM diffs_v {_DIM_DIFFS}
  UNION ALL SELECT 'latency_p_value', y.v - x.v FROM {_sorted_sql(_DURATIONS["baseline"])} x JOIN {_sorted_sql(_DURATIONS["candidate"])} y USING (k)),
{_RANKS}, pv AS (SELECT {_P_COLUMNS} FROM ps), {_BOOTSTRAP}
SELECT n_samples::BIGINT AS n_samples, round(b, 6) AS baseline_avg_score, round(c, 6) AS candidate_avg_score, wb::BIGINT AS wins_baseline,
  wc::BIGINT AS wins_candidate, wt::BIGINT AS wins_tie, {_WILSON.format(p='(w / n)', sign='-')} AS win_low,
  {_WILSON.format(p='(w / n)', sign='+')} AS win_high, {_WINNER} AS winner, {_DIM_MEANS}, lbaseline.*, lcandidate.*,
  round(round(baseline_latency_avg, 1) / round(candidate_latency_avg, 1), 2) AS speed_ratio, pv.*, gap.* FROM h, lbaseline, lcandidate, pv, gap""")
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole summary but for its sentence, which tests compare; unrounded, as SQL has no rounding of binary values."""
    row = _whole_summary(spark, sf_dir)
    row = row.withColumns({f.name: F.round(f.name, 6) for f in row.schema if f.dataType.typeName() == "double"})
    return row.drop("winner_reason")


def _whole_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    sides = [docs.select(F.expr(f"({v.replace('::DOUBLE', 'D')})").alias("duration_ms")) for v in _DURATIONS.values()]
    return evaluation.whole_summary(spark, score_maps(docs), *sides, "doc_id", as_reported=False)


def _fixed(x: str, digits: int, sign: bool = False) -> str:
    return f"printf('%{'+' if sign else ''}.{digits}f', floor(({x}) * {10**digits}.0::DOUBLE + 0.5) / {10**digits}.0::DOUBLE)"


def _both(b: str, c: str, n: int) -> str:
    return f"{_fixed(b, n)} || ' -> ' || {_fixed(c, n)} || ' (' || {_fixed(f'{c} - {b}', n, True)} || ')'"


def _p_sql(name: str) -> str:
    return f"', p ' || CASE WHEN {name} IS NULL THEN 'n/a' WHEN {name} < 0.0001 THEN '<.0001' ELSE printf('%.4f', {name}) END"


_REASON = "CASE " + " ".join(
    f"WHEN candidate_{d} < 3 AND baseline_{d} >= 3 THEN 'Candidate fails critical dimension: {d}' WHEN baseline_{d} < 3 AND candidate_{d} >= 3 THEN 'Baseline fails critical dimension: {d}'"
    for d in verdicts.CRITICAL
) + """ WHEN winner = 'tie' THEN 'Scores within margin (baseline=' || round(baseline_avg_score, 1) || ', candidate=' || round(candidate_avg_score, 1) || ')'
  WHEN winner = 'candidate' THEN 'Candidate wins ' || round(candidate_avg_score, 1) || ' vs ' || round(baseline_avg_score, 1) || ' (+' || round(round(candidate_avg_score, 1) - round(baseline_avg_score, 1), 1) || ')'
  ELSE 'Baseline wins ' || round(baseline_avg_score, 1) || ' vs ' || round(candidate_avg_score, 1) || ' (+' || round(round(baseline_avg_score, 1) - round(candidate_avg_score, 1), 1) || ')' END"""
_REPORT = [
    "'small against big, samples: ' || n_samples",
    *(f"'{d} (weight {w}): ' || {_both(f'baseline_{d}', f'candidate_{d}', 2)} || {_p_sql(f'p_{d}')}" for d, w in verdicts.WEIGHTS.items()),
    f"'overall: ' || {_both('baseline_avg_score', 'candidate_avg_score', 1)} || {_p_sql('overall_p_value')}",
    f"'gap, 95% of resamples: ' || {_fixed('gap_low', 2, True)} || ' to ' || {_fixed('gap_high', 2, True)}",
    f"""'candidate wins: ' || {_fixed('wins_candidate * 100.0::DOUBLE / (wins_baseline + wins_candidate)', 0)} || '% of ' || (wins_baseline + wins_candidate)
      || ', 95% interval ' || {_fixed('win_low * 100', 0)} || '% to ' || {_fixed('win_high * 100', 0)} || '%, ties: ' || wins_tie""",
    *(f"""'latency {k}: ' || {_fixed(f'baseline_latency_{k}', 0)} || ' ms -> ' || {_fixed(f'candidate_latency_{k}', 0)} || ' ms, '
      || {_fixed(f'baseline_latency_{k} / candidate_latency_{k}', 1)} || 'x'""" for k in ("avg", "p50", "p90", "p99")),
    f"'latency' || {_p_sql('latency_p_value')} || ', speed ratio ' || {_fixed('speed_ratio', 2)}",
    f"'decision: ' || winner || '; ' || {_REASON}",
]


@query(f"SELECT unnest(range({len(_REPORT)}))::INT AS line, unnest([{', '.join(_REPORT)}]) AS text FROM ({SQL['eval_summary']}) s")
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report of an evaluation, line by line."""
    row = _whole_summary(spark, sf_dir)
    row = row.withColumns({f.name: F.round(f.name, 6) for f in row.schema if f.dataType.typeName() == "double"})
    return reports.evaluation_report(row, "small", "big")


# ---- registries, versions, streams ----

@query("""
WITH d AS (SELECT n_name AS key, 'common ' || n_nationkey AS value FROM nation WHERE n_nationkey % 5 = 0),
o AS (SELECT r_name AS section, n_name AS key, 'a=' || n_nationkey AS value FROM nation JOIN region ON r_regionkey = n_regionkey)
SELECT section, key, value FROM o UNION ALL
SELECT r_name, d.key, d.value FROM region, d WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.section = r_name AND o.key = d.key)
""")
def models_config_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with a section for every region, its nations as keys, some nations as defaults; written as a file and read."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    number = F.col("n_nationkey").cast("string")
    line = lambda text, at: (F.struct(*at).alias("at"), text.alias("value"))
    lead, zero = F.lit(-1).cast("long"), F.lit(0).cast("long")
    lines = [
        region.where("r_regionkey = 0").select(*line(F.lit("version = 1"), [lead - 1, zero])),
        region.where("r_regionkey = 0").select(*line(F.lit("[*]"), [lead, lead])),
        nation.where("n_nationkey % 5 = 0").select(*line(F.concat("n_name", F.lit(" = common "), number), [lead, F.col("n_nationkey").cast("long")])),
        region.select(*line(F.concat(F.lit("["), "r_name", F.lit("]")), [F.col("r_regionkey").cast("long"), lead])),
        nation.select(*line(F.concat(F.lit(" "), "n_name", F.lit(" = a="), number), [F.col("n_regionkey").cast("long"), F.col("n_nationkey").cast("long")])),
        nation.select(*line(F.concat(F.lit("; "), "n_name", F.lit(" = off")), [F.col("n_regionkey").cast("long"), F.lit(1000).cast("long")])),
    ]
    path = f"{work_folder(spark)}/models.ini"
    reduce(DataFrame.union, lines).orderBy("at").select("value").coalesce(1).write.text(path)  # a registry is one small file
    return text_source.read_ini(spark, path)


@query("""
WITH f AS (SELECT p_partkey % 5 AS stem, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size + 1 END AS v FROM part)
SELECT 'm' || stem AS stem, (coalesce(max(v), 0) + 1)::INT AS next_v FROM f GROUP BY stem
""")
def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next version of five stems whose files are named after parts, some with no number."""
    stem = F.concat(F.lit("m"), (F.col("p_partkey") % 5).cast("string"))
    version = F.when(F.col("p_size") % 4 == 0, F.lit(".vx.gguf")).otherwise(F.concat(F.lit(".v"), (F.col("p_size") + 1).cast("string"), F.lit(".gguf")))
    names = load(spark, sf_dir, "part").select(F.concat(stem, version).alias("name"))
    return reduce(DataFrame.union, (sinks.next_version(names, f"m{k}").select(F.lit(f"m{k}").alias("stem"), "next_v") for k in range(5)))


@query("SELECT false AS same_rows_changed, true AS fewer_rows_changed, count(*)::BIGINT AS n FROM documents")
def snapshot_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    first = sinks.content_hash(docs).select("n", F.col("hash").alias("a"))
    again = sinks.content_hash(docs.repartition(5, "source")).select(F.col("hash").alias("b"))
    fewer = sinks.content_hash(docs.where("doc_id > 0")).select(F.col("hash").alias("c"))
    row = first.crossJoin(F.broadcast(again)).crossJoin(F.broadcast(fewer))
    return row.select((F.col("a") != F.col("b")).alias("same_rows_changed"), (F.col("a") != F.col("c")).alias("fewer_rows_changed"), "n")


@query("SELECT DISTINCT event_id, event_type FROM events")
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream that repeats every row, deduplicated by key."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    one = stream.parquet(path if _is_folder(spark, path) else f"{sf_dir}/events.parquet*")
    twice = one.union(one)
    # both copies come in one batch, so keys need not be held longer than that
    kept = ingest.deduplicated(twice, "event_id", "ts", "1 day").select("event_id", "event_type")
    out = work_folder(spark)
    run = kept.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema("event_id long, event_type string").parquet(f"{out}/rows")


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def rendered_prompt() -> str:
    """The stand-ins' system prompt, for tests."""
    return PROMPT
