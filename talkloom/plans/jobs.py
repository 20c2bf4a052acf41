"""Queries of whole jobs: files written from the driver's tables and read back, streams, and steps with responders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import chat, text, verdicts
from ..operators import dataset, evaluation, reports, responders, select, selection, upsert, workflow
from ..sources import jsonl, sinks
from ..sources import text as text_source
from ..sources.keyed_table import KeyedTable
from ..sources.work import stored
from ..streaming import ingest
from .parity import _STRIP, query
from .standins import LABELED_SQL, LOG_SQL, PROMPT, labeled_rows, load, log_rows, work_folder

# ---- scans ----

_LINES_SQL = """lines_v AS (SELECT doc_id, source AS request_id, n_chars::VARCHAR AS label FROM documents
  WHERE doc_id % 10 NOT IN (3, 5, 7, 8))"""


def _lines(spark: SparkSession, sf_dir: str) -> str:
    """A file of labelled rows in order of doc_id, with broken, blank, foreign and keyless lines."""
    row = F.to_json(F.struct(F.col("source").alias("request_id"), F.col("n_chars").cast("string").alias("label")))
    line = (
        F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit('{"request_id": "'), "source"))
        .when(F.col("doc_id") % 10 == 5, F.lit(" \t "))
        .when(F.col("doc_id") % 10 == 7, F.lit('["request_id"]'))
        .when(F.col("doc_id") % 10 == 8, F.lit('{"label": "no key"}'))
        .otherwise(row)
    )
    path = f"{work_folder(spark)}/labelled"
    load(spark, sf_dir, "documents").orderBy("doc_id").select(line.alias("value")).write.text(path)
    return path


@query(f"WITH {_LINES_SQL} SELECT request_id, arg_max(label, doc_id) AS label FROM lines_v GROUP BY request_id")
def keyed_scan_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.scan_keyed(spark, _lines(spark, sf_dir)).select("request_id", "label")


@query(f"""WITH {_LINES_SQL} SELECT request_id, label, count(*)::BIGINT AS n FROM (
  SELECT request_id, label FROM lines_v UNION ALL SELECT NULL, 'no key' FROM documents WHERE doc_id % 10 = 8) GROUP BY ALL""")
def lenient_scan_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jsonl.scan_lenient(spark, _lines(spark, sf_dir), "request_id string, label string")
    return rows.groupBy("request_id", "label").agg(F.count("*").alias("n"))


@query("SELECT source, count(*)::BIGINT AS n FROM documents WHERE doc_id % 10 <> 5 GROUP BY source")
def lines_of_several_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank lines of a list of paths, one of them read as part of a folder."""
    base, docs = work_folder(spark), load(spark, sf_dir, "documents")
    value = F.when(F.col("doc_id") % 10 == 5, F.lit(" \t")).otherwise(F.to_json(F.struct("source")))
    for k in range(2):
        docs.where(F.col("doc_id") % 2 == k).select(value.alias("value")).write.text(f"{base}/{k}")
    rows = jsonl.scan_lenient(spark, [f"{base}/0", f"{base}/1"], "source string")
    return rows.groupBy("source").agg(F.count("*").alias("n"))


@query(f"WITH {LOG_SQL} SELECT request_id, response_text FROM log_v WHERE request_json_valid AND response_json_valid")
def strict_log_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/log"
    sinks.append_json(log_rows(spark, sf_dir).drop("conv_id", "turn"), path)
    return jsonl.scan_log(spark, path).select("request_id", "response_text")


@query(f"WITH {LABELED_SQL} SELECT request_id, label, status, type, reason FROM labeled_v WHERE manually_reviewed")
def reviewed_rows_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/labelled"
    sinks.append_json(labeled_rows(spark, sf_dir).drop("doc_id", "reply"), path)
    return jsonl.scan_reviewed(spark, path, reviewed_only=True).select("request_id", "label", "validation.*")


_SAMPLES_SQL = f"""samples_v AS (SELECT request_id, {_STRIP.format('asked')} AS a, {_STRIP.format('response_text')} AS r FROM log_v)"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = chat.components("raw_request_json")
    none = F.lit("")
    user = chat.user_message(none, none, none, parts["transcript"])
    return log_rows(spark, sf_dir).select(chat.chat_messages(F.col("request_id"), user, text.strip("response_text")).alias("messages"))


@query(f"""WITH {LOG_SQL}, {_SAMPLES_SQL} SELECT request_id,
  '<TRANSCRIPT>' || chr(10) || a || chr(10) || '</TRANSCRIPT>' AS user_text, r AS answer FROM samples_v""")
def chat_samples_of_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both split files, written and read again by the strict loader."""
    base = work_folder(spark)
    samples = _samples(spark, sf_dir).withColumn("part", F.md5(F.to_json("messages")) < "2")
    sinks.write_splits(samples.where("not part").drop("part"), samples.where("part").drop("part"), base)
    rows = jsonl.scan_chat_samples(spark, [f"{base}/train", f"{base}/eval"])
    content = lambda i: F.col("messages")[i]["content"][0]["text"]
    return rows.select(content(0).alias("request_id"), content(1).alias("user_text"), content(2).alias("answer"))


@query(f"WITH {LOG_SQL}, {_SAMPLES_SQL} SELECT a AS raw_transcript, '' AS custom_vocabulary, r AS gold_label FROM samples_v")
def eval_samples_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/eval"
    sinks.append_json(_samples(spark, sf_dir), path)
    return jsonl.scan_eval_samples(spark, path).select("raw_transcript", "custom_vocabulary", "gold_label")


@query("SELECT string_agg(name || chr(10), '' ORDER BY r_regionkey) AS whole, rtrim(string_agg(name || chr(10), '' ORDER BY r_regionkey), chr(10)) AS trimmed FROM (SELECT r_regionkey, r_name AS name FROM region)")
def whole_text_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of a few lines as one text, and without its outer white space; the text stays a column."""
    base = work_folder(spark)
    load(spark, sf_dir, "region").orderBy("r_regionkey").select("r_name").coalesce(1).write.text(base)
    return text_source.whole_texts(spark, f"{base}/*.txt").select(F.col("text").alias("whole"), text.strip("text").alias("trimmed"))


# ---- sinks and streams ----


@query("""SELECT doc_id::INT AS sample_index, n_chars / 4.0::DOUBLE AS baseline_weighted,
  (SELECT count(*) FROM documents)::BIGINT AS n_samples FROM documents""")
def results_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, docs = work_folder(spark), load(spark, sf_dir, "documents")
    detail = docs.select(F.col("doc_id").cast("int").alias("sample_index"), (F.col("n_chars") / 4).alias("baseline_weighted"))
    stamp = text.compact_stamp(F.lit("2020-01-02 03:04:05").cast("timestamp"))
    name = spark.range(1).select(stamp.alias("x")).first()["x"]
    sinks.write_results(detail, detail.agg(F.count("*").alias("n_samples")), base, name)
    back = spark.read.schema("sample_index int, baseline_weighted double").json(f"{base}/20200102_030405_detail")
    one = spark.read.schema("n_samples long").json(f"{base}/20200102_030405_summary")
    return back.crossJoin(F.broadcast(one))


@query(f"WITH {LOG_SQL} SELECT request_id, response_text FROM log_v")
def log_capture_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log appended by two runs of the stream, the second resuming where the first ended."""
    base = work_folder(spark)
    rows = log_rows(spark, sf_dir)
    for even in (True, False):
        sinks.append_json(rows.where((F.col("turn") % 4 == 0) == F.lit(even)).drop("conv_id", "turn"), f"{base}/in")
        ingest.append_log(ingest.read_log_stream(spark, f"{base}/in"), f"{base}/log", f"{base}/state").awaitTermination()
    return jsonl.scan_strict(spark, f"{base}/log", "request_id string, response_text string")


@query("SELECT source AS request_id, max(doc_id)::BIGINT AS pos, arg_max(n_chars, doc_id)::BIGINT AS v FROM documents GROUP BY source")
def current_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table kept current over two runs of a stream of changes."""
    base, docs = work_folder(spark), load(spark, sf_dir, "documents")
    half = docs.agg((F.max("doc_id") / 2).alias("h")).first()["h"] or 0
    schema = "request_id string, pos long, v long"
    changes = docs.select(F.col("source").alias("request_id"), F.col("doc_id").alias("pos"), F.col("n_chars").alias("v"))
    table = KeyedTable(spark, f"{base}/table", schema)
    for part in (F.col("pos") <= half, F.col("pos") > half):
        sinks.append_json(changes.where(part), f"{base}/in")
        stream = spark.readStream.schema(schema).json(f"{base}/in")
        ingest.keep_current(stream, table, f"{base}/state").awaitTermination()
    # the position of a key is its first one; what is compared is that of its last change
    last = changes.groupBy("request_id").agg(F.max("pos").alias("pos"))
    return table.read().drop("pos").join(last, "request_id").select("request_id", "pos", "v")


@query("""SELECT time_bucket(INTERVAL '10 minutes', ts::TIMESTAMP) AS start, event_type, count(*)::BIGINT AS n, round(avg(value), 6) AS mean
FROM events GROUP BY ALL""")
def windowed_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.windowed_latency(load(spark, sf_dir, "events"), "ts", "value", "event_type")
    return rows.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("mean", 6).alias("mean"))


@query("""WITH f AS (SELECT 'm' || p_partkey % 5 AS stem, p_size, p_partkey FROM part)
SELECT stem || '.gguf' AS name, stem || '.v' || (max(CASE WHEN p_size % 3 = 1 THEN p_size ELSE 0 END) + 1) || '.gguf' AS backup
FROM f GROUP BY stem HAVING max(CASE WHEN p_size % 3 = 0 AND p_partkey % 5 <> 2 THEN 1 ELSE 0 END) = 1""")
def versioned_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backups of five stems' current files, if they have one; files are named after parts: current, versioned, full precision."""
    stem, size = F.concat(F.lit("m"), (F.col("p_partkey") % 5).cast("string")), F.col("p_size")
    kind = F.when((size % 3 == 0) & (F.col("p_partkey") % 5 != 2), F.lit("")).when(size % 3 == 1, F.concat(F.lit(".v"), size.cast("string"))).otherwise(F.lit("-BF16"))
    names = load(spark, sf_dir, "part").select(F.concat(stem, kind, F.lit(".gguf")).alias("name"))
    return reduce(DataFrame.union, (sinks.backup_name(names, f"m{k}") for k in range(5)))


# ---- selection, rows, reports ----


@query(f"WITH {LOG_SQL} SELECT request_id FROM log_v WHERE starts_with(request_id, '1')")
def forced_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ids, force takes rows that are done already."""
    rows = log_rows(spark, sf_dir).withColumn("pos", F.struct("conv_id", "turn"))
    return select.select_for_labelling(rows, rows, ["1"], force=True, shuffle=False, top=0, limit=0).select("request_id")


@query(f"WITH {LOG_SQL} SELECT request_id FROM log_v WHERE turn % 4 <> 0")
def force_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_rows(spark, sf_dir).withColumn("pos", F.struct("conv_id", "turn"))
    done = rows.where("turn % 4 = 0")
    return select.select_for_labelling(rows, done, [], force=True, shuffle=True, top=0, limit=0).select("request_id")


@query(f"""WITH {LABELED_SQL}, f AS (SELECT request_id, coalesce(type, 'UNKNOWN') AS type, reason FROM labeled_v WHERE status = 'fail' AND NOT manually_reviewed)
SELECT type, count(*) OVER (PARTITION BY type)::BIGINT AS n, request_id, reason FROM f""")
def failure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.failure_listing(select.open_failures(labeled_rows(spark, sf_dir)))


@query(f"""WITH {LABELED_SQL}, f AS (SELECT doc_id, request_id, coalesce(type, 'UNKNOWN') AS type, reason FROM labeled_v WHERE status = 'fail' AND NOT manually_reviewed)
SELECT row_number() OVER (ORDER BY type, doc_id) - 1 AS line, type, count(*) OVER (PARTITION BY type)::BIGINT AS n, request_id, reason FROM f""")
def failure_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing in its order: by type, then as the rows stand."""
    return reports.failure_listing(select.open_failures(labeled_rows(spark, sf_dir)), order="doc_id")


@query("""WITH c AS (SELECT len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '')) AS words FROM documents),
g AS (SELECT CASE WHEN words < 50 THEN 0 WHEN words < 100 THEN 1 WHEN words < 200 THEN 2 WHEN words < 500 THEN 3 ELSE 4 END AS k, count(*) AS n FROM c GROUP BY 1)
SELECT bucket, rpad(bucket, 14, ' ') || '  ' || lpad(format('{:,}', coalesce(n, 0)), 10, ' ') || ' (' || printf('%5.1f', coalesce(n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM c)) || '%)' AS text
FROM (VALUES (0, '0-50 words'), (1, '50-100 words'), (2, '100-200 words'), (3, '200-500 words'), (4, '500+ words')) b(k, bucket) LEFT JOIN g USING (k)""")
def length_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = load(spark, sf_dir, "documents").select(text.word_count("text").alias("words"))
    return reports.distribution_report(dataset.length_distribution(spark, counts), ["n"])


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'n/a   ' WHEN event_id % 3 = 1 THEN '<.0001' ELSE printf('%.4f', (event_id % 16) / 16.0::DOUBLE + 0.0001) END AS p FROM events")
def p_value_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.expr("case event_id % 3 when 1 then 0.00009D when 2 then (event_id % 16) / 16.0D + 0.0001D end")
    return load(spark, sf_dir, "events").select("event_id", verdicts.p_text(p).alias("p"))


@query("SELECT doc_id, coalesce(source, '') || '�' || coalesce(lang, '') AS repaired FROM documents")
def repaired_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.coalesce("source", F.lit("")).cast("binary"), F.unhex(F.lit("ff")), F.coalesce("lang", F.lit("")).cast("binary"))
    return load(spark, sf_dir, "documents").select("doc_id", text.valid_utf8(raw).alias("repaired"))


@query("""SELECT conv_id, turn, 0::INT AS place, 'system' AS message_role, role AS content FROM conversations
UNION ALL SELECT conv_id, turn, 1, 'user', coalesce(text, '') FROM conversations""")
def plain_chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", chat.plain_messages(F.col("role"), F.coalesce("text", F.lit(""))).alias("m"))
    return rows.select("conv_id", "turn", F.posexplode("m").alias("place", "x")).select("conv_id", "turn", "place", F.col("x.role").alias("message_role"), "x.content")


@query(r"""WITH w AS (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS n FROM conversations)
SELECT a.conv_id, a.turn, CASE WHEN b.n > 0 THEN round(a.n / b.n::DOUBLE, 9) END AS ratio FROM w a JOIN w b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1""")
def reply_word_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    before = rows.select("conv_id", (F.col("turn") + 1).cast("int").alias("turn"), F.col("text").alias("given"))
    return rows.join(before, ["conv_id", "turn"]).select("conv_id", "turn", F.round(text.word_ratio("text", "given"), 9).alias("ratio"))


@query(f"""WITH {LABELED_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM labeled_v WHERE doc_id % 3 <> 1)
SELECT k::BIGINT AS sample_index, label AS gold_label, 'b' || doc_id AS baseline_output, 'c' || doc_id AS candidate_output,
       doc_id / 2.0::DOUBLE AS baseline_duration_ms, 20.0::DOUBLE AS candidate_weighted FROM r""")
def detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples, outputs and judgments joined by index; samples without judgment go."""
    rows = labeled_rows(spark, sf_dir).withColumn("sample_index", F.col("doc_id"))
    samples = rows.select("sample_index", F.col("label").alias("raw_transcript"), F.col("label").alias("gold_label"))
    out = lambda side: rows.select("sample_index", F.concat(F.lit(side), "doc_id").alias("text"), (F.col("doc_id") / 2).alias("duration_ms"))
    ones = F.map_from_arrays(F.array(*map(F.lit, verdicts.WEIGHTS)), F.array(*(F.lit(1.0) for _ in verdicts.WEIGHTS)))
    judged = rows.where("doc_id % 3 <> 1").select("sample_index", ones.alias("baseline_scores"), ones.alias("candidate_scores"))
    kept = ("sample_index", "gold_label", "baseline_output", "candidate_output", "baseline_duration_ms", "candidate_weighted")
    return evaluation.detail(samples, out("b"), out("c"), judged).select(*kept)


# ---- steps with responders ----


@query(f"""WITH {LOG_SQL}, t AS (SELECT *, {_STRIP.format('asked')} AS a FROM log_v)
SELECT request_id, 'big' AS model_used_for_label, response_text AS original_response, 'reply to ' || a AS label FROM t WHERE a <> ''""")
def labelled_by_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies from a table of prompts, one for each distinct prompt."""
    log = log_rows(spark, sf_dir).withColumns({"timestamp": F.lit("t"), "model": F.lit("m")})
    prompts = workflow.label_prompts(log, "{transcript}").select("prompt").distinct()
    replies = prompts.select(responders.prompt_key(F.col("prompt"), "big").alias("key"), F.concat(F.lit(" reply to "), "prompt").alias("reply"), F.lit(1.0).alias("duration_ms"))
    rows = workflow.label(log, responders.Replay(replies, "big"), "{transcript}", "big")
    return rows.select("request_id", "model_used_for_label", "original_response", "label")


@query(f"""WITH {LOG_SQL}, t AS (SELECT *, {_STRIP.format('asked')} AS a, dense_rank() OVER (ORDER BY conv_id) AS c FROM log_v)
SELECT request_id, 'big' AS model_used_for_label, 'reply to ' || a AS label, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM t WHERE a <> ''""")
def labelled_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelling step in four parts: the first run has replies to some prompts only, the second goes on with the rest."""
    base = work_folder(spark)
    log = log_rows(spark, sf_dir).withColumns({"timestamp": F.lit("t"), "model": F.lit("m")})
    log = stored(selection.numbered(log, ["conv_id", "turn"], "pos"), f"{base}/log")
    prompts = workflow.label_prompts(log, "{transcript}").select("prompt").distinct()
    replies = prompts.select(responders.prompt_key(F.col("prompt"), "big").alias("key"), F.concat(F.lit(" reply to "), "prompt").alias("reply"), F.lit(1.0).alias("duration_ms"))
    table = KeyedTable(spark, f"{base}/table", f"{schemas.LABELED}, pos long", buckets=8)
    part = max(1, log.count() // 4)
    for some in (replies.where("key < '8'"), replies):
        workflow.label_into(table, log.drop("conv_id", "turn"), responders.Replay(some, "big"), "{transcript}", "big", rows_at_once=part)
    return table.read().select("request_id", "model_used_for_label", "label", "pos")


def _answer(prompt: str) -> str:
    if prompt.endswith("7"):
        raise ValueError("refused")
    return f"<{prompt}>"


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN '' ELSE '<' || doc_id || '>' END AS reply, CASE WHEN doc_id % 10 = 7 THEN 'refused' END AS error, doc_id % 10 <> 7 AS timed FROM documents")
def called_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("prompt"))
    answered = responders.Call(_answer).respond(rows, "prompt")
    return answered.select("doc_id", "reply", "error", (F.col("duration_ms") > 0).alias("timed"))


_JUDGED_SQL = """j AS (SELECT doc_id, doc_id % 5 + 1 AS b, doc_id % 4 + 1 AS c FROM documents)"""


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Samples whose judge replies at once, at the second attempt, never, or whose call fails."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_index"))
    n = F.col("sample_index")
    samples = docs.select(
        "sample_index", n.cast("string").alias("raw_transcript"), F.lit("").alias("gold_label"), F.lit("").alias("custom_vocabulary"),
        F.concat(F.lit("b"), (n % 5 + 1).cast("string")).alias("baseline_output"), F.concat(F.lit("c"), (n % 4 + 1).cast("string")).alias("candidate_output"),
    )
    return workflow.judge(samples, _Judge(), "{raw_transcript} {output_a} {output_b}", folder=work_folder(spark))


class _Judge:
    """Replies as the prompt's sample number asks for: by number mod 7, and by attempt."""

    def __init__(self):
        self.attempt = 0

    def respond(self, rows: DataFrame, prompt: str) -> DataFrame:
        n = F.col("sample_index") % 7
        score = lambda k: F.concat(F.lit('{"meaning_preservation": '), F.substring(F.split(prompt, " ")[k], 2, 9), F.lit("}"))
        good = F.concat(F.lit('```json\n{"output_a": '), score(1), F.lit(', "output_b": '), score(2), F.lit("}\n```"))
        bad = F.concat(F.lit(f"attempt {self.attempt} of "), F.col("sample_index").cast("string"))
        self.attempt += 1
        never, later = n == 0, (n == 1) & F.lit(self.attempt == 1)
        reply = F.when(n == 2, F.lit("")).when(never | later, bad).otherwise(good)
        return rows.withColumns({"reply": reply, "duration_ms": F.lit(1.0)})


@query(f"WITH {_JUDGED_SQL} SELECT doc_id AS sample_index, b::DOUBLE AS baseline, c::DOUBLE AS candidate FROM j WHERE doc_id % 7 NOT IN (0, 2)")
def judged_with_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = _judged(spark, sf_dir)
    one = lambda side: F.col(f"{side}_scores")["meaning_preservation"].alias(side)
    return scores.select("sample_index", one("baseline"), one("candidate"))


@query("""SELECT doc_id::INT AS sample_index, k::INT AS attempt, 'attempt ' || k || ' of ' || doc_id AS raw_response
FROM documents, (VALUES (0), (1)) t(k) WHERE doc_id % 7 = 0 OR (doc_id % 7 = 1 AND k = 0)""")
def failed_judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that don't parse, as logged and read again."""
    path = f"{work_folder(spark)}/errors"
    sinks.failed_replies(_judged(spark, sf_dir)[1], path)
    return jsonl.scan_strict(spark, path, "sample_index int, attempt int, raw_response string")


@query("""SELECT printf('syn-%03d', doc_id) AS request_id, 'm' AS model_used_for_label, 'synthetic' AS original_model, '' AS original_response,
  'raw ' || source AS transcript, ['Editor - notes', 'Terminal - shell', 'Browser - mail', 'Chat - team', 'Player - review'][doc_id % 5 + 1] AS window_context,
  'words' AS custom_vocabulary, 'clean ' || source AS label FROM documents WHERE doc_id % 3 <> 2""")
def synthetic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = F.when(F.col("doc_id") % 3 != 2, F.concat(F.lit("<CLEAN_TRANSCRIPT>clean "), "source", F.lit("</CLEAN_TRANSCRIPT>"))).otherwise("")
    reply = F.concat(F.lit("<RAW_TRANSCRIPT> raw "), "source", F.lit(" </RAW_TRANSCRIPT>"), clean)
    assigned = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("index"), reply.alias("reply"))
    rows = dataset.synthetic_rows(assigned, "reply", PROMPT, "words", "m")
    parts = chat.components("raw_request_json")
    kept = ("transcript", "window_context", "custom_vocabulary")
    return rows.select("request_id", "model_used_for_label", "original_model", "original_response", *(parts[k].alias(k) for k in kept), "label")


@query("SELECT count(*)::BIGINT AS given, (count(*) FILTER (doc_id % 3 <> 2))::BIGINT AS done, (count(*) FILTER (doc_id % 3 = 2))::BIGINT AS errors FROM documents")
def step_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return workflow.outcome(docs, docs.where("doc_id % 3 <> 2"), "doc_id")


@query("SELECT doc_id, left('Say: ' || text, 500) AS prompt FROM documents")
def dry_run_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dry run shows; the original's previews have 500 characters too."""
    rows = load(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Say: "), "text").alias("prompt"))
    return workflow.preview(rows)


@query(f"WITH {LABELED_SQL} SELECT request_id, label, true AS manually_reviewed FROM labeled_v")
def marked_as_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.mark_reviewed(labeled_rows(spark, sf_dir))[0].select("request_id", "label", "manually_reviewed")
