"""The steps that call a language model, each prompt, reply and parse as columns.

All take a responder; rows whose reply can't be used are kept out of the result
and counted by ``outcome``.  Write a step's result before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chat, text, verdicts
from ..sources.keyed_table import KeyedTable
from ..sources.work import stored, work_folder
from .dataset import synthetic_id, synthetic_rows
from .responders import Responder, mersenne_coin
from .select import needs_validation, pending
from .selection import numbered


def label_prompts(log: DataFrame, template: str) -> DataFrame:
    """Log rows with a transcript, and their prompt."""
    parts = chat.components("raw_request_json")
    prompt = text.render(template, **chat.with_fallbacks(parts))
    return log.where(parts["transcript"] != "").withColumn("prompt", prompt)


def label(log: DataFrame, responder: Responder, template: str, model: str) -> DataFrame:
    """Labelled rows of log rows, in the layout of the labelled table."""
    answered = responder.respond(label_prompts(log, template), "prompt")
    return answered.where(F.coalesce("reply", F.lit("")) != "").select(
        "request_id", "timestamp", F.lit(model).alias("model_used_for_label"), F.col("model").alias("original_model"),
        "raw_request_json", F.col("response_text").alias("original_response"), text.strip("reply").alias("label"),
        *(c for c in ("pos",) if c in log.columns),
    )


def validate(rows: DataFrame, responder: Responder, template: str, vocabulary: str) -> DataFrame:
    """(request_id, validation) of labelled rows; the vocabulary is the shared one, not the row's."""
    parts = chat.with_fallbacks(chat.components("raw_request_json"))
    parts |= {"custom_vocabulary": F.lit(vocabulary), "label": F.col("label")}
    usable = rows.where((parts["transcript"] != "") & (F.coalesce("label", F.lit("")) != ""))
    answered = responder.respond(usable.withColumn("prompt", text.render(template, **parts)), "prompt")
    return answered.where("reply is not null").select("request_id", verdicts.verdict("reply").alias("validation"))


def generate(assigned: DataFrame, responder: Responder, template: str, system_prompt: str, vocabulary: str, model: str) -> DataFrame:
    """Synthetic labelled rows of assignments (index, and the template's columns)."""
    values = {c: F.col(c).cast("string") for c in assigned.columns} | {"custom_vocabulary": F.lit(vocabulary)}
    answered = responder.respond(assigned.withColumn("prompt", text.render(template, **values)), "prompt")
    return synthetic_rows(answered, "reply", system_prompt, vocabulary, model)


def blind_order(samples: DataFrame, seed: int = 42) -> DataFrame:
    """Whether output a is the baseline's: a coin of the sample's index, whatever seed the caller uses elsewhere."""
    return samples.withColumn("a_is_baseline", mersenne_coin(F.col("sample_index") + seed))


def judge(samples: DataFrame, responder: Responder, template: str, attempts: int = 2, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Scores (sample_index, baseline_scores, candidate_scores) of samples with both
    outputs, and the replies (sample_index, attempt, raw_response) that don't parse.

    Only rows whose reply doesn't parse are asked about again; a failed call,
    with an empty reply, is not.  Each attempt's replies are written to the
    ``folder``, by default a new one, before they are used, so that no call is
    made twice.
    """
    folder = folder or work_folder(samples.sparkSession)
    first = F.col("a_is_baseline")
    values = {
        "raw_transcript": F.col("raw_transcript"), "gold_label": F.col("gold_label"), "custom_vocabulary": F.col("custom_vocabulary"),
        "output_a": F.when(first, F.col("baseline_output")).otherwise(F.col("candidate_output")),
        "output_b": F.when(first, F.col("candidate_output")).otherwise(F.col("baseline_output")),
    }
    rows = blind_order(samples).withColumn("prompt", text.render(template, **values))
    columns, done, failed = rows.columns, [], []
    for k in range(attempts):
        answered = responder.respond(rows, "prompt").where(F.coalesce("reply", F.lit("")) != "").select(*columns, "reply")
        answered = stored(answered, f"{folder}/attempt{k}")
        parsed = answered.withColumn("parsed", verdicts.judge_reply("reply"))
        scores = verdicts.map_back(first, F.col("parsed"))
        done.append(parsed.where("parsed is not null").select("sample_index", *(c.alias(n) for n, c in scores.items())))
        bad = parsed.where("parsed is null")
        failed.append(bad.select("sample_index", F.lit(k).alias("attempt"), F.col("reply").alias("raw_response")))
        rows = bad.select(*columns)
    return reduce(DataFrame.unionAll, done), reduce(DataFrame.unionAll, failed)


def run_step(table: KeyedTable, rows: DataFrame, work: Callable[[DataFrame], DataFrame], rows_at_once: int = 0, folder: str | None = None) -> dict[str, int]:
    """Work through rows with a position (the table's order column), part by part, and save each part by key.

    ``work`` gives rows of the table; columns that it lacks are null.  Every part
    becomes a version of the table, so a step that is stopped has lost one part
    at most, and the next run, which selects what the table still lacks, goes on
    from there.  Rows that ``work`` leaves out are errors, to be tried by the
    next run.  ``rows_at_once`` 0 makes one part.  Gives counts: given, done,
    errors, total.
    """
    folder = folder or work_folder(rows.sparkSession)
    placed = stored(numbered(rows, [table.order], "_place", f"{folder}/order"), f"{folder}/rows")
    given, done = placed.count(), 0
    for k in range(-(-given // (rows_at_once or max(1, given)))):
        part = placed.where(F.floor(F.col("_place") / (rows_at_once or given)) == k).drop("_place")
        made = work(part)
        whole = made.select(*(F.col(f.name) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema))
        kept = stored(whole, f"{folder}/part{k}")  # calls are made once
        done += kept.count()
        table.apply(kept)
        table.vacuum(keep=2)
    return {"given": given, "done": done, "errors": given - done, "total": table.read().count()}


def label_into(
    table: KeyedTable, log: DataFrame, responder: Responder, template: str, model: str, rows_at_once: int = 0, force: bool = False, folder: str | None = None
) -> dict[str, int]:
    """Label the log rows (with pos) that a keyed table of labelled rows lacks; all of them with ``force``."""
    rows = pending(log, table.read(), force=force)
    return run_step(table, rows, lambda part: label(part, responder, template, model), rows_at_once, folder)


def validate_into(table: KeyedTable, responder: Responder, template: str, vocabulary: str, rows_at_once: int = 0, folder: str | None = None) -> dict[str, int]:
    """Review the labelled rows of a keyed table that have no verdict yet."""

    def work(part: DataFrame) -> DataFrame:
        verdict = validate(part, responder, template, vocabulary)
        return part.drop("validation").join(verdict, table.key)

    return run_step(table, needs_validation(table.read()), work, rows_at_once, folder)


def generate_into(
    table: KeyedTable, assigned: DataFrame, responder: Responder, template: str, system_prompt: str, vocabulary: str, model: str,
    rows_at_once: int = 0, folder: str | None = None,
) -> dict[str, int]:
    """Generate the synthetic rows of assignments (index, and the template's columns) that a keyed table lacks."""
    made = assigned.withColumns({table.key: synthetic_id(F.col("index")), table.order: F.col("index").cast("long")})
    rows = pending(made, table.read(), table.key)

    def work(part: DataFrame) -> DataFrame:
        new = generate(part.drop(table.key, table.order), responder, template, system_prompt, vocabulary, model)
        return new.join(part.select(table.key, table.order), table.key)

    return run_step(table, rows, work, rows_at_once, folder)


def outcome(given: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """One row (given, done, errors) of a step."""
    joined = given.select(key).join(got.select(key, F.lit(1).alias("_done")), key, "left")
    return joined.agg(F.count("*").alias("given"), F.count("_done").alias("done"), F.count_if(F.col("_done").isNull()).alias("errors"))


def preview(rows: DataFrame, prompt: str = "prompt", chars: int = 500) -> DataFrame:
    """A dry run: the first characters of each prompt, nothing called."""
    return rows.withColumn(prompt, F.substring(prompt, 1, chars))
