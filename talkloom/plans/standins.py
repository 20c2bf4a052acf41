"""Request log, labelled rows and scores derived from the driver's tables, in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat, verdicts
from ..functions.text import md5_int
from ..sources.work import work_folder  # noqa: F401  (queries take it from here)

PROMPT = "<SYSTEM_INSTRUCTIONS>\nKeep the meaning; <CUSTOM_VOCABULARY>names</CUSTOM_VOCABULARY> may follow.\n</SYSTEM_INSTRUCTIONS>"
MODEL = "small-chat"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log row for every user turn that an assistant turn follows."""
    turns = load(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    reply = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answered"))
    system = turns.where("role = 'system' and turn = 0").select("conv_id", F.col("text").alias("window"))
    rows = user.join(reply, ["conv_id", "turn"]).join(system, "conv_id", "left")
    vocabulary = F.concat(F.lit("term "), F.col("turn").cast("string"))
    content = chat.system_text(F.lit(PROMPT), F.coalesce("window", F.lit("")), vocabulary)
    return rows.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        "conv_id",
        "turn",
        chat.envelope(content, chat.transcript_text(F.col("asked")), MODEL).alias("raw_request_json"),
        F.col("answered").alias("response_text"),
        F.lit(True).alias("request_json_valid"),
        (F.col("turn") % 4 != 2).alias("response_json_valid"),
    )


LOG_SQL = """
log_v AS (
  SELECT u.conv_id || '-' || u.turn AS request_id, u.conv_id, u.turn, u.text AS asked, coalesce(s.text, '') AS window_text,
         a.text AS response_text, true AS request_json_valid, u.turn % 4 <> 2 AS response_json_valid
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
  WHERE u.role = 'user')
"""


def labeled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows whose review follows the labels table."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    number = F.col("doc_id").cast("string")
    reply = (
        F.when(F.col("quality") == 1, F.lit("PASS"))
        .when(F.col("toxic") == 1, F.concat(F.lit("FAIL HALLUCINATION: doc "), number))
        .otherwise(F.concat(F.lit("FAIL OVER_DELETION: doc "), number))
    )
    rows = docs.join(labels, "doc_id").withColumn("reply", reply)
    checked = F.when(F.col("doc_id") % 5 != 0, verdicts.verdict("reply"))
    return rows.select(
        "doc_id", number.alias("request_id"), F.col("text").alias("label"), "reply", checked.alias("validation"),
        (F.col("doc_id") % 3 != 0).alias("manually_reviewed"),
    )


LABELED_SQL = """
labeled_v AS (
  SELECT d.doc_id, d.doc_id::VARCHAR AS request_id, d.text AS label, d.doc_id % 3 <> 0 AS manually_reviewed,
         CASE WHEN d.doc_id % 5 = 0 THEN NULL WHEN quality = 1 THEN 'pass' ELSE 'fail' END AS status,
         CASE WHEN d.doc_id % 5 = 0 OR quality = 1 THEN NULL WHEN toxic = 1 THEN 'HALLUCINATION' ELSE 'OVER_DELETION' END AS type,
         CASE WHEN d.doc_id % 5 = 0 OR quality = 1 THEN NULL ELSE 'doc ' || d.doc_id END AS reason
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""


def score(side: str, dim: str) -> Column:
    number = md5_int(F.concat(F.col("doc_id").cast("string"), F.lit(f":{dim}:{side}"))) % 5 + 1
    missing = (F.col("doc_id") % 17 == 0) & F.lit(dim in ("conciseness", "filler_removal"))
    return F.when(~missing, number.cast("double"))


def score_maps(docs: DataFrame) -> DataFrame:
    """(doc_id, baseline_scores, candidate_scores), some scores missing."""
    sides = {
        f"{side}_scores": F.map_filter(
            F.map_from_arrays(F.array(*map(F.lit, verdicts.WEIGHTS)), F.array(*(score(side, d) for d in verdicts.WEIGHTS))),
            lambda k, v: v.isNotNull(),
        )
        for side in ("baseline", "candidate")
    }
    return docs.select("doc_id", *(c.alias(k) for k, c in sides.items()))


def _score_sql(side: str, dim: str) -> str:
    number = f"1 + ('0x' || substr(md5(doc_id || ':{dim}:{side}'), 1, 8))::BIGINT % 5"
    return f"CASE WHEN doc_id % 17 = 0 THEN 3 ELSE {number} END" if dim in ("conciseness", "filler_removal") else number


SCORES_SQL = (
    "scores_v AS (SELECT doc_id, "
    + ", ".join(f"({_score_sql(s, d)})::DOUBLE AS {s}_{d}" for s in ("baseline", "candidate") for d in verdicts.WEIGHTS)
    + " FROM documents),\nweighted_v AS (SELECT *, "
    + ", ".join(
        "round((" + " + ".join(f"{s}_{d} * {w}" for d, w in verdicts.WEIGHTS.items()) + f") / 65 * 100, 1) AS {s}_weighted"
        for s in ("baseline", "candidate")
    )
    + " FROM scores_v),\ndiffs_v AS (SELECT row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS pos, candidate_weighted - baseline_weighted AS d FROM weighted_v)\n"
)
