"""The operators' queries over the tables of a data folder, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, decontaminate, exact_dedup, fill_middle, fingerprint, langid, license_scan, ngram_join, quality, ranked_search, url_filter, warc
from .common import shared_folder, table



def tokenizer_folder() -> str:
    """Folder of the public tokenizers' files, also where their package can't be imported."""
    try:
        import public_tokenizers
    except ImportError:
        return "/opt/tokenizers"
    return os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


TOKENIZERS = tokenizer_folder()
URL_RULES = [
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
]


def held_out() -> F.Column:
    """Documents that no language is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("expressions", F.concat_ws("; ", "expressions"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    folder = shared_folder(spark)
    chats = chat_format.format_chats(chat_format.chain_messages(rows, folder), folder=folder)
    return chat_format.digests(chats)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.fit(docs.where(~held_out()))
    return langid.predict(docs, trees, keep={"held_out": held_out()})


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=["doc_id"])


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_near_class(fingerprint.fingerprint_documents(table(spark, sf_dir, "documents")))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    back = fill_middle.restored("output", "form")["restored_sha256"].alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", back)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which a window's words all stand within one place of where the phrase has them."""
    return decontaminate.near_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3 takes from rules alone, which SQL can express."""
    judged = op3_url_filter(spark, sf_dir)
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op5, which SQL can express."""
    return op5_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_warc": op2_warc,
        "op3_url_filter": op3_url_filter,
        "op4_bpe": op4_bpe,
        "op5_license_scan": op5_license_scan,
        "op6_ngram_join": op6_ngram_join,
        "op7_chat_format": op7_chat_format,
        "op8_language_id": op8_language_id,
        "op9_quality": op9_quality,
        "op10_fingerprint": op10_fingerprint,
        "op11_fill_middle": op11_fill_middle,
        "op12_ranked_search": op12_ranked_search,
        "op13_exact_dedup": op13_exact_dedup,
        "benchmark_proximity": benchmark_proximity,
        "url_rules": url_rules,
        "license_phrases": license_phrases,
    }


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS l FROM documents),
i AS (SELECT item_id, {_WORDS} AS l FROM benchmark),
w AS (SELECT item_id, l, least(len(l), 10) AS n FROM i WHERE len(l) > 0),
iw AS (SELECT DISTINCT item_id, n, list_slice(l, s, s + n - 1) AS win
       FROM (SELECT item_id, l, n, unnest(range(1, len(l) - n + 2)) AS s FROM w)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, s, list_slice(l, s, s + n - 1) AS win
       FROM (SELECT doc_id, l, n, unnest(range(1, len(l) - n + 2)) AS s FROM d JOIN ns ON len(l) >= n)),
m AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.l)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

PROXIMITY_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS l FROM documents),
i AS (SELECT item_id, row_number() OVER () AS item, {_WORDS} AS l FROM benchmark),
p AS (SELECT doc_id, unnest(l) AS term, unnest(range(0, len(l))) AS pos FROM d),
t AS (SELECT item_id, item, least(len(l), 10) AS n, len(l) AS size, unnest(l) AS term, unnest(range(0, len(l))) AS q FROM i),
c AS (SELECT DISTINCT doc_id, item_id, item, n, size, q, pos - q - s AS align
      FROM p JOIN t ON p.term = t.term CROSS JOIN (VALUES (-1), (0), (1)) AS shifts(s)),
w AS (SELECT doc_id, item_id, unnest(range(greatest(q - n + 1, 0), least(q, size - n) + 1)) AS start, item, align, n, q FROM c),
f AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM
      (SELECT doc_id, item_id FROM w GROUP BY doc_id, item_id, item, align, start, n HAVING count(*) = n)),
g AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n, 0)::BIGINT AS n_near_items, sha256(coalesce(ids, '')) AS near_items_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
_SPACED = (
    r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
)
OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS l FROM documents),
s AS (SELECT doc_id, array_to_string(list_slice(l, k, k + 4), ' ') AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 3)) AS k FROM d WHERE len(l) >= 5)
      UNION SELECT doc_id, array_to_string(l, ' ') FROM d WHERE len(l) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 80 * (nx.n + ny.n - o)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT r.id, b.y FROM r JOIN b ON r.c = b.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.id = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
OP7_SQL = """
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
x AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, replace(replace(coalesce(text, ''), '\\', '\\\\'), '<|', '<\\|') AS esc
      FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length(role) + length(esc) + 24)::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""


_RULE_ROWS = ", ".join(f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in URL_RULES)
URL_RULES_SQL = f"""
WITH r(verdict, rule, h, p) AS (VALUES {_RULE_ROWS}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, max((length(rule), rule, verdict)) AS best
      FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, best[2] AS rule, best[3] AS rule_verdict FROM s LEFT JOIN m ON m.page_id = s.page_id
"""
_PHRASE_PLACES = ", ".join(
    f"list_filter(range(0, len(l) - {len(phrase.split()) - 1}), lambda i: list_slice(l, i + 1, i + {len(phrase.split())}) = {phrase.split()!r}) AS p{k}"
    for k, phrase in enumerate(license_scan.BASE_PHRASES)
)
_LABELS = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(license_scan.BASE_PHRASES.values()))
LICENSE_PHRASES_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS l FROM documents), p AS (SELECT doc_id, l, {_PHRASE_PLACES} FROM d),
a AS (SELECT doc_id, len(l) AS n, list_concat(list_concat(p0, p1), p2) AS places, list_sort(list_filter([{_LABELS}], lambda x: x IS NOT NULL)) AS labels FROM p)
SELECT doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       coalesce(array_to_string(labels, ','), '') AS base_labels FROM a
"""


OP11_SQL = r"""
WITH s AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS l,
             [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in range(4)] AS hs FROM s),
f AS (SELECT *, len(l) AS n, least(hs[1] % (len(l) + 1), hs[2] % (len(l) + 1)) AS a, greatest(hs[1] % (len(l) + 1), hs[2] % (len(l) + 1)) AS b,
             CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR hs[3] % 100 >= 90 THEN 'plain' WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM u),
p AS (SELECT *, array_to_string(list_slice(l, 1, a), '') AS pre, array_to_string(list_slice(l, a + 1, b), '') AS mid, array_to_string(list_slice(l, b + 1, n), '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS l FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(l))::BIGINT AS total FROM d WHERE len(l) > 0),
t AS (SELECT row, doc_id, len(l) AS n, term, count(*) AS tf FROM (SELECT row, doc_id, l, unnest(l) AS term FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, item, term FROM (SELECT item_id, row_number() OVER () AS item, unnest({_WORDS}) AS term FROM benchmark)),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, c),
s AS (SELECT item, item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN w USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50
"""
OP13_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS row, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, row DESC) AS place FROM d)
SELECT doc_id, keep_id, size::BIGINT AS group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1_SQL, "op2_warc": OP2_SQL, "op6_ngram_join": OP6_SQL, "op7_chat_format": OP7_SQL,
        "op11_fill_middle": OP11_SQL, "op12_ranked_search": OP12_SQL, "op13_exact_dedup": OP13_SQL,
        "benchmark_proximity": PROXIMITY_SQL,
        "url_rules": URL_RULES_SQL, "license_phrases": LICENSE_PHRASES_SQL,
    }
