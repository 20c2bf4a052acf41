from __future__ import annotations

import collections
import gzip
import hashlib
import random
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from talkloom.llm import chat_format, common, components, fingerprint, hubs, ngram_join, queries, warc
from talkloom.llm.common import shared_folder

DATA = "/root/testdata/sf0.001"


# ---- op2 ----


def test_warc_round_trip(spark, tmp_path):
    long = "payload " * 300
    noise = "".join(chr(random.Random(1).randint(32, 126)) for _ in range(100)) * 50_000
    rows = [(1, "http://a/\r\nx", long), (2, None, long), (9, "u", long), (9, "u", long), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", long), (7, "u", noise)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    folder = str(tmp_path / "warc")
    warc.write_warc(pages, folder)
    for split in (97, 5000, 1 << 24):
        got = warc.read_warc(spark, folder, split, with_payload=True).collect()
        assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got) == sorted(
            (i or 0, "revisit" if h == long and i != 9 else "response", 9 if h == long and i != 9 else None) for i, _, h in rows
        )
        for r in got:
            html = next(h or "" for i, _, h in rows if i == r["page_id"]).encode()
            assert r["intact"] and r["payload_bytes"] == len(html) and r["payload_digest"] == hashlib.sha1(html).hexdigest()
            assert bytes(r["payload"]) == (html if r["record_type"] == "response" else b"")
    texts = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("part-*"))
    assert texts.count(b"WARC/1.1\r\n") == len(rows)


def test_warc_false_magic(tmp_path):
    inner = gzip.compress(b"not a record")
    stored = gzip.compress(warc.build_record(1, "u", inner * 3, None), compresslevel=0)
    data = stored + warc.gzip_member(warc.build_record(2, "u", b"x", None)) + b"\0" + warc.gzip_member(warc.build_record(3, "u", b"y", None))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for step in (1, 13, 100, len(data)):
        with open(path, "rb") as f:
            ids = [warc.parse_record(raw)["page_id"] for at in range(0, len(data), step) for _, raw in warc.RangeReader(f, len(data)).records(at, min(len(data), at + step))]
        assert ids == [1, 2, 3]


def damaged_archive(kind):
    """Three records, the second of which is damaged, and where it starts."""
    members = [warc.gzip_member(warc.build_record(i, "u", f"payload {i} ".encode() * 400, None)) for i in (1, 2, 3)]
    at, bad = len(members[0]) + 1, bytearray(members[1])
    if kind == "flipped":
        bad[len(bad) // 2] ^= 1
    elif kind == "magic":
        bad[0] = 7
    elif kind == "checksum":
        bad[-6] ^= 255
    elif kind == "no record":
        bad = bytearray(warc.gzip_member(b"WARC/1.1 but nothing more"))
    elif kind == "cut":
        return members[0] + b"\0" + bytes(bad[:-9]), at, [1]
    return members[0] + b"\0" + bytes(bad) + b"\0" + members[2] + b"\0", at, [1, 3]


@pytest.mark.parametrize("kind", ["flipped", "magic", "checksum", "no record", "cut"])
def test_warc_damage_is_reported(spark, tmp_path, kind):
    data, at, ids = damaged_archive(kind)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "x.warc.gz").write_bytes(data)
    folder = str(tmp_path / "w")
    for split in (1 << 24, 60):
        rows = warc.read_warc(spark, folder, split, strict=False).collect()
        assert sorted(r["page_id"] for r in rows if r["error"] is None) == ids
        assert [(r["place"], r["page_id"]) for r in rows if r["error"]] == [(at, None)]
    with pytest.raises(Exception, match="DamagedArchive"):
        warc.read_warc(spark, folder).count()


def test_warc_of_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- op6 ----


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows):
    sets, parent, holders = {}, {}, collections.defaultdict(list)
    for i, t in rows:
        sets[i] = shingles(t)
        parent[i] = i
        for s in sets[i]:
            holders[s].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        common = collections.Counter(j for s in sets[i] for j in holders[s] if j < i)
        for j, o in common.items():
            if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_texts(seed):
    """Families of near copies by chains of edits, sharing passages with others."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 5) + rng.choice("xyz")
    passage = [word() for _ in range(25)]
    rows, n = [], 0
    for _ in range(6):
        text = [word() for _ in range(rng.randint(3, 70))]
        if rng.random() < 0.5:
            text += passage
        for _ in range(rng.randint(1, 14)):
            rows.append((n, " ".join(text)))
            n += 1
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = word()
    rows += [(n, rows[0][1].upper()), (n + 1, rows[0][1].replace(" ", " \n\t")), (n + 2, "a b c"), (n + 3, "A b  c"), (n + 4, "a b c d"), (n + 5, None), (n + 6, ""), (n + 7, " \n"), (n + 8, "word " * 5000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_matches_brute_force(spark, seed):
    rows = near_texts(seed)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, doc string, n int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == brute_components(rows)


def test_ngram_join_edges(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (None, None), (5, "k l m n o p"), (5, "l m n o p q"), (6, "k l m n o p q")]
    got = sorted(map(tuple, ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    # both rows of id 5 are one document with three shingles, those of id 6
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (5, 3, 5), (5, 3, 5), (6, 3, 5), (None, 0, None), (None, 2, None)]
    assert ngram_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(("seed", "rounds"), [(3, 2), (4, 0), (5, 1)])
def test_ngram_join_with_hot_lists_and_frequent_shingles(spark, monkeypatch, seed, rounds):
    """Small bounds, so that lists are split into parts and shingles are known to be
    frequent; few hub rounds, so that much is left to the last round's blocks."""
    monkeypatch.setattr(hubs, "ROUNDS", rounds)
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(ngram_join, "SAMPLE_PIECE", 16)
    monkeypatch.setattr(ngram_join, "SAMPLE_DOCS", 160)
    monkeypatch.setattr(ngram_join, "FREQUENT", 0.1)
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij") * rng.randint(1, 9) + rng.choice("xyz") for _ in range(60)]
    rows = near_texts(seed)
    for k in range(120):  # a large group of near copies, in chains
        text = list(base)
        for _ in range(k % 7):
            text[rng.randrange(len(text))] = f"w{k}"
        rows.append((1000 + k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    source = docs.select(F.col("doc_id").alias("doc"), "text").where("text is not null")
    assert len(ngram_join.frequent_shingles(source, len(rows))) > 0
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == brute_components(rows)


def test_shingle_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = [b"a b c d e f g", None, b"", "é ß x y z w".encode(), b"q " * 50]
    whole = [h.tolist() for h in ngram_join.Shingler().hashes(texts)]
    monkeypatch.setattr(ngram_join, "CHUNK_BYTES", 16)
    assert [h.tolist() for h in ngram_join.Shingler().hashes(texts)] == whole
    assert [len(h) for h in whole] == [len(shingles(t.decode() if t else t)) for t in texts]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(links, shared_folder(spark)).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# ---- op7 ----


@pytest.mark.parametrize("text", ["", "\\", "<|end|>\n", "<\\|end|>", "\\<|", "a<|turn|>b\\\\", "</s>[INST] ok [/INST]", "\n<|"])
def test_template_is_reversible(text):
    turns = [("user", text), ("assistant", text), ("<|text|>", text)]
    formatted, mask = chat_format.format_turns(turns)
    assert chat_format.parse_turns(formatted) == turns
    assert chat_format.masked_text(formatted, mask) == text
    assert formatted.count(chat_format.TURN) == 3


def test_best_branch(spark):
    rows = [
        (1, 10, None, "user", "q", 0.0), (1, 11, 10, "assistant", "bad", 1.0), (1, 12, 10, "assistant", "good", 2.0), (1, 13, 12, "user", "more", 0.5),
        (1, 14, 13, "assistant", "end", 0.0), (2, 20, 99, "user", "orphan", 0.0), (3, 30, 31, "user", "loop", 0.0), (3, 31, 30, "user", "loop", 0.0),
    ]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["leaf"]): [t for _, t in chat_format.parse_turns(r["formatted"])] for r in chat_format.format_chats(messages, branches=2).collect()}
    assert got == {(1, 14): ["q", "good", "more", "end"], (1, 11): ["q", "bad"], (2, 20): ["orphan"]}
    assert [r["leaf"] for r in chat_format.format_chats(messages.where("tree = 1")).collect()] == [14]


def test_chat_edges(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "x"), (None, 1, "user", "a", "x"), (5, None, "assistant", "b", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    folder = shared_folder(spark)
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_chats(chat_format.chain_messages(table, folder), folder=folder)).collect()}
    assert got[1]["n_turns"] == 2 and got[None]["n_turns"] == 1 and got[5]["loss_chars"] == 1
    empty = chat_format.chain_messages(table.limit(0), shared_folder(spark))
    assert chat_format.format_chats(empty).count() == 0


def test_long_chain(spark):
    table = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    folder = shared_folder(spark)
    row = chat_format.format_chats(chat_format.chain_messages(table, folder), folder=folder).first()
    assert [t for _, t in chat_format.parse_turns(row["formatted"])] == [str(i) for i in range(300)]


# ---- op10 ----


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = sorted(fingerprint.fingerprint_documents(docs).collect(), key=lambda r: -r["doc_id"])
    texts = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    assert len(rows) == len(texts)
    for k, (r, (i, text)) in enumerate(zip(rows, texts, strict=True)):
        n, following = len(text) // 3, texts[(k + 1) % len(texts)][1]
        assert (r["doc_id"], r["n_chars"]) == (i, len(text))
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - n] + following[:n]).encode()).hexdigest()
        assert r["near_next"] == pytest.approx(fingerprint.likeness(*(fingerprint.fingerprints([text, following])[[j]] for j in (0, 1)))[0])
    long = [r for r in rows if r["n_chars"] >= 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) / len(long) >= 0.98


def test_fingerprint_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a", "x"), (3, "a", "x"), (None, "🙂é" * 40_000, "x"), (4, "same text here", "x"), (5, "same text here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = fingerprint.fingerprint_documents(docs).collect()
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert len(got) == len(rows) and prints[1] == prints[2] and prints[4] == prints[5]
    assert fingerprint.fingerprint_documents(docs.limit(0)).count() == 0
    assert fingerprint.fingerprint_documents(docs.where("doc_id = 4")).first()["near_next"] == 1.0


def test_queries_are_named(spark):
    assert {n.split("_")[0] for n in queries.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want
