"""URL filter: explicit host/path rules, and a model for all other URLs.

The model is a logistic regression on hashed character n-grams of host and
path, trained on the driver from a small labelled URL table whose size is
bounded by ``MAX_LABELLED``.  The table that comes with it is made by a rule: a
site's name of one or two words, some of which are typical of sites to block,
under common prefixes, languages and paths.

Defined cases: a null URL, or one without ``://``, has empty host and path and
is judged by the model; very long URLs are read whole; of rules that fit with
the same length the last in alphabetical order decides; repeated rows are judged
alike; an empty table gives an empty result.  Only the two named columns are read, so other columns of any
name do no harm.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Most rows of the labelled URL table that training takes.
MAX_LABELLED = 20_000
N_BUCKETS = 1 << 14
GRAMS = (3, 4, 5)

#: Words of sites to block, and of others; invented sites are named after them.
BLOCK_WORDS = (
    "spam farm links seo casino slots poker roulette jackpot bet odds adult xxx cams escort porn pills viagra pharma replica "
    "payday loans torrent warez crack keygen serial malware phish scam hack free-money win-big cheap clickbait doorway"
).split()
OTHER_WORDS = (
    "garden university news library weather software museum theatre history recipes town physics travel station nation reading "
    "science cooking sports health music school bank hospital forest river bridge painting poetry radio garage kitchen market "
    "journal review archive forum wiki maps books example football cinema opera village church castle island coast mountain "
    "language letters mathematics chemistry biology geology astronomy economy policy court parliament energy railway airport"
).split()
HEADS, ENDINGS = ("", "www.", "m.", "blog.", "docs."), ("com", "net", "org", "test")
PATHS = ("/en/{n}", "/de/{n}.html", "/fr/{n}/", "/es/{n}?page=2&ref=x", "/{word}/{n}", "/{word}/{n}#top", "/{n}?utm_source=feed", "")


def labelled_urls() -> list[tuple[str, int]]:
    """(URL, 1 for block): every word alone and with some others, each under one
    prefix, ending and path in turn."""
    out = []
    words = [(w, 1) for w in BLOCK_WORDS] + [(w, 0) for w in OTHER_WORDS]
    for k, (word, label) in enumerate(words):
        # a site to block may also bear an everyday word
        company = OTHER_WORDS if label else [w for w, y in words if not y]
        names = [word] + [f"{word}-{company[(7 * k + 3 * j) % len(company)]}" for j in range(6)] + [f"{company[(5 * k + j) % len(company)]}{word}" for j in range(6)]
        for j, name in enumerate(names):
            n = 13 * k + j
            scheme, head, ending = ("http", "https")[n % 2], HEADS[n % len(HEADS)], ENDINGS[(n // 3) % len(ENDINGS)]
            path = PATHS[(n // 2) % len(PATHS)].format(n=n * 37 % 90_001, word=word)
            out.append((f"{scheme}://{head}{name}.{ending}{path}", label))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    m = re.match(r"[^/?#]*", rest)
    host, tail = m[0], rest[m.end() :]
    return (
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host),
        re.match(r"[^?#]*", tail, re.S)[0],
    )


def ngram_ids(host: str, path: str) -> np.ndarray:
    """Distinct hashed ids of the character n-grams of host and path."""
    ids = {0}
    for mark, text in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        raw = text.encode("utf-8", "replace")
        for n in GRAMS:
            ids.update(zlib.crc32(raw[i : i + n], mark[0]) % N_BUCKETS for i in range(len(raw) - n + 1))
    return np.fromiter(ids, dtype=np.int64)


def train(labelled: list[tuple[str, int]], epochs: int = 300, rate: float = 0.5, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression weights by full-batch gradient descent; index 0 is the bias."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    rows = [ngram_ids(*split_url(u)) for u, _ in labelled]
    y = np.array([float(label) for _, label in labelled])
    w = np.zeros(N_BUCKETS)
    if not rows:
        return w
    # both classes weigh the same
    weight = np.where(y > 0, len(y) / (2 * max(1.0, y.sum())), len(y) / (2 * max(1.0, (1 - y).sum())))
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = 1 / np.sqrt(np.array([len(r) for r in rows], dtype=float))
    for _ in range(epochs):
        z = np.bincount(owner, w[flat], len(rows)) * scale
        err = (1 / (1 + np.exp(-z)) - y) * weight * scale / len(rows)
        w -= rate * (np.bincount(flat, err[owner], N_BUCKETS) * 10 + l2 * w)
    return w


def block_score(w: np.ndarray, host: str, path: str) -> float:
    ids = ngram_ids(host, path)
    return float(1 / (1 + np.exp(-w[ids].sum() / np.sqrt(len(ids)))))


class Rules:
    """Host/path rules; the longest rule that fits a URL decides."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((rule, slash + path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        parts = host.split(".")
        for i in range(len(parts)):
            for rule, prefix, verdict in self.by_host.get(".".join(parts[i:]), ()):
                if path.startswith(prefix) and (best is None or (len(rule), rule) > (len(best[0]), best[0])):
                    best = (rule, verdict)
        return best


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    labelled: list[tuple[str, int]] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """Judge every URL: (id, host, path, rule, verdict, score).

    A map over the scan, without a shuffle.  ``score`` is the model's
    probability of block, given also where a rule decides.
    """
    weights = train(labelled_urls() if labelled is None else labelled).astype(np.float32)
    source = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Rules(rules)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                score = block_score(weights, host, path)
                found = table.find(host, path)
                rule, verdict = found or (None, "block" if score >= threshold else "allow")
                for column, value in zip(out, (host, path, rule, verdict, score), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                names=[id_col, "host", "path", "rule", "verdict", "score"],
            )

    return source.mapInArrow(
        run, f"`{id_col}` {id_type}, host string, path string, rule string, verdict string, score double"
    )
