"""License scan: an Aho-Corasick automaton finds notice phrases and identifier
tags; a shunting-yard parser evaluates and/or/with licence expressions.

Base phrases are found on the word sequence of the text; identifier tags and
further notices add labels of their own.  Only words of the form of licence
identifiers count in an expression: an identifier has a letter and a hyphen or a digit, as
nearly all of the SPDX list do, or is one of ``PLAIN_IDENTIFIERS``.  Each
expression is evaluated against a set of allowed licences.

Defined cases: null text counts as empty (no words, empty label strings, score
0); texts of any length are scanned whole, expressions to their line's end; a
malformed expression, such as one whose ``with`` joins more than one licence and
one exception, keeps the licences before the fault and isn't permitted;
repeated rows are scanned alike; an empty table gives an empty result; only the
id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, words_of

#: Base phrases (as words) and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notice phrases of the method, and the identifiers they stand for.
NOTICE_PHRASES = {
    "gnu general public license version 3": "gpl-3.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2.0",
    "released into the public domain": "public-domain",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "all-rights-reserved",
}
#: Identifiers of the SPDX list without a hyphen or digit.
PLAIN_IDENTIFIERS = set(
    """
    aal abstyles aladdin aml ampas anti antlr baekmuk bahyph barr beerware borceux caldera catharon cldr clartistic
    condor cronyx crossword cube curl diffmark dotseqn dsdp dvipdfm ecos egenix elastic entessa epics etalab eudatagrid
    fair freeimage fsful fsfap ftl glide glulxe gnuplot gutmann haskellreport hippocratic hpnd ibm-pibs icu ijg imagemagick
    imatix info-zip intel ipa isc jam jasper jpnic json kazlib knuth-ctan latex2e leptonica libpng libtiff loop mackerras
    mirros mit mplus mtll mulanpsl multics mup ncsa net-snmp netcdf newsletr ngpl nlpl noweb nrl openssl opubl padl parity
    plexus postgresql psfrag psutils python qhull rdisc rsa-md ruby saxpath scea sendmail sissl sleepycat smlnj snia soundsystem
    spl symlinks tcl tmate torque tosl ucar unlicense vim vostrom wsuipl wtfpl xinetd xlock xnet xpp xskat zed zlib none
    """.split()
)
#: Licences that an expression must be met with to be permitted, unless others are given.
PERMISSIVE = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "0bsd", "unlicense", "cc0-1.0"}
TAG = "spdx-license-identifier:"
_EXPRESSION = re.compile(r"[ \t]*([A-Za-z0-9.+\-() \t]+)")
_IDENTIFIER = re.compile(r"[a-z0-9]+(?:[.\-]+[a-z0-9]+)*\+?")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+\-]+")
_OPERATORS = {"or": 1, "and": 2, "with": 3}


def is_identifier(token: str) -> bool:
    """Whether a lower-case token has the form of a licence identifier."""
    return bool(_IDENTIFIER.fullmatch(token)) and (token.rstrip("+") in PLAIN_IDENTIFIERS or bool(re.search(r"[\d-]", token) and re.search(r"[a-z]", token)))


def parse_expression(text: str) -> tuple | None:
    """The tree of a licence expression, see ``parse_prefix``."""
    found = parse_prefix(text)
    return found[0] if found else None


def parse_prefix(text: str) -> tuple | None:
    """Parse the licence expression that a text begins with by the shunting-yard
    method: its tree, and where it ends.

    The tree is ``id`` or ``(operator, left, right)``; ``with`` binds tighter
    than ``and``, which binds tighter than ``or``, and joins one licence and one
    exception.  Words after a complete expression, and words that are no
    identifiers, end it; a malformed expression gives None.
    """
    operands, end, well_formed = shunt(text)
    return (operands[0], end) if well_formed else None


def shunt(text: str) -> tuple[list, int, bool]:
    """Operands of the expression that a text begins with, its end, and whether it
    is well formed, the one operand then being its tree.  Of a malformed one these
    are the trees read before the fault.
    """
    output: list = []
    stack: list[str] = []
    operand_next, end = True, 0

    def reduce_top() -> bool:
        if len(output) < 2 or stack[-1] == "with" and not (isinstance(output[-1], str) and isinstance(output[-2], str)):
            return False
        right, left = output.pop(), output.pop()
        output.append((stack.pop(), left, right))
        return True

    for m in _TOKEN.finditer(text):
        token, low = m[0], m[0].lower()
        if token == "(":
            if not operand_next:
                break
            stack.append(token)
        elif token == ")":
            if operand_next:
                return output, end, False
            if "(" not in stack:
                break
            while stack[-1] != "(":
                if not reduce_top():
                    return output, end, False
            stack.pop()
        elif low in _OPERATORS:
            if operand_next:
                return output, end, False
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[low]:
                if not reduce_top():
                    return output, end, False
            stack.append(low)
            operand_next = True
        else:
            if not operand_next or not is_identifier(low):
                break
            output.append(low)
            operand_next = False
        end = m.end()
    if operand_next or "(" in stack:
        return output, end, False
    while stack:
        if not reduce_top():
            return output, end, False
    return output, end, len(output) == 1


def operands_first(tree) -> Iterator:
    """All nodes of a tree of any depth, each after its left and right operands."""
    todo = [(tree, False)]
    while todo:
        node, ready = todo.pop()
        if ready or isinstance(node, str):
            yield node
        else:
            todo += [(node, True), (node[2], False), (node[1], False)]


def licences_of(tree) -> list[str]:
    """Identifiers of a parsed expression; ``x with y`` is one identifier."""
    done: list[list[str]] = []
    for node in operands_first(tree):
        if isinstance(node, str):
            done.append([node])
            continue
        right, left = done.pop(), done.pop()
        if node[0] == "with":
            done.append([f"{left[0]} with {right[0]}"])
        else:
            left.extend(right)
            done.append(left)
    return done[0]


def permitted(tree, allowed: set[str]) -> bool:
    """Whether the expression can be met with allowed licences: ``or`` needs one
    side, ``and`` both, ``with`` the exception by name or its base licence."""
    done: list[bool] = []
    for node in operands_first(tree):
        if isinstance(node, str):
            done.append(node in allowed)
            continue
        right, left = done.pop(), done.pop()
        if node[0] == "or":
            done.append(left or right)
        elif node[0] == "and":
            done.append(left and right)
        else:
            done.append(left or licences_of(node)[0] in allowed)
    return done[0]


def build_automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for base, phrases in ((True, BASE_PHRASES), (False, NOTICE_PHRASES)):
        for phrase, label in phrases.items():
            key = f" {phrase} "
            machine.add_word(key, (base, label, len(key)))
    machine.make_automaton()
    return machine


def build_tag_automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    machine.add_word(TAG, len(TAG))
    machine.make_automaton()
    return machine


def scan_text(raw: bytes | None, machine, tags, allowed: set[str] = PERMISSIVE) -> tuple:
    """(n_words, n_base, first, last, base labels, labels, score, expressions, permitted).

    ``permitted`` is whether allowed licences meet every expression, None without
    any; a malformed one isn't met, and gives the labels of the licences read
    before its fault.
    """
    words = words_of(raw)
    n_base, first, last = 0, None, None
    base_labels: set[str] = set()
    labels: set[str] = set()
    expressions: list[str] = []
    met: list[bool] = []
    if words:
        text = (b" " + b" ".join(words) + b" ").decode("latin-1")
        at, seen = 0, 0
        for end, (base, label, length) in machine.iter(text):
            labels.add(label)
            if not base:
                continue
            start = end - length + 1
            if start >= at:
                seen += text.count(" ", at, start)
                at, word = start, seen
            else:
                word = seen - text.count(" ", start, at)
            n_base += 1
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
            base_labels.add(label)
        low = raw.translate(_FOLD)
        if b"spdx" in low:
            latin = raw.decode("latin-1")
            for tag_end, _ in tags.iter(low.decode("latin-1")):
                m = _EXPRESSION.match(latin, tag_end + 1)
                read, end, well_formed = shunt(m[1]) if m else ([], 0, False)
                for tree in read:
                    labels.update(licences_of(tree))
                if well_formed:
                    expressions.append(m[1][:end].strip())
                    met.append(permitted(read[0], allowed))
                elif read:
                    met.append(False)
    score = 1 - 0.5 ** (n_base + 2 * len(expressions) + len(labels - base_labels)) if labels else 0.0
    return (
        len(words), n_base, first, last,
        ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expressions, all(met) if met else None,
    )


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: set[str] = PERMISSIVE) -> DataFrame:
    """Scan every whole text: one row per document, a map without a shuffle."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, tags = build_automaton(), build_tag_automaton()
        kinds = (
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
            pa.list_(pa.string()), pa.bool_(),
        )
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permitted")
        for batch in batches:
            rows = [scan_text(raw, machine, tags, allowed) for raw in raw_texts(batch.column("text"))]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[id_col, *names],
            )

    return source.mapInArrow(
        run,
        f"`{id_col}` {id_type}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, expressions array<string>, permitted boolean",
    )
