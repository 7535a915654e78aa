"""License scans: Aho-Corasick notices and tags, shunting-yard licence expressions.

``scan_licences(docs)`` reads whole texts. A text is lower-cased (A-Z) and cut into words; one
Aho-Corasick automaton over the words, joined by single spaces, reports every place of every
notice phrase and of the identifier tags. After a tag, the rest of its line is parsed as a
licence expression (``and``, ``or``, ``with``, parentheses) by a shunting yard and evaluated.

Defined results: a null or empty text has no words, no labels and score 0; a null id stays
null; repeated rows give repeated results; an empty table gives an empty result; further
columns of ``docs`` are not read. A malformed expression gives the labels of the identifiers
it names but no restriction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bedside_spark.llm.frames import table, text_bytes

# The phrases every scan must report, and the labels they stand for.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Further notices of the method, and how much each alone says that a licence is meant.
NOTICES = {
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.9),
    "isc license": ("isc", 0.9),
    "boost software license": ("bsl", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "licensed under cc by": ("cc-by", 0.9),
    "licensed under cc by nc": ("cc-by-nc", 0.9),
    "licensed under cc by sa": ("cc-by-sa", 0.9),
    "licensed under cc0": ("cc0", 0.9),
    "public domain": ("public-domain", 0.4),
    "all rights reserved": ("all-rights-reserved", 0.6),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
}
BASE_WEIGHT = 0.9
TAG = "spdx license identifier"
TAG_WEIGHT = 0.95
_TAGGED = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)

#: Families of identifiers by prefix: label and restriction (0 free, 1 closed).
FAMILIES = {
    "mit": ("mit", 0.1),
    "apache": ("apache", 0.15),
    "bsd": ("bsd", 0.1),
    "isc": ("isc", 0.1),
    "0bsd": ("bsd", 0.0),
    "bsl": ("bsl", 0.1),
    "zlib": ("zlib", 0.1),
    "unlicense": ("public-domain", 0.0),
    "cc0": ("cc0", 0.0),
    "cc-by-nc": ("cc-by-nc", 0.8),
    "cc-by-sa": ("cc-by-sa", 0.5),
    "cc-by": ("cc-by", 0.2),
    "mpl": ("mpl", 0.4),
    "epl": ("epl", 0.4),
    "lgpl": ("lgpl", 0.5),
    "agpl": ("agpl", 0.8),
    "gpl": ("gpl", 0.7),
    "proprietary": ("proprietary", 1.0),
}
#: An exception takes this much off the restriction of the licence it is joined to.
EXCEPTION_RELIEF = 0.2
UNKNOWN_RESTRICTION = 0.9

_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """Shunting yard: the expression's operands and operators in postfix order.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``. None if malformed;
    what follows a complete expression (such as a closing comment mark) is not read.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, position = True, 0
    text = expression.lower()
    while position < len(text):
        if text[position] in " \t":
            position += 1
            continue
        found = _TOKEN.match(text, position)
        token = found[0] if found else ""
        if operand_next:
            if token == "(":
                stack.append(token)
            elif not token or token == ")" or token in _RANK:
                return None
            else:
                out.append(token)
                operand_next = False
        elif token in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            break
        position += len(token)
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def family(identifier: str) -> tuple[str, float]:
    """Label and restriction of an identifier, by its longest known prefix."""
    parts = identifier.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if known := FAMILIES.get("-".join(parts[:n])):
            return known
    return identifier, UNKNOWN_RESTRICTION


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """(labels, restriction): ``or`` leaves the freer choice, ``and`` binds to the stricter."""
    values: list[tuple[set[str], float]] = []
    for at, token in enumerate(postfix):
        if token not in _RANK:
            # The operand right before ``with`` names an exception, not a licence.
            exception = at + 1 < len(postfix) and postfix[at + 1] == "with"
            label, strict = ("", 0.0) if exception else family(token)
            values.append(({label} - {""}, strict))
            continue
        right, left = values.pop(), values.pop()
        if token == "with":
            values.append((left[0], max(0.0, left[1] - EXCEPTION_RELIEF)))
        else:
            pick = min if token == "or" else max
            values.append((left[0] | right[0], pick(left[1], right[1])))
    return values[0]


_OTHER = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(
    range(0x7B, 0x80)
)
_FOLD = bytearray(range(256))
_FOLD[0x41:0x5B] = bytes(range(0x61, 0x7B))
for _byte in _OTHER:
    _FOLD[_byte] = 0x20
_FOLD = bytes(_FOLD)


def automaton() -> ahocorasick.Automaton:
    """All phrases with a space on either side; the text they are sought in has the same."""
    machine = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        machine.add_word(f" {phrase} ", (len(phrase) + 2, True, label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICES.items():
        machine.add_word(f" {phrase} ", (len(phrase) + 2, False, label, weight))
    machine.add_word(f" {TAG} ", (len(TAG) + 2, False, None, TAG_WEIGHT))
    machine.make_automaton()
    return machine


def scan_text(machine: ahocorasick.Automaton, body: bytes | None) -> tuple:
    """One text's row, without its id, in the order of ``SCHEMA``."""
    words = (body or b"").translate(_FOLD).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, 0, None
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base, base_labels, labels, missing = [], set(), set(), 1.0
    tags, word, counted = 0, 0, 0
    found = sorted((end - hit[0] + 1, hit) for end, hit in machine.iter(line))
    for begin, (_, is_base, label, weight) in found:
        word += line.count(" ", counted, begin)
        counted = begin
        missing *= 1.0 - weight
        if is_base:
            base.append(word)
            base_labels.add(label)
        elif label is None:
            tags += 1
        else:
            labels.add(label)
    restriction = None
    if tags:
        for written in _TAGGED.findall(body):
            written = written.decode("utf-8", "replace")
            postfix = to_postfix(written)
            if postfix is None:
                names = _TOKEN.findall(written.lower())
                labels |= {family(n)[0] for n in names if family(n)[1] != UNKNOWN_RESTRICTION}
                continue
            named, strict = evaluate(postfix)
            labels |= named
            restriction = strict if restriction is None else max(restriction, strict)
    return (
        len(words),
        len(base),
        min(base, default=None),
        max(base, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | labels)),
        1.0 - missing,
        tags,
        restriction,
    )


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, n_tags long, restriction double"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_TYPES = [
    {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[part.split()[1]]
    for part in SCHEMA.split(", ")
]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = automaton()
    for batch in batches:
        rows = [scan_text(machine, value.as_py()) for value in batch.column("body")]
        columns = zip(*rows) if rows else [()] * len(_NAMES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, _TYPES)],
            names=["doc_id", *_NAMES],
        )


def scan_licences(docs: DataFrame) -> DataFrame:
    """Licence notices, tags and evaluated expressions of every document's whole text.

    ``score`` is the chance that a licence is meant, taking the notices as independent;
    ``restriction`` is the strictest of the tagged expressions, 0 free to 1 closed.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    return text_bytes(docs, "doc_id").mapInArrow(_scan, f"doc_id {key}, {SCHEMA}")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
