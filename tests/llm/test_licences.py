from __future__ import annotations

import re

import pytest

from bedside_spark.llm import licences
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: chr(c + 32) for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        parts = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += here
        labels |= {label} if here else set()
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(labels)),
    )


TEXTS = [
    "Released under the MIT License.",
    "mit license mit LICENSE, Apache-License; GNU General   Public\nLicense!",
    "permit license, mit licenses, MIT éLicense",
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause\nrest",
    "SPDX-License-Identifier: and and",
    "SPDX License Identifier without a colon",
    "MIT License " * 3000,
]


@pytest.mark.parametrize("text", TEXTS + [t for _, t in cases.TEXTS])
def test_base_places_match_brute_force(text):
    row = licences.scan_text(licences.automaton(), None if text is None else text.encode())
    assert row[:5] == brute(text)
    assert set(filter(None, row[4].split(","))) <= set(row[5].split(","))
    assert 0 <= row[6] <= 1


def test_expressions():
    def value(text):
        return licences.evaluate(licences.to_postfix(text))

    assert licences.to_postfix("a or b and c with d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert licences.to_postfix("(a or b) and c") == ["a", "b", "or", "c", "and"]
    assert value("MIT OR GPL-3.0-only") == ({"mit", "gpl"}, 0.1)
    assert value("MIT AND GPL-3.0-only") == ({"mit", "gpl"}, 0.7)
    assert value("GPL-2.0+ WITH Classpath-exception-2.0")[1] == pytest.approx(0.5)
    assert value("MIT */")[0] == {"mit"}
    for broken in ("", "and mit", "mit and", "(mit", "mit)", "()"):
        assert licences.to_postfix(broken) is None, broken


def test_tagged_expression_gives_labels_and_restriction():
    row = licences.scan_text(licences.automaton(), TEXTS[3].encode())
    assert row[5] == "bsd,gpl,mit" and row[7] == 1 and row[8] == 0.1


def test_awkward_rows(spark):
    got = licences.scan_licences(cases.awkward(spark)).collect()
    assert len(got) == len(cases.TEXTS)
    assert {r.doc_id for r in got if r.n_words == 0} >= {None, 4, 5, 6}
    assert licences.scan_licences(cases.empty(spark)).collect() == []
