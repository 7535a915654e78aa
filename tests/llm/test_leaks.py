from __future__ import annotations

import random
import re
import time

import regex
from pyspark.sql import functions as F

from bedside_spark.llm import leaks
from tests.llm import cases

ITEM = (
    "Yesterday Tom bought 5 apples for 3 dollars each, and then Tom gave 2 apples to Mary. "
    "How many apples does Tom have now?"
)
SAME = (
    "Yesterday Ann bought 17 apples for 4.5 dollars each, and then Ann gave 8 apples to Lucy. "
    "How many apples does Ann have now?"
)
MIXED = (
    "Yesterday Ann bought 17 apples for 4.5 dollars each, and then Bob gave 8 apples to Lucy. "
    "How many apples does Eve have now?"
)


def benchmark(spark):
    rows = [(1, ITEM), (1, ITEM), (2, "too short"), (3, None), (None, "Only these six plain words here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def docs(spark):
    rows = [
        (1, f"Question. {ITEM} Answer."), (2, f"{SAME} padding"), (3, MIXED), (4, None), (5, ""),
        (None, SAME), (6, "Only THESE six plain words here"), (7, f"{SAME} padding"),
        (7, f"{SAME} padding"), (8, "unrelated prose about apples and dollars " * 30),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_reparameterised_items_are_found_and_inconsistent_ones_not(spark):
    found = {(r.doc_id, r.item_id): r.changed for r in leaks.leaks(docs(spark), benchmark(spark)).collect()}
    assert found == {
        (1, 1): False, (2, 1): True, (None, 1): True, (7, 1): True, (6, None): False,
    }


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    usual = cases.listed(leaks.leaks(docs(spark), benchmark(spark)))
    monkeypatch.setattr(leaks, "BROADCAST_WINDOWS", 0)
    assert cases.listed(leaks.leaks(docs(spark), benchmark(spark))) == usual


def test_leaking_documents_go(spark):
    given = docs(spark).withColumn("tokens", F.lit("clash")).withColumn("hash", F.lit(1))
    kept = leaks.drop_leaking(given, benchmark(spark))
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 8]


def test_every_template_token_has_its_value(spark):
    rows = cases.awkward(spark).unionByName(cases.awkward(spark)).select("text")
    extra = spark.createDataFrame([("a1b 3.5kg 3,000 km/h 5 Km x٣٤ Éa ÉÉ 12:30",)], "text string")
    both = rows.unionByName(extra).where("text is not null")
    sizes = both.select(F.size(leaks.template(F.col("text"))), F.size(leaks.values(F.col("text"))))
    assert all(a == b for a, b in sizes.collect())
    assert extra.select(leaks.template(F.col("text"))).first()[0][:8] == ["a", "0", "b", "0", "2", "0", "2", "h"]


def test_whole_items_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    expected = {(d, i) for i, item in items.items() for d, text in texts.items() if item in text}
    frame = leaks.op5_benchmark_decontamination(spark, folder)
    got = {(r.doc_id, r.item_id) for r in frame.collect()}
    assert expected and expected <= got and len(got - expected) <= 3
    assert not re.search("Python|ArrowEval|Pandas", frame._jdf.queryExecution().toString())


def test_awkward_rows(spark):
    assert leaks.leaks(cases.empty(spark), benchmark(spark)).collect() == []
    assert leaks.leaks(cases.awkward(spark), benchmark(spark).limit(0)).collect() == []
    own = cases.awkward(spark).select(F.col("doc_id").alias("item_id"), "text").where("item_id = 9")
    found = {r.doc_id for r in leaks.leaks(cases.awkward(spark), own).collect()}
    assert 9 in found and not found & {4, 5, 6, 7, 10}


def test_copies_in_another_letter_case_are_found(spark):
    quote = "The Heatou and Mary Ann went to New York with Old Tom Baker. Then Ann saw The Grand Hotel"
    items = spark.createDataFrame([(1, ITEM), (2, quote)], "item_id long, text string")
    texts = [ITEM.upper(), ITEM.lower(), quote.upper(), quote.lower(), quote.swapcase(),
             ITEM.upper().replace("5 APPLES", "17 APPLES")]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): (r.n_covered == r.n_tokens, r.changed)
             for r in leaks.leaks(given, items).collect()}
    assert found == {
        (0, 1): (True, False), (1, 1): (True, False), (2, 2): (True, False), (3, 2): (True, False),
        (4, 2): (True, False), (5, 1): (True, True),
    }


def test_an_upper_cased_item_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = 8376")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").where("item_id = 101")
    assert [r.n_covered for r in leaks.leaks(given, items).collect()] == [18]


def test_items_of_numbers_and_short_items_are_found(spark):
    texts = [
        "What is 12 + 47 * 3 - 5 / 6?", "Solve 3x + 7 = 22, 5y - 9 = 16, 2z + 1 = 7.", "12 + 7 = 19",
        "8 15 16 23 42 4 11 13 99",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    others = [
        "Question: WHAT IS 13 + 48 * 4 - 6 / 8?", "solve 4x + 8 = 28, 6y - 9 = 17, 3z + 2 = 8.",
        "12 + 8 = 20", "What are 12 + 47 * 3 - 5 / 6?", "1 2 3 4 5 6 7 8 9", "5 12 7 19 3", "is 12",
    ]
    copies = [(i, f"Here: {t} Good.") for i, t in enumerate(texts)]
    given = copies + [(10 + i, t) for i, t in enumerate(others)]
    frame = leaks.leaks(spark.createDataFrame(given, "doc_id long, text string"), items)
    found = {(r.doc_id, r.item_id): r.changed for r in frame.collect()}
    assert found == {
        (0, 0): False, (1, 1): False, (2, 2): False, (3, 3): False,
        (10, 0): True, (11, 1): True, (15, 2): False,
    }


NUMBER = regex.compile(r"\p{N}+(?:[.,:/]\p{N}+)*|\p{L}+")
NAME = regex.compile(r"\p{Lu}\p{Ll}+")


def cut(text):
    """(values, template, words, exact), one of each per token."""
    written = NUMBER.findall(text or "")
    number = [regex.match(r"\p{N}", t) is not None for t in written]
    tokens = []
    for i, t in enumerate(written):
        unit = i > 0 and number[i - 1] and t.lower() in leaks.UNITS
        name = NAME.fullmatch(t) is not None
        tokens.append("0" if number[i] else "2" if unit else "1" if name else t.lower())
    words = ["0" if n else t.upper() for t, n in zip(written, number)]
    return written, tokens, words, [t.upper() for t in written]


def brute(docs, items):
    """Nested loops over all places of documents and items."""
    found = []
    for item, text in dict.fromkeys(items):
        theirs = cut(text)
        n, w = len(theirs[0]), min(len(theirs[0]), 8)
        literals = [[sum(t not in "012" for t in r[a : a + w]) for a in range(n - w + 1)] for r in theirs[1:3]]
        usable = [[w >= 4 and x >= w / 2 for x in own] for own in literals]
        chosen = {0: usable[0], 1: usable[1], 2: [not u for u in usable[1]]}
        places = {}
        for reading, on in chosen.items():
            for a, yes in enumerate(on):
                if yes:
                    places.setdefault((reading, *theirs[reading + 1][a : a + w]), []).append(a)
        best = max(range(n - w + 1), key=lambda a: (literals[1][a], -a), default=None)
        whole_at = w >= 4 and not all(usable[1]) and literals[1][best] >= 2
        for doc, body in dict.fromkeys(docs):
            ours = cut(body)
            shifts = {}
            for p in range(len(ours[0]) - w + 1):
                for reading in range(3):
                    own = places.get((reading, *ours[reading + 1][p : p + w]))
                    if own:
                        shifts.setdefault(p - own[0], set()).add((reading, own[0]))
                if whole_at and ours[2][p : p + w] == theirs[2][best : best + w]:
                    shifts.setdefault(p - best, set())
            covered, by_template, slots, changed, any_kept, whole_found = set(), set(), [], True, False, False
            for shift, starts in shifts.items():
                whole = whole_at and shift >= 0 and ours[2][shift : shift + n] == theirs[2]
                kept, pairs = set(), set()
                for reading in range(3):
                    own = {a for r, a in starts if r == reading}
                    at = {a + k for a in own for k in range(w)} | (set(range(n)) if whole and reading == 1 else set())
                    kinds = theirs[1] if reading == 0 else theirs[2]
                    mine = {
                        (kinds[q], theirs[0][q].upper(), ours[0][q + shift].upper()) for q in at if kinds[q] in "012"
                    }
                    conflicts = len(mine) - len({m[:2] for m in mine})
                    if reading == 2 or conflicts <= 0.1 * len(mine):
                        kept |= {(reading, a) for a in own}
                        pairs |= mine
                        whole_found |= whole and reading == 1
                        any_kept |= bool(own) or (whole and reading == 1)
                        if own or (whole and reading == 1):
                            kept.add(None)
                if not kept:
                    continue
                slots.append(len(pairs))
                changed &= any(was != now for _, was, now in pairs)
                for reading, a in kept - {None}:
                    for b in places[(reading, *theirs[reading + 1][a : a + w])]:
                        covered |= set(range(b, b + w))
                        by_template |= set(range(b, b + w)) if reading == 0 else set()
            if not any_kept:
                continue
            covered = set(range(n)) if whole_found else covered
            all_usable = {a + k for a, yes in enumerate(usable[0]) if yes for k in range(w)}

            def needed(size, w=w):
                return min(13, max(-(-size * 7 // 10), w))

            if len(covered) >= needed(n) or len(by_template) >= needed(len(all_usable)):
                found.append((doc, item, n, len(covered), max(slots), changed))
    return sorted(found, key=repr)


def compared(spark, given, texts):
    frame = leaks.leaks(
        spark.createDataFrame(given, "doc_id long, text string"),
        spark.createDataFrame(texts, "item_id long, text string"),
    )
    columns = ("doc_id", "item_id", "n_tokens", "n_covered", "n_slots", "changed")
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert got == brute(given, texts)
    return got


def test_against_nested_loops(spark):
    rng = random.Random(4)
    words = "the a boat Tom Mary km 5 7 1,000 apples has with sold for Straße ÉTÉ hours İSTANBUL in".split()
    texts = [(i, " ".join(rng.choices(words, k=rng.choice((1, 3, 5, 9, 14, 30))))) for i in range(25)]
    given = []
    for i in range(80):
        _, text = rng.choice(texts)
        changes = {"Tom": rng.choice(("Tom", "Ann")), "5": rng.choice(("5", "17", "9")), "7": "8"}
        text = " ".join(changes.get(w, w) if rng.random() < 0.9 else rng.choice(words) for w in text.split())
        text = rng.choice((text, text.upper(), text.lower(), f"{text}. {text}"))
        given.append((i, " ".join(rng.choices(words, k=rng.randrange(6))) + " " + text))
    assert len(compared(spark, given, texts)) > 20
    folder = "/root/testdata/sf0.001"
    for name, key in (("documents", "doc_id"), ("benchmark", "item_id")):
        rows = spark.read.parquet(f"{folder}/{name}.parquet").select(key, "text").collect()
        given, texts = (list(map(tuple, rows)), texts) if name == "documents" else (given, list(map(tuple, rows)))
    assert compared(spark, given[:400], texts)


def test_a_verbatim_copy_of_a_repeating_item_is_covered_whole(spark):
    item = " ".join([cases.PROSE] * 20)
    n = len(item.split())
    got = compared(spark, [(1, f"Here: {item}")], [(1, item)])
    assert [(r[2], r[3]) for r in got] == [(n, n)]


def test_one_value_per_token_whatever_the_case_does(spark):
    row = spark.createDataFrame([("İSTANBUL 5 km ǅungla ŉ",)], "text string")
    sizes = row.select(*(F.size(f(F.col("text"))) for f in (leaks.template, leaks.values, leaks.folded)))
    assert len(set(sizes.first())) == 1


def test_time_is_linear_in_an_item(spark):
    def seconds(n):
        text = " ".join(f"word{'abcdefghij'[i % 10]} {i} and" for i in range(n // 3))
        frame = leaks.leaks(
            spark.createDataFrame([(1, text)], "doc_id long, text string"),
            spark.createDataFrame([(1, text)], "item_id long, text string"),
        )
        begin = time.time()
        assert [r.n_covered for r in frame.collect()] == [frame.first().n_tokens]
        return time.time() - begin

    seconds(300)
    short, long = seconds(3_000), seconds(60_000)
    assert long < 12 * short + 10
