"""Spelling variants: words one edit apart, found through an index of variable-length grams.

1. **Gram dictionary.** Grams of ``SHORTEST`` to ``LONGEST`` characters are counted over the words;
   kept are the *frequent* ones, in more than ``FREQUENT`` of all words. A gram is read at every
   place of a word and is lengthened as long as what is read so far is frequent, so rare grams
   stay short and common ones grow; grams inside an earlier one are left out. There are fewer
   than (characters of a word) / ``FREQUENT`` frequent grams, whatever the number of words.
2. **Affected grams.** For every place of a word where an edit can happen, a bound of the grams
   that it can touch or change follows from their places: all that end before ``LONGEST``
   characters left of it, and all right of it that reach ``LONGEST`` characters beyond, are the same
   in both words. Two words one edit apart share, for its place, *all* these unaffected grams.
3. **Merging.** So the lists of a place's unaffected grams are merged at once: what those on the
   left and those on the right span is one key, and words are grouped by key, which meets exactly
   those that share all of them. A word has one key per different span of its characters, for words
   of its own length or one less, and one per different span of its gaps, for words of one more.
   Grams take at most half of the shorter word, so every place leaves one unaffected at least and
   no key is empty. Keys are shuffled once, as numbers with their words, and met in sorted order.
4. **Verifying.** Words that meet are compared where they meet, and only pairs one edit apart go on,
   so keys that share a number cost work but change nothing.
5. **Crowded keys.** A key of more than ``CROWDED`` words is split by the exact place: its words
   take one key per place, the rest of the word left and right of it. Words sharing such a key are
   all one edit apart, so what is met is what is returned, and no pair is dropped.

Words are counted per batch before they are shuffled, so a frequent word is one row per batch.

Defined results: a null or empty text has no words; a null id counts as empty text; repeated rows
count again; other columns are not read; an empty table gives an empty result. Ties of forms go to
the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.frames import checkpointed, table, text_bytes, written

MIN_LENGTH, MIN_COUNT = 7, 2
SHORTEST, LONGEST = 2, 4
#: Share of all words that a gram must exceed to be lengthened.
FREQUENT = 1 / 400
CROWDED = 50
#: Roles of a word in a key.
OUT, GAP = 0, 1
#: A form has at least so many times the occurrences of its variant.
RATIO = 10
#: One run in so many, by its checksum, loses a character.
LOSSY = 31
#: Different words that a task holds before it gives out their counts.
_HELD = 300_000
#: Characters of a text searched at once.
_SEGMENT = 1 << 20
#: Characters of a word up to which words are compared side by side, and pairs compared at once.
_WIDE, _PAIRS = 48, 100_000
_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")


# ---- words --------------------------------------------------------------------------------


def runs(text: str) -> Iterator[list[str]]:
    """Maximal runs of a lower-cased text, in lists of about ``_SEGMENT`` characters."""
    begin = 0
    while begin < len(text):
        cut = _OTHER.search(text, begin + _SEGMENT) if len(text) - begin > _SEGMENT else None
        end = cut.start() if cut else len(text)
        yield _RUN.findall(text, begin, end)
        begin = end


def lossy(doc_id: str, run: str) -> str:
    """The run, or what is left of it once the checksum of id and run deletes a character."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % LOSSY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
            names=["word", "n"],
        )
        held.clear()
        return out

    for batch in batches:
        for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own: Counter = Counter()
            for part in runs((body or b"").lower().decode()):
                own.update(part)
            for run, n in own.items():
                if len(run) >= MIN_LENGTH:
                    word = lossy(i, run)
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
            if len(held) > _HELD:
                yield flush()
    if held:
        yield flush()


def words(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with ``least`` occurrences."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    bodies = text_bytes(docs.select(name, "text"), "id")
    parts = bodies.mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- grams --------------------------------------------------------------------------------


def frequent_grams(vocabulary: DataFrame, longest: int = LONGEST, share: float = FREQUENT) -> frozenset:
    """Grams shorter than ``longest`` in more than ``share`` of the words; a bounded set."""
    total = vocabulary.count()
    sizes = F.sequence(F.lit(SHORTEST), F.lit(longest - 1))
    own = F.flatten(
        F.transform(
            sizes,
            lambda q: F.transform(
                F.sequence(F.lit(1), F.length("word") - q + 1), lambda i: F.substring("word", i, q)
            ),
        )
    )
    counts = vocabulary.select(F.explode(F.array_distinct(own)).alias("gram")).groupBy("gram").count()
    found = counts.where(F.col("count") > total * share).select("gram").collect()
    return frozenset(r.gram for r in found)


def grams(word: str, frequent: frozenset, longest: int) -> list[tuple[int, int]]:
    """(begin, end) of the word's variable grams, none inside another."""
    found, reach, n = [], 0, len(word)
    for begin in range(n - SHORTEST + 1):
        end = begin + SHORTEST
        while end - begin < longest and end < n and word[begin:end] in frequent:
            end += 1
        if end > reach:
            found.append((begin, end))
            reach = end
    return found


def unaffected(found: list[tuple[int, int]], n: int, longest: int, gap: bool) -> set[tuple[int, int]]:
    """Spans (end on the left, begin on the right) of the grams no edit at a place can affect.

    Places are the characters of a word of ``n``, or with ``gap`` the gaps between them, where
    the other word has one more. Grams ascend at both ends, so one walk serves all places.
    """
    spans, width, last = set(), 0 if gap else 1, len(found)
    i = j = left = 0
    for place in range(n + 1 if gap else n):
        while i < last and found[i][0] + longest <= place:
            left = found[i][1]
            i += 1
        behind = place + width
        while j < last and (found[j][0] < behind or found[j][1] < behind + longest):
            j += 1
        spans.add((left, found[j][0] if j < last else n))
    return spans


def keys(word: str, frequent: frozenset, longest: int = LONGEST) -> Iterator[tuple[str, int]]:
    """(key, role) of a word: ``OUT`` with a character left out, or ``GAP`` with one to be put in.

    A key names the length without the character and both sides of the place. Words meet in the
    same key, unless both are there by a gap.
    """
    n = len(word)
    for size, role in ((n - 1, OUT), (n, GAP)):
        if role == OUT and size < MIN_LENGTH - 1:
            continue
        most = max(SHORTEST, min(longest, (max(size, MIN_LENGTH) - 1) // 2))
        for left, right in unaffected(grams(word, frequent, most), n, most, role == GAP):
            yield f"{size} {word[:left]} {word[right:]}", role


def exact_keys(word: str, role: int) -> Iterator[tuple[str, int]]:
    """Keys of the places themselves, for a word that is in a crowded key by this role."""
    for place in range(len(word) + (role == GAP)):
        yield f"! {word[:place]} {word[place + (role == OUT) :]}", role


def _keyed(make: Callable[..., Iterator[tuple[str, int]]]):
    """``_MEMBERS`` from rows of a word, its count, and what else ``make`` takes.

    The lowest bit of ``told`` says by which role a word is there, the rest is its count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            # A word gives some twenty keys, so a batch is taken in parts.
            for a in range(0, batch.num_rows, 5_000):
                part = batch.slice(a, 5_000)
                words, counts, *more = (c.to_pylist() for c in part.columns)
                found, told, row = array("Q"), array("q"), array("l")
                for i, (word, n, *own) in enumerate(zip(words, counts, *more)):
                    for key, role in make(word, *own):
                        found.append(digest(key))
                        told.append(2 * n + role)
                        row.append(i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(found, np.uint64).view(np.int64)),
                        pa.array(np.array(told, np.int64)),
                        part.column(0).take(pa.array(np.array(row, np.int64))),
                    ],
                    names=["key", "told", "word"],
                )

    return run


_MEMBERS = "key long, told long, word string"


# ---- pairs --------------------------------------------------------------------------------


def one_edit(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``words[a]`` and ``words[b]`` are one edit apart."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    swap = sizes[a] > sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    more, out = sizes[b] - sizes[a], np.zeros(len(a), bool)
    wide = sizes[b] > _WIDE
    for i in np.flatnonzero(wide & (more <= 1)).tolist():
        short, long = words[a[i]], words[b[i]]
        at = next((k for k, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
        out[i] = short != long and short[at + 1 - more[i] :] == long[at + 1 :]
    left = np.flatnonzero(~wide & (more <= 1))
    if not len(left):
        return out
    width = int(sizes[b[left]].max()) + 1
    chars = np.where(sizes < width, words, "").astype(f"U{width}").view(np.uint32).reshape(-1, width)
    for begin in range(0, len(left), _PAIRS):
        part = left[begin : begin + _PAIRS]
        short, long = chars[a[part]], chars[b[part]]
        same = short == long
        replaced = (more[part] == 0) & ((~same).sum(axis=1) == 1)
        # Behind the first difference, the longer word must go on as the shorter one does.
        at = np.argmin(same, axis=1)[:, None]
        behind = (long[:, 1:] == short[:, :-1]) | (np.arange(width - 1) < at)
        out[part] = replaced | ((more[part] == 1) & behind.all(axis=1))
    return out


def _meet(crowded: int | None):
    """(a, b, a_told, b_told) of words that share a key and are one edit apart, from rows sorted
    by key; of crowded keys (a, null). Holds a batch and the last key's words, at most ``crowded``.
    """

    def told(*columns) -> pa.RecordBatch:
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [
            pa.nulls(len(columns[0]), t) if c is None else pa.array(c, t) for c, t in zip(columns, types)
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "a_told", "b_told"])

    def met(key: np.ndarray, state: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        size = np.diff(np.r_[begin, len(key)])
        over = size > (len(key) if crowded is None else crowded)
        if over.any():
            full = np.repeat(over, size)
            yield told(word[full], None, state[full], None)
        fine = np.repeat(~over & (size > 1), size)
        key, state, word = key[fine], state[fine], word[fine]
        pairs = []
        for step in range(1, len(key)):
            at = np.flatnonzero(key[:-step] == key[step:])
            if not len(at):
                break
            at = at[(state[at] & state[at + step] & 1) != GAP]
            pairs.append((at, at + step))
        if pairs:
            a, b = (np.concatenate(side) for side in zip(*pairs))
            near = one_edit(word, a, b)
            a, b = a[near], b[near]
            swap = word[a] > word[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            yield told(word[a], word[b], state[a], state[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, full = None, None
        for batch in batches:
            rows = [np.asarray(batch.column(i)) for i in range(2)]
            rows.append(batch.column(2).to_numpy(zero_copy_only=False))
            if full is not None:
                same = rows[0] == full
                yield told(rows[2][same], None, rows[1][same], None)
                rows = [r[~same] for r in rows]
                if len(rows[0]):
                    full = None
            if held:
                rows = [np.r_[h, r] for h, r in zip(held, rows)]
            key = rows[0]
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from met(*(r[:last] for r in rows))
            held = [r[last:] for r in rows]
            if crowded is not None and len(held[0]) > crowded:
                yield told(held[2], None, held[1], None)
                full, held = int(held[0][0]), None
        if held:
            yield from met(*held)

    return run


def _met(keyed: DataFrame, crowded: int | None) -> DataFrame:
    rows = keyed.repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_meet(crowded), "a string, b string, a_told long, b_told long")


def near_pairs(vocabulary: DataFrame, longest: int = LONGEST, crowded: int = CROWDED) -> DataFrame:
    """(a, b, a_n, b_n): all pairs of words one edit apart, each once, from (word, n)."""
    frequent = vocabulary.sparkSession.sparkContext.broadcast(frequent_grams(vocabulary, longest))

    def spans(word: str) -> Iterator[tuple[str, int]]:
        return keys(word, frequent.value, longest)

    keyed = vocabulary.select("word", "n").mapInArrow(_keyed(spans), _MEMBERS)
    met = written(_met(keyed, crowded), "variants")
    role, count = F.col("a_told").bitwiseAND(F.lit(1)).cast("int"), F.shiftright("a_told", 1)
    hot = met.where("b is null").select(F.col("a").alias("word"), count.alias("n"), role.alias("role"))
    exact = _met(hot.distinct().mapInArrow(_keyed(exact_keys), _MEMBERS), None)
    found = met.where("b is not null").unionByName(exact)
    return found.select(
        "a", "b", F.shiftright("a_told", 1).alias("a_n"), F.shiftright("b_told", 1).alias("b_n")
    ).distinct()


# ---- forms --------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), each root reached by doubling steps.

    A form has ``RATIO`` times the occurrences of its word, so chains are short and never close.
    """
    paths = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = paths.join(further, "root", "left")
        step = checkpointed(
            joined.select("word", F.coalesce("beyond", "root").alias("root"),
                          F.col("beyond").isNotNull().alias("moved"))
        )
        paths = step.select("word", "root")
        if step.where("moved").isEmpty():
            return paths


def variants(
    docs: DataFrame, least: int = MIN_COUNT, ratio: int = RATIO, crowded: int = CROWDED
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs``."""
    vocabulary = written(words(docs, least), "vocabulary")
    pairs = written(near_pairs(vocabulary, crowded=crowded), "variants")
    near = pairs.select("a", "b", F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("other_n"))
    )
    # The most frequent neighbour, of equals the smallest.
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("b").alias("other"))).alias("best")
    most = near.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    told = vocabulary.join(most, "word", "left").select(
        "word", "n", "n_near", F.col("best.other").alias("other"), (-F.col("best.rank")).alias("other_n")
    )
    told = told.withColumn(
        "is_variant", F.coalesce(F.col("other_n") >= F.col("n") * ratio, F.lit(False))
    )
    found = written(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("is_variant"), F.col("other")).alias("form"),
            F.when(F.col("is_variant"), F.col("other_n")).alias("form_n"),
        ),
        "variants",
    )
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
