"""Benchmark decontamination by template windows, in DataFrame functions only.

A text is cut into tokens once, and each token has a value as written and a template: numbers,
capitalised words and units after numbers turn into typed placeholders, everything else is
lower-cased. Windows of ``WINDOW`` template tokens of the benchmark are hash-joined with those of
all documents, so a question asked again with other numbers and names is found as well. Of each
alignment found, tokens are compared exactly and slots are checked: what one value of the item's
slots became must be one value in the document.

What a name is depends on the letter case, so texts are read a second time with their case
folded: only numbers are placeholders, every word stands for itself. Windows of both readings are
looked up in one join from one scan, and what they cover is added.

A document leaks an item if consistent alignments cover ``MIN_TOKENS`` of its tokens or
``MIN_SHARE`` of them, if that is fewer; what templates alone cover is also held against the
share of those tokens that template windows cover. Windows that are mostly placeholders
are looked up by their values as written, with the case folded; an item that has such windows and
``MIN_WHOLE_LITERALS`` words in one is also found whole, with other numbers. Items of fewer than
``MIN_ITEM`` tokens are found as written only.

A window that an item repeats is aligned by its first place, so the work stays linear in the
length of items and texts, and once found it covers all its places. The benchmark's windows are
broadcast up to ``BROADCAST_WINDOWS`` and shuffled beyond; the texts of documents with matches are
fetched by a join of the same kind.

Defined results: null and empty texts and items without a word or number match nothing;
documents are told apart by id and text, so ids may be null or repeated, and repeated rows give
one result; repeated items are one; other columns are not read; empty tables give an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.frames import checkpointed, table

WINDOW = 8
MIN_ITEM = 4
MIN_LITERAL_SHARE = 0.5
MIN_TOKENS = 13
MIN_SHARE = 0.7
#: Conflicting slots allowed, as a share of all different slots.
MAX_CONFLICTS = 0.1
#: Rows (16 bytes each) that may be broadcast.
BROADCAST_WINDOWS = 1_000_000
NUMBER_SLOT, NAME_SLOT, UNIT_SLOT = "0", "1", "2"
SLOTS = (NUMBER_SLOT, NAME_SLOT, UNIT_SLOT)
#: Words that a window must have for its item to be sought whole with other numbers.
MIN_WHOLE_LITERALS = 2
#: Readings of a text: templates, words with their case folded, values as written with their case
#: folded; and one window of folded words that stands for the whole item.
TEMPLATE, FOLDED, EXACT, WHOLE = 0, 1, 2, 3

_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
UNITS = (
    "km cm mm m kg mg g lb lbs oz ml l gal mph kmh kw kwh w v hz mb gb tb "
    "miles mile feet foot ft inches inch yards yard meters metres meter metre kilometers "
    "pounds ounces grams kilograms liters litres hours hour minutes minute seconds second "
    "days day weeks week months month years year dollars dollar cents euros euro percent degrees"
).split()


# ---- tokens -------------------------------------------------------------------------------


def values(text: Column) -> Column:
    """The tokens of a text as written: numbers and runs of letters."""
    return F.regexp_extract_all(text, F.lit(rf"{_NUMBER}|\p{{L}}+"), F.lit(0))


def _bound(value: Column, make) -> Column:
    """``make`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _is_number(token: Column) -> Column:
    plain = token < F.lit("\u0080")
    return F.when(plain, token < F.lit(":")).otherwise(F.rlike(token, F.lit(r"^\p{N}")))


def _numbers(tokens: Column) -> Column:
    return F.transform(tokens, _is_number)


def _is_name(token: Column) -> Column:
    small = (token >= F.lit("a")) & (token < F.lit("{"))
    return ~small & F.rlike(token, F.lit(r"^\p{Lu}\p{Ll}+$"))


def _itself(token: Column) -> Column:
    return token


def _template(tokens: Column, numbers: Column, of=_itself) -> Column:
    """``of`` each template token."""

    def one(token: Column, i: Column) -> Column:
        low = F.lower(token)
        behind_number = (i > 0) & F.get(numbers, i - 1)
        return of(
            F.when(F.get(numbers, i), NUMBER_SLOT)
            .when(behind_number & low.isin(*UNITS), UNIT_SLOT)
            .when(_is_name(token), NAME_SLOT)
            .otherwise(low)
        )

    return F.transform(tokens, one)


def _folded(tokens: Column, numbers: Column, of=_itself) -> Column:
    """``of`` each case-folded word or number slot."""
    return F.transform(
        tokens, lambda t, i: of(F.when(F.get(numbers, i), NUMBER_SLOT).otherwise(F.upper(t)))
    )


def template(text: Column) -> Column:
    """Template tokens of a text, one for each value; a lone 0, 1 or 2 is a number, name or unit."""
    return _bound(values(text), lambda v: _bound(_numbers(v), lambda n: _template(v, n)))


def folded(text: Column) -> Column:
    """Case-folded words and number slots of a text, one for each value."""
    return _bound(values(text), lambda v: _bound(_numbers(v), lambda n: _folded(v, n)))


def _fixed(frame: DataFrame, *columns: Column | str) -> DataFrame:
    """A projection that later ones cannot be merged with: what it computes, it computes once."""
    return frame.select(F.inline(F.array(F.struct(*columns))))


def _tokens(frame: DataFrame, id_column: str, name: str) -> DataFrame:
    """(id, digest of the text, written, tokens, words, exact): all readings of every text.

    Beside them the hashes of the three readings' tokens, by reading: h0, h1 and h2.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    keys = F.col(id_column).alias(name), F.xxhash64(body).alias(f"{name}_text")
    cut = _fixed(frame, *keys, values(body).alias("written"))
    cut = _fixed(cut, name, f"{name}_text", "written", _numbers(F.col("written")).alias("numbers"))
    both = F.col("written"), F.col("numbers")
    return cut.select(
        name, f"{name}_text", "written",
        _template(*both).alias("tokens"),
        _folded(*both).alias("words"),
        F.transform("written", F.upper).alias("exact"),
        _template(*both, F.xxhash64).alias(f"h{TEMPLATE}"),
        _folded(*both, F.xxhash64).alias(f"h{FOLDED}"),
        F.transform("written", lambda t: F.xxhash64(F.upper(t))).alias(f"h{EXACT}"),
    )


# ---- windows ------------------------------------------------------------------------------


def _hash(reading: int, width: int) -> Column:
    """Hash of the window of ``width`` tokens that begins at ``at``, from the tokens' hashes."""
    parts = [F.get(f"h{reading}", F.col("at") + k) for k in range(width)]
    return F.xxhash64(F.lit(reading), F.lit(width), *parts)


def _literals(tokens: str, width: int) -> Column:
    """Tokens of the window at ``at`` that are no slots."""
    flags = [F.when(F.get(tokens, F.col("at") + k).isin(*SLOTS), 0).otherwise(1) for k in range(width)]
    return sum(flags, F.lit(0))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item, item_text, width, reading, hash, at) of all windows that items are sought by."""
    items = _tokens(benchmark, "item_id", "item").where(F.size("tokens") > 0)
    items = items.dropDuplicates(["item", "item_text"])
    items = checkpointed(items.drop("written", "exact"))
    widths = [r[0] for r in items.select(F.least(F.size("tokens"), F.lit(WINDOW))).distinct().collect()]
    placed = items.select("*", F.explode(F.sequence(F.lit(0), F.size("tokens") - 1)).alias("at"))
    size = F.size("tokens")
    rows = None
    for w in sorted(widths) or [WINDOW]:
        own = (size >= WINDOW) if w == WINDOW else (size == w)
        usable = F.lit(w >= MIN_ITEM) & (F.col("literals") >= w * MIN_LITERAL_SHARE)
        readings = [
            (TEMPLATE, _hash(TEMPLATE, w), _literals("tokens", w)),
            (FOLDED, _hash(FOLDED, w), _literals("words", w)),
            (EXACT, _hash(EXACT, w), _literals("words", w)),
        ]
        each = [
            F.struct(F.lit(r).alias("reading"), h.alias("hash"), n.alias("literals"))
            for r, h, n in readings
        ]
        part = placed.where(own & (F.col("at") + w <= size)).select(
            "item", "item_text", F.lit(w).alias("width"), "at", F.inline(F.array(*each))
        )
        part = part.withColumn("use", F.when(F.col("reading") == EXACT, ~usable).otherwise(usable))
        rows = part if rows is None else rows.unionByName(part)
    rows = checkpointed(rows)
    kept = rows.where("use").select("item", "item_text", "width", "reading", "hash", "at")
    # An item's fullest window stands for all of it, if some of its windows are not usable.
    fullest = (
        rows.where((F.col("reading") == FOLDED) & (F.col("width") >= MIN_ITEM))
        .groupBy("item", "item_text", "width")
        .agg(
            F.max(F.struct("literals", (-F.col("at")).alias("back"), "hash")).alias("best"),
            F.min("use").alias("all_usable"),
        )
        .where(~F.col("all_usable") & (F.col("best.literals") >= MIN_WHOLE_LITERALS))
    )
    whole = fullest.select(
        "item", "item_text", "width", F.lit(WHOLE).alias("reading"), "best.hash",
        (-F.col("best.back")).alias("at"),
    )
    return kept.unionByName(whole)


def matches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, doc_text, item, item_text, shift, starts): windows shared at one alignment.

    ``wanted`` has the first places of the items' windows; ``starts`` are readings and places there.
    """
    sought = sorted(
        (r.width, FOLDED if r.reading == WHOLE else r.reading)
        for r in wanted.select("width", "reading").distinct().collect()
    )
    small = wanted.count() <= BROADCAST_WINDOWS
    used = sorted({reading for _, reading in sought}) or [FOLDED]
    found = _tokens(docs, "doc_id", "doc").select("doc", "doc_text", *(f"h{r}" for r in used))
    size = F.size(f"h{used[0]}")
    begins = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array())
    placed = found.select("*", F.explode(begins).alias("at"))
    hashes = [F.when(F.col("at") + w <= size, _hash(r, w)) for w, r in dict.fromkeys(sought)]
    rows = placed.select(
        "doc", "doc_text", "at", F.explode(F.array(*hashes or [F.lit(None).cast("long")])).alias("hash")
    ).withColumnRenamed("at", "place")
    sides = wanted.select("item", "item_text", "reading", "hash", "at")
    return (
        rows.join(F.broadcast(sides) if small else sides, "hash")
        .groupBy("doc", "doc_text", "item", "item_text", (F.col("place") - F.col("at")).alias("shift"))
        .agg(F.collect_set(F.struct("reading", "at")).alias("starts"))
    )


# ---- verdicts -----------------------------------------------------------------------------


def _same(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """A join on columns of one name, in which nulls are equal."""
    renamed = right.withColumnsRenamed({n: f"_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    return left.join(renamed, on, how).drop(*(f"_{n}" for n in names))


def _reach(starts: str) -> str:
    """Tokens covered by windows at ascending ``starts``."""
    return f"""aggregate({starts}, named_struct('n', 0L, 'to', 0), (a, s) -> named_struct(
        'n', a.n + s + width - greatest(s, a.to), 'to', s + width), a -> a.n)"""


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, doc_text, item_id, n_tokens, n_covered, n_slots, changed) of leaking documents.

    ``doc_text`` is the text's 64-bit digest, ``n_slots`` the different slot values compared, and
    ``changed`` says whether any slot has another value than in the item.
    """
    windows = checkpointed(item_windows(benchmark))
    classes = ["item", "item_text", "width", "reading", "hash"]
    first = checkpointed(windows.groupBy(classes).agg(F.min("at").alias("at")))
    shared = checkpointed(matches(docs, first))
    body = F.coalesce(F.col("text"), F.lit(""))
    keys = shared.select("doc", "doc_text").distinct()
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.xxhash64(body) == F.col("doc_text"))
    matched = docs.select("doc_id", "text").join(keys, same, "left_semi").distinct()
    readings = ("written", "tokens", "words", "exact")
    texts = _tokens(matched, "doc_id", "doc").select("doc", "doc_text", *readings).toDF(
        "doc", "doc_text", "our_values", "ours", "our_words", "our_exact"
    )
    items = _tokens(benchmark, "item_id", "item").select("item", "item_text", *readings).toDF(
        "item", "item_text", "their_values", "theirs", "their_words", "their_exact"
    ).dropDuplicates(["item", "item_text"])

    # One row per document and item, so that long texts are not repeated per alignment.
    alignments = shared.groupBy("doc", "doc_text", "item", "item_text").agg(
        F.collect_list(F.struct("shift", "starts")).alias("alignments")
    )
    rows = _same(_same(alignments, texts, "doc", "doc_text"), items, "item", "item_text")
    rows = _fixed(rows, *rows.columns, F.least(F.size("theirs"), F.lit(WINDOW)).alias("width"))

    def starts(reading: int, ours: str, theirs: str) -> str:
        return f"""transform(filter(a.starts, x -> x.reading = {reading} and
            slice({ours}, x.at + a.shift + 1, width) = slice({theirs}, x.at + 1, width)), x -> x.at)"""

    whole = f"""a.shift >= 0 and exists(a.starts, x -> x.reading = {WHOLE})
        and slice(our_words, a.shift + 1, size(their_words)) = their_words"""
    verified = rows.withColumn(
        "alignments",
        F.expr(f"""transform(alignments, a -> struct(a.shift as shift,
            {starts(TEMPLATE, "ours", "theirs")} as templates,
            {starts(FOLDED, "our_words", "their_words")} as folds,
            {starts(EXACT, "our_exact", "their_exact")} as exact,
            {whole} as whole))"""),
    )
    slots = ", ".join(f"'{s}'" for s in SLOTS)

    # Slots as text, kind, whether the value changed, and both values: sets of text are linear.
    def slot_pairs(places: str, theirs: str) -> str:
        return f"""array_distinct(transform(filter({places}, p -> {theirs}[p] in ({slots})),
            p -> concat({theirs}[p],
                if(upper(their_values[p]) = upper(our_values[p + a.shift]), '=', '!'),
                upper(their_values[p]), '\u0001', upper(our_values[p + a.shift]))))"""

    def pairs(starts: str, theirs: str) -> str:
        covered = f"flatten(transform({starts}, s -> sequence(s, s + width - 1)))"
        return slot_pairs(f"array_distinct({covered})", theirs)

    in_whole = slot_pairs("if(a.whole, sequence(0, size(their_words) - 1), array())", "their_words")
    paired = verified.withColumn(
        "alignments",
        F.expr(f"""transform(alignments, a -> struct(a.templates, a.folds, a.exact, a.whole,
            {pairs("a.templates", "theirs")} as template_pairs,
            array_union({pairs("a.folds", "their_words")}, {in_whole}) as fold_pairs,
            {pairs("a.exact", "their_words")} as exact_pairs))"""),
    )

    def consistent(found: str) -> str:
        was = f"transform({found}, x -> concat(left(x, 1), substring_index(substring(x, 3), '\u0001', 1)))"
        return f"size({found}) - size(array_distinct({was})) <= size({found}) * {MAX_CONFLICTS}"

    # Each reading counts where its own slots are consistent.
    kept = paired.withColumn(
        "alignments",
        F.expr(f"""transform(
            transform(alignments, a -> struct(a as a, {consistent("a.template_pairs")} as t,
                {consistent("a.fold_pairs")} as f)),
            x -> struct(
                x.f and x.a.whole as whole,
                array_union(array_union(if(x.t, x.a.template_pairs, array()),
                    if(x.f, x.a.fold_pairs, array())), x.a.exact_pairs) as pairs,
                concat(
                    transform(if(x.t, x.a.templates, array()), s -> struct({TEMPLATE} as reading, s as at)),
                    transform(if(x.f, x.a.folds, array()), s -> struct({FOLDED} as reading, s as at)),
                    transform(x.a.exact, s -> struct({EXACT} as reading, s as at))) as starts))"""),
    ).withColumn("alignments", F.expr("filter(alignments, a -> a.whole or size(a.starts) > 0)"))
    told = _fixed(
        kept.where(F.size("alignments") > 0),
        "doc", "doc_text", "item", "item_text", "width",
        F.size("theirs").cast("long").alias("n_tokens"),
        F.expr("exists(alignments, a -> a.whole)").alias("whole"),
        F.expr("cast(array_max(transform(alignments, a -> size(a.pairs))) as bigint)").alias("n_slots"),
        F.expr(
            "forall(alignments, a -> exists(a.pairs, x -> substring(x, 2, 1) = '!'))"
        ).alias("changed"),
        F.expr("flatten(alignments.starts)").alias("starts"),
    )
    # Each window counts at all its places in the item.
    pair = ["doc", "doc_text", "item", "item_text", "width", "n_tokens", "whole", "n_slots", "changed"]
    # A window is found at many alignments where an item repeats it; it counts once.
    found = told.select(*pair, F.inline_outer("starts")).distinct()
    alike = _same(
        windows, first.withColumnRenamed("at", "first"), *classes
    ).select("item", "item_text", "reading", F.col("first").alias("at"), F.col("at").alias("place"))
    spread = _same(found, alike, "item", "item_text", "reading", "at", how="left")
    place = F.when(F.col("reading") == TEMPLATE, F.col("place"))
    covering = spread.groupBy(pair).agg(
        F.sort_array(F.collect_set("place")).alias("all_places"),
        F.sort_array(F.collect_set(place)).alias("template_places"),
    )
    usable = windows.where(F.col("reading") == TEMPLATE).groupBy("item", "item_text", "width").agg(
        F.sort_array(F.collect_set("at")).alias("usable")
    )
    usable = usable.select("item", "item_text", F.expr(_reach("usable")).alias("n_usable"))
    counted = _same(covering, usable, "item", "item_text", how="left").select(
        *pair,
        F.when(F.col("whole"), F.col("n_tokens")).otherwise(F.expr(_reach("all_places"))).alias("n_covered"),
        F.expr(_reach("template_places")).alias("n_templates"),
        F.coalesce("n_usable", F.lit(0).cast("long")).alias("n_usable"),
    )

    def needed(n: str) -> Column:
        return F.least(F.lit(MIN_TOKENS), F.greatest(F.ceil(F.col(n) * MIN_SHARE), F.col("width")))

    leaking = (F.col("n_covered") >= needed("n_tokens")) | (F.col("n_templates") >= needed("n_usable"))
    return counted.where(leaking).select(
        F.col("doc").alias("doc_id"), "doc_text", F.col("item").alias("item_id"),
        "n_tokens", "n_covered", "n_slots", "changed",
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no benchmark item, with their columns as they are."""
    found = checkpointed(leaks(docs, benchmark).select("doc_id", "doc_text").distinct())
    found = found.withColumnsRenamed({"doc_id": "_leaking_id", "doc_text": "_leaking_text"})
    if found.count() <= BROADCAST_WINDOWS:
        found = F.broadcast(found)
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("_leaking_id")) & (digest == F.col("_leaking_text"))
    return docs.join(found, same, "left_anti")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("doc_text")
