"""Quality rules with Jensen-Shannon distances, in DataFrame functions only.

Two histograms of a document are compared with those of four languages: its characters by
class, and its words as a language's common words and all others, so that common words that are
missing count as divergence. The distance (square root of the Jensen-Shannon divergence in bits,
0 to 1) to the nearest language decides, and each only from a minimum length on, as short texts
have ragged histograms; beyond it one limit holds at every length. The counted rules come first:
too few words, or more than half of the words in repeated 3-word windows.

One narrow stage, no shuffle. The result passes through a one-row generator: a filter on it would
otherwise be pushed down and repeat all its calculations. A window is compared by a 64-bit hash and, where hashes agree, by
its words. Defined results: a null or empty text has no words, counts of 0, null distances and
is rejected for its length; null ids stay null; repeated rows give repeated results; columns
other than the id and the text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.frames import table

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Characters and words from which on the distances decide.
MIN_CHARS = 200
MIN_JUDGED_WORDS = MIN_WORDS
MAX_CLASS_DISTANCE = 0.22
MAX_WORD_DISTANCE = 0.33
#: Share of a running text that its language's listed common words make up.
COMMON_SHARE = 0.3

BLANK = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]+"
# Character classes; what none of them takes (small letters, other scripts) is one more.
CLASSES = {
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "blank": BLANK,
    "punctuation": "[.,;:!?'\"()-]+",
    "symbol": r"[#*$%&|<>@^~`=+_/\\{}\[\]]+",
}
# Usual shares of these classes, in their order, in running text.
CLASS_SHARES = {
    "en": (0.025, 0.005, 0.170, 0.030, 0.002),
    "de": (0.045, 0.005, 0.150, 0.030, 0.002),
    "fr": (0.025, 0.005, 0.165, 0.030, 0.002),
    "es": (0.025, 0.005, 0.170, 0.030, 0.002),
}
# The most common words of each language, most frequent first.
COMMON = {
    "en": "the of and to in a is that it for was on with as be by this are from at".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur plus pas au".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}


def class_reference(language: str) -> list[float]:
    shares = CLASS_SHARES[language]
    return [*shares, 1.0 - sum(shares)]


def word_reference(language: str) -> list[float]:
    """Shares falling with the rank, as word frequencies do; that of all other words comes last."""
    weights = [1.0 / (rank + 1) for rank in range(len(COMMON[language]))]
    return [*(COMMON_SHARE * w / sum(weights) for w in weights), 1.0 - COMMON_SHARE]


def divergence(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram of counts from fixed shares."""

    def part(count: Column, share: Column) -> Column:
        p = count / total
        middle = (p + share) / 2
        own = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
        return (own + share * F.log2(share / middle)) / 2

    parts = F.zip_with(counts, F.array(*map(F.lit, reference)), part)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))


def _repeated_words() -> Column:
    """Words in 3-word windows that occur twice, from ``words``; sorts only where some do."""
    return F.expr("""
        case when size(windows) = size(array_distinct(windows)) then 0L else
        aggregate(
            sort_array(flatten(transform(
                array(sort_array(transform(windows, (h, i) -> struct(h as h, i as i)))),
                s -> transform(
                    filter(
                        transform(s, (x, j) -> struct(
                            x.i as i,
                            (j > 0 and s[j - 1].h = x.h
                                and words[s[j - 1].i] = words[x.i]
                                and words[s[j - 1].i + 1] = words[x.i + 1]
                                and words[s[j - 1].i + 2] = words[x.i + 2])
                            or (j < size(s) - 1 and s[j + 1].h = x.h
                                and words[s[j + 1].i] = words[x.i]
                                and words[s[j + 1].i + 1] = words[x.i + 1]
                                and words[s[j + 1].i + 2] = words[x.i + 2]) as twice)),
                        x -> x.twice),
                    x -> x.i)))),
            named_struct('n', 0L, 'covered', -1),
            (a, i) -> named_struct(
                'n', a.n + i + 3 - greatest(i, a.covered),
                'covered', i + 3),
            a -> a.n) end""")


def quality_rules(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the counts, the distances and the verdict of every document.

    Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    class_distance, word_distance (null below the minimum lengths), kept.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.struct(*keep).alias("row"), text.alias("body"))
    split = base.select(
        "row",
        "body",
        F.array_remove(F.split("body", BLANK), "").alias("words"),
    )
    vocabulary = sorted({w for words in COMMON.values() for w in words})
    listed = split.select(
        "row",
        "body",
        "words",
        F.expr(
            "transform(sequence(0, greatest(size(words) - 3, 0)), i -> xxhash64("
            "get(words, i), get(words, i + 1), get(words, i + 2)))"
        ).alias("windows"),
        F.filter(F.split("body", "\n"), lambda l: F.rlike(l, F.lit(r"[^ \t-\r]"))).alias("lines"),
        F.sort_array(
            F.filter(F.transform("words", F.lower), lambda w: w.isin(*vocabulary))
        ).alias("common"),
    )
    length = F.length("body")
    counts = [length - F.length(F.regexp_replace("body", c, "")) for c in CLASSES.values()]
    counted = listed.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (length - F.length(F.regexp_replace("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") < 4, F.lit(0)).otherwise(_repeated_words()).cast("long").alias(
            "n_repeat_words"
        ),
        length.alias("n_chars"),
        F.array(*counts).alias("classes"),
        "common",
        F.expr(
            "filter(transform(common, (w, i) -> i), i -> i = 0 or common[i] <> common[i - 1])"
        ).alias("runs"),
    )
    counted = counted.withColumn(
        "common",
        F.expr(
            "map_from_arrays(transform(runs, i -> common[i]), transform(runs, (i, k) -> "
            "coalesce(get(runs, k + 1), size(common)) - i))"
        ),
    )
    rest = F.col("n_chars") - F.aggregate("classes", F.lit(0), lambda a, b: a + b)
    own = [
        F.transform(F.array(*map(F.lit, words)), lambda w: F.coalesce(F.col("common")[w], F.lit(0)))
        for words in COMMON.values()
    ]
    counted = counted.withColumns({
        "classes": F.concat("classes", F.array(rest)),
        "by_language": F.transform(
            F.array(*own),
            lambda x: F.concat(
                x,
                F.array(F.col("n_words").cast("int") - F.aggregate(x, F.lit(0), lambda a, b: a + b)),
            ),
        ),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    by_class = [
        divergence(F.col("classes"), F.col("n_chars"), class_reference(language))
        for language in COMMON
    ]
    nearest = [
        divergence(F.col("by_language")[i], F.col("n_words"), word_reference(language))
        for i, language in enumerate(COMMON)
    ]
    judged = counted.select(
        "row",
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        failed.alias("base_failed"),
        F.when(F.col("n_chars") >= MIN_CHARS, F.least(*by_class)).alias("class_distance"),
        F.when(F.col("n_words") >= MIN_JUDGED_WORDS, F.least(*nearest)).alias("word_distance"),
    )
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE
    )
    verdict = judged.withColumn("kept", ~F.col("base_failed") & fits).drop("n_chars")
    return verdict.select(F.inline(F.array(F.struct("*")))).select("row.*", *verdict.columns[1:])


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with their columns as they are."""
    judged = quality_rules(docs.select(F.struct("*").alias("document"), "text"), "document")
    return judged.where("kept").select("document.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), "doc_id")
    return judged.withColumns(
        {c: F.round(c, 6) for c in ("class_distance", "word_distance")}
    )


def oracle_sql(source: str = "documents") -> str:
    """The query in DuckDB's SQL, over a table or a subquery with doc_id and text."""
    blank = r"[ \t\n\x0B\x0C\r]+"
    classes = [c.replace(BLANK, blank).replace("'", "''") for c in CLASSES.values()]
    counts = ", ".join(f"length(body) - length(regexp_replace(body, '{c}', '', 'g'))" for c in classes)
    shares = ", ".join(
        f"('{x}', [{', '.join(map(repr, class_reference(x)))}])" for x in COMMON
    )
    words = ", ".join(
        f"('{x}', '{w}', {s!r})"
        for x in COMMON
        for w, s in zip(COMMON[x], word_reference(x))
    )
    languages = ", ".join(f"('{x}')" for x in COMMON)
    term = (
        "(case when {p} > 0 then {p} * log2({p} / (({p} + {q}) / 2)) else 0 end"
        " + {q} * log2({q} / (({p} + {q}) / 2))) / 2"
    )
    return f"""
with body as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as body from {source}),
split as (
    select *, list_filter(regexp_split_to_array(body, '{blank}'), lambda x: x <> '') as words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\x0C\r]')) as lines,
        [{counts}] as counted, length(body) as n_chars
    from body),
tokens as (
    select rid, unnest(words) as word, unnest(range(0, len(words))) as i from split),
starts as (
    select rid, i, word as a, lead(word) over place as b, lead(word, 2) over place as c
    from tokens window place as (partition by rid order by i)),
windows as (
    select rid, i, count(*) over (partition by rid, a, b, c) as n from starts where c is not null),
repeated as (
    select rid, count(distinct i + o) as n_repeat_words
    from windows cross join (values (0), (1), (2)) as offsets(o) where n > 1 group by rid),
class_reference(language, shares) as (values {shares}),
class_distances as (
    select rid, min(sqrt(greatest(0, distance))) as class_distance from (
        select rid, language, sum({term.format(p="p", q="q")}) as distance from (
            select rid, language, unnest(list_append(counted, n_chars - list_sum(counted)))
                / n_chars::double as p, unnest(shares) as q
            from split cross join class_reference where n_chars >= {MIN_CHARS})
        group by rid, language) group by rid),
word_reference(language, word, share) as (values {words}),
tally as (
    select rid, word, count(*) as n from (select rid, lower(unnest(words)) as word from split)
    group by rid, word),
languages(language) as (values {languages}),
shares as (
    select s.rid, l.language, r.word, r.share, len(s.words)::double as n_words
    from split s cross join languages l join word_reference r using (language)
    where len(s.words) >= {MIN_JUDGED_WORDS}),
listed as (
    select s.rid, s.language, s.share, coalesce(t.n, 0) as n, s.n_words
    from shares s left join tally t on t.rid = s.rid and t.word = s.word),
bins as (
    select rid, language, share as q, n / n_words as p from listed
    union all
    select rid, language, 1.0 - {COMMON_SHARE}, (any_value(n_words) - sum(n)) / any_value(n_words)
    from listed group by rid, language),
word_distances as (
    select rid, min(sqrt(greatest(0, distance))) as word_distance from (
        select rid, language, sum({term.format(p="p", q="q")}) as distance
        from bins group by rid, language) group by rid),
counts as (
    select s.rid, doc_id, len(words)::bigint as n_words,
        length(array_to_string(words, ''))::bigint as word_chars,
        (length(body) - length(regexp_replace(body, '{SYMBOLS}', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words, n_chars,
        class_distance, word_distance
    from split s left join repeated using (rid) left join class_distances using (rid)
        left join word_distances using (rid)),
judged as (
    select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed
    from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    round(class_distance, 6) as class_distance, round(word_distance, 6) as word_distance,
    not base_failed and coalesce(class_distance, 0) <= {MAX_CLASS_DISTANCE}
        and coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} as kept
from judged"""
