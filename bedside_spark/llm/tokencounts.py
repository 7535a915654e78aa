"""Token counts that follow edits: segment trees over pre-tokens.

A text is cut into pre-tokens by the tokenizer's pattern; ids of different pre-tokens are
independent, so a text has as many tokens as its pre-tokens together. A document's tree has
blocks of pre-tokens as leaves, and every node knows the characters and tokens below it. An edit
finds its block by descending, cuts again from the first pre-token whose cut can have looked at
the edited characters until a cut falls on an old one behind the edit, encodes only those
pre-tokens, and updates the sums on the way up.

Defined results: a null or empty text has 0 tokens; null edits are none; a start beyond the text
means its end, a length beyond it the rest; negative numbers count as 0 and a null replacement as
empty; a null id stays null; repeated rows give repeated results; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.frames import table

#: Pre-tokens in a leaf, and the number at which a leaf makes the tree be laid out anew.
LEAF, FULL = 64, 256
#: Characters behind a pre-token that its cut may depend on: two of a contraction such as 're.
LOOKAHEAD = 2
#: Different pre-tokens whose counts a worker remembers.
REMEMBERED = 500_000
EDITS = 3
MAX_EDIT = 24


class Counter:
    """Number of tokens of a pre-token, by a byte-level BPE."""

    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "public", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, parts: list[str]) -> list[int]:
        known, encode = self.known, self.encoding.encode_ordinary
        if len(known) > REMEMBERED:
            known.clear()
        for part in set(parts).difference(known):
            known[part] = len(encode(part))
        return [known[part] for part in parts]


class Tree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text, self.encoded = counter, text, 0
        parts = counter.pattern.findall(text)
        self._lay_out(list(map(len, parts)), counter.counts(parts))

    def _lay_out(self, lengths: list[int], counts: list[int]) -> None:
        cuts = range(0, len(lengths), LEAF)
        self.leaves = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in cuts] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (own_lengths, own_counts) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(own_lengths), sum(own_counts)
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def _put(self, leaf: int, lengths: list[int], counts: list[int]) -> None:
        self.leaves[leaf] = (lengths, counts)
        node = self.size + leaf
        self.chars[node], self.tokens[node] = sum(lengths), sum(counts)
        while node > 1:
            node //= 2
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, place: int) -> tuple[int, int, int]:
        """(leaf, index, start) of the first pre-token that ends at ``place`` or later."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if self.chars[node] + start < place:
                start += self.chars[node]
                node += 1
        leaf, index = node - self.size, 0
        if leaf >= len(self.leaves):
            leaf = len(self.leaves) - 1
            return leaf, len(self.leaves[leaf][0]), start
        lengths = self.leaves[leaf][0]
        while index < len(lengths) and start + lengths[index] < place:
            start += lengths[index]
            index += 1
        return leaf, index, start

    def edit(self, start: int, length: int, replacement: str) -> None:
        start = min(max(0, start), len(self.text))
        length = min(max(0, length), len(self.text) - start)
        first_leaf, first, begin = self._find(max(0, start - LOOKAHEAD))
        shift = len(replacement) - length
        self.text = self.text[:start] + replacement + self.text[start + length :]
        # Old cuts from ``begin`` on, walked along with the new ones.
        leaf, index, old = first_leaf, first, begin
        parts: list[str] = []
        place, behind = begin, start + len(replacement)
        for found in self.counter.pattern.finditer(self.text, begin):
            if place >= behind:
                while old + shift < place and leaf < len(self.leaves):
                    if index < len(self.leaves[leaf][0]):
                        old += self.leaves[leaf][0][index]
                        index += 1
                    else:
                        leaf, index = leaf + 1, 0
                if old + shift == place and old >= start + length:
                    break
            parts.append(found[0])
            place = found.end()
        else:
            leaf, index = len(self.leaves) - 1, len(self.leaves[-1][0])
        if leaf >= len(self.leaves):
            leaf, index = len(self.leaves) - 1, len(self.leaves[-1][0])
        self.encoded += len(parts)
        head, tail = self.leaves[first_leaf], self.leaves[leaf]
        lengths = head[0][:first] + list(map(len, parts)) + tail[0][index:]
        counts = head[1][:first] + self.counter.counts(parts) + tail[1][index:]
        for emptied in range(first_leaf + 1, leaf + 1):
            self._put(emptied, [], [])
        self._put(first_leaf, lengths, counts)
        if len(lengths) > FULL:
            every = self.leaves
            self._lay_out([n for own, _ in every for n in own], [c for _, own in every for c in own])


def read_ranks(path: str | None = None) -> bytes:
    """The rank file, read once by the driver and sent along with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        return file.read()


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


_RESULT = ("n_tokens", "n_edits", "n_tokens_edited", "n_encoded")
_EDITS = "array<struct<start:int,length:int,replacement:string>>"


def count_tokens(
    docs: DataFrame, ranks: bytes | None = None, pattern: str | None = None
) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_edited, n_encoded) of documents with ``edits``.

    ``edits`` (start, length, replacement) are applied in order, each to the text as the ones
    before left it, in characters. ``n_encoded`` is how many pre-tokens the edits encoded.
    """
    ranks, pattern = ranks or read_ranks(), pattern or public_pattern()
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in batches:
            rows = []
            for text, edits in zip(batch.column(1), batch.column(2)):
                tree = Tree(counter, text.as_py() or "")
                before, edits = tree.total, edits.as_py() or []
                for e in edits:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                rows.append((before, len(edits), tree.total, tree.encoded))
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", *_RESULT],
            )

    rows = docs.select("doc_id", "text", F.col("edits").cast(_EDITS))
    return rows.mapInArrow(run, f"doc_id {key}, {', '.join(f'{c} long' for c in _RESULT)}")


def with_edits(docs: DataFrame, count: int = EDITS) -> DataFrame:
    """``docs`` with edits drawn from the documents: short cuts and moved passages.

    Places and lengths come from hashes of the id and the edit's number; what is inserted is a
    passage of the same text.
    """
    size = F.length(F.coalesce("text", F.lit("")))

    def drawn(i, salt: str, below):
        return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), i, F.lit(salt)), below).cast("int")

    def one(i):
        passage = F.substring("text", drawn(i, "from", size + 1) + 1, drawn(i, "long", F.lit(MAX_EDIT)))
        return F.struct(
            drawn(i, "start", size + 1).alias("start"),
            drawn(i, "cut", F.lit(MAX_EDIT)).alias("length"),
            passage.alias("replacement"),
        )

    edits = F.transform(F.sequence(F.lit(1), F.lit(count)), one)
    return docs.select("doc_id", "text", edits.alias("edits"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(with_edits(table(spark, sf_dir, "documents")))
