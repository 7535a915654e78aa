"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

``Pieces`` encodes whole texts without a sentencepiece call: blanks become the piece mark, the
distinct words of a slice are laid into flat symbol arrays, and each round takes the best pair
of every word (a segmented minimum of pair ranks), merges it in all words at once and compacts
the arrays, until no pair is left. Merging is that of the library: best score first, leftmost
among equals. Several occurrences of a word's best pair merge in one round only where no piece
of an equal or better score contains the merged one, as then no merge can come in between;
elsewhere only the leftmost does. Words that need more than ``ROUNDS`` rounds (long runs of
blanks) are finished by a heap in the same order.

``encode(docs)`` and ``decode(encoded)`` are the operators. Defined results: a null or empty
text has no ids and decodes to an empty text; unknown characters become byte pieces; a null id
stays null; repeated rows give repeated results; further columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from bedside_spark.llm.arrays import slices
from bedside_spark.llm.frames import table

MARK = "▁"
ROUNDS = 256
#: Distinct words a worker remembers between slices.
REMEMBERED = 200_000
_NONE = np.int32(2**31 - 1)


class Pieces:
    """Tables of a BPE model with byte pieces, and encoding and decoding by them."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        scores = [library.get_score(i) for i in range(n)]
        silent = {i for i in range(n) if library.is_control(i) or library.is_unknown(i)}
        byte_ids = {i: int(names[i][3:5], 16) for i in range(n) if library.is_byte(i)}
        if len(byte_ids) != 256 or any(library.is_unused(i) for i in range(n)):
            raise ValueError("only BPE models with byte pieces and without unused pieces")
        self.byte_id = np.zeros(256, np.int32)
        for i, value in byte_ids.items():
            self.byte_id[value] = i
        self.unknown = library.unk_id()
        self._pairs(
            {names[i]: i for i in range(n) if i not in silent and i not in byte_ids}, scores, n
        )
        surface = [
            bytes([byte_ids[i]]) if i in byte_ids
            else " ⁇ ".encode() if i == self.unknown
            else b"" if i in silent
            else names[i].replace(MARK, " ").encode()
            for i in range(n)
        ]
        self.size = np.array([len(s) for s in surface])
        self.begin = np.cumsum(self.size) - self.size
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[list(byte_ids)] = True
        self.silent = np.zeros(n, bool)
        self.silent[list(silent - {self.unknown})] = True
        self.known: dict[str, int] = {}
        self._forget()

    def _pairs(self, ids: dict[str, int], scores: list[float], n: int) -> None:
        symbols = dict(ids)
        for char in sorted({c for name in ids for c in name} - set(ids)):
            symbols[char] = n + len(symbols) - len(ids)
        self.symbols = n + len(symbols) - len(ids) + 1
        order = sorted({-scores[i] for i in ids.values()})
        rank_of = {score: rank for rank, score in enumerate(order)}
        rank = {name: rank_of[-scores[i]] for name, i in ids.items()}
        alone = np.bincount(list(rank.values()), minlength=len(order)) == 1
        keys, merged, ranks = [], [], []
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.symbols + right)
                    merged.append(i)
                    ranks.append(rank[name])
            for start in range(len(name)):
                for end in range(start + 2, len(name) + (start > 0)):
                    part = rank.get(name[start:end])
                    if part is not None and rank[name] <= part:
                        alone[part] = False
        by_key = np.argsort(np.array(keys, np.int64))
        self.pair_key = np.array(keys, np.int64)[by_key]
        self.pair_id = np.array(merged, np.int32)[by_key]
        self.pair_rank = np.array(ranks, np.int32)[by_key]
        self.together = alone
        self.char_id = np.full(0x110000, -1, np.int32)
        for name, i in symbols.items():
            if len(name) == 1:
                self.char_id[ord(name)] = i
        self.whole = n
        #: Characters of the symbols that only stand for themselves, once they are needed.
        self.spelled: dict[int, int] | None = None
        bigrams = {name[i : i + 2] for name in ids for i in range(len(name) - 1)}
        marks_end_words = not any(b[1] == MARK and b[0] != MARK for b in bigrams)
        stops = "" if any("\n" in b for b in bigrams) else "\n"
        self.split = (
            re.compile(f"{MARK}+[^{MARK}{stops}]*|[^{MARK}{stops}]+|\n")
            if marks_end_words
            else re.compile("(?s).+")
        )

    def _forget(self) -> None:
        self.known.clear()
        self.text: list[str] = []
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into the pair tables, or -1."""
        key = left.astype(np.int64) * self.symbols + right
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        fits = (left >= 0) & (right >= 0) & (self.pair_key[at] == key)
        return np.where(fits, at, -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word of each) after all merges; unknown characters are ``-1 - code``."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.char_id[codes]
        symbol = np.where(symbol < 0, -1 - codes.astype(np.int32), symbol)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        pair = np.full(len(symbol), -1, np.int64)
        same = word[1:] == word[:-1]
        pair[:-1] = np.where(same, self._lookup(symbol[:-1], symbol[1:]), -1)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(ROUNDS):
            rank = np.where(pair >= 0, self.pair_rank[pair], _NONE)
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: len(word)])
            if not len(heads):
                break
            best = np.minimum.reduceat(rank, heads)
            lengths = np.diff(np.r_[heads, len(word)])
            live = np.repeat(best != _NONE, lengths)
            if not live.all():
                done.append((symbol[~live], word[~live]))
                symbol, word, pair, rank = symbol[live], word[live], pair[live], rank[live]
                lengths, best = lengths[best != _NONE], best[best != _NONE]
                if not len(symbol):
                    break
            place = np.flatnonzero(rank == np.repeat(best, lengths))
            own = word[place]
            first = np.r_[True, own[1:] != own[:-1]]
            run = np.r_[True, np.diff(place) != 1]
            index = np.arange(len(place))
            even = (index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0
            place = place[np.where(self.together[rank[place]], even, first)]
            symbol[place] = self.pair_id[pair[place]]
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            place = (np.cumsum(keep) - 1)[place]
            symbol, word, pair = symbol[keep], word[keep], pair[keep]
            touched = np.unique(np.r_[place, place[place > 0] - 1])
            last = touched == len(symbol) - 1
            inner = touched[~last]
            pair[touched] = -1
            inner = inner[word[inner] == word[inner + 1]]
            pair[inner] = self._lookup(symbol[inner], symbol[inner + 1])
        else:
            for own in np.unique(word):
                rest = self._finish(symbol[word == own])
                done.append((rest, np.full(len(rest), own)))
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        symbol, word = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _finish(self, symbols: np.ndarray) -> np.ndarray:
        """The remaining merges of one word, best score and then leftmost first."""
        symbol, n = symbols.tolist(), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self._lookup(symbols[:-1], symbols[1:])
        heap = [
            (int(self.pair_rank[p]), i, symbol[i], symbol[i + 1], int(p))
            for i, p in enumerate(pairs)
            if p >= 0
        ]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                p = int(self._lookup(np.array([symbol[i]]), np.array([symbol[j]]))[0])
                if p >= 0:
                    heapq.heappush(heap, (int(self.pair_rank[p]), i, symbol[i], symbol[j], p))

        gone = None
        while heap:
            _, i, left, right, p = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            symbol[i], symbol[j] = int(self.pair_id[p]), gone
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([s for s in symbol if s is not gone], symbols.dtype)

    def learn(self, words: list[str]) -> None:
        """Encode words not met before and remember them."""
        symbol, word = self.merge(words)
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.whole))
        if len(odd):
            if self.spelled is None:
                unknown = np.flatnonzero(self.char_id >= self.whole)
                self.spelled = dict(zip(self.char_id[unknown].tolist(), unknown.tolist()))
            chars = [chr(self.spelled[s] if s >= 0 else -1 - s) for s in symbol[odd].tolist()]
            raw = [c.encode("utf-8", "surrogatepass") for c in chars]
            width = np.ones(len(symbol), np.int64)
            width[odd] = [len(r) for r in raw]
            begin = np.cumsum(width) - width
            ids = np.repeat(symbol, width)
            at = np.repeat(begin[odd], width[odd])
            at += np.arange(len(at)) - np.repeat(np.cumsum(width[odd]) - width[odd], width[odd])
            ids[at] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
            symbol, word = ids, np.repeat(word, width)
        lengths = np.bincount(word, minlength=len(words))
        starts = np.cumsum(lengths) - lengths
        texts = list(map(str, symbol.tolist()))
        ends = (starts + lengths).tolist()
        for offset, (name, start, end) in enumerate(zip(words, starts.tolist(), ends)):
            self.known[name] = len(self.text)
            self.text.append(",".join(texts[start:end]))
        self.starts = np.r_[self.starts, starts + len(self.ids)]
        self.lengths = np.r_[self.lengths, lengths]
        self.ids = np.r_[self.ids, symbol.astype(np.int32)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts, number of ids per text, comma-joined ids per text)."""
        split = self.split.findall
        lists = [split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(dict.fromkeys(chain.from_iterable(lists)))
        if len(self.known) > REMEMBERED:
            self._forget()
        if new := [w for w in new if w not in self.known]:
            self.learn(new)
        get = self.known.__getitem__
        sizes = np.array([len(x) for x in lists], np.int64)
        index = np.fromiter(map(get, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        lengths = self.lengths[index]
        total = np.r_[0, np.cumsum(lengths)]
        ids = self.ids[_ranges(self.starts[index], lengths, total[:-1])]
        ends = np.r_[0, np.cumsum(sizes)]
        spelled, order = self.text, index.tolist()
        joined = [
            ",".join([spelled[i] for i in order[a:b]]) for a, b in zip(ends[:-1], ends[1:])
        ]
        return ids, np.diff(total[ends]), joined

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 texts of runs of ids; bytes that are no UTF-8 become U+FFFD each."""
        size = self.size[ids]
        total = np.r_[0, np.cumsum(size)]
        ends = np.r_[0, np.cumsum(counts)]
        flat = self.surface[_ranges(self.begin[ids], size, total[:-1])].tobytes()
        out = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            while a < b and self.silent[ids[a]]:
                a += 1
            body = flat[total[a] : total[b]]
            if a < b and not self.is_byte[ids[a]] and ids[a] != self.unknown:
                body = body.removeprefix(b" ")
            try:
                body.decode()
            except UnicodeDecodeError:
                body = self._repaired(ids[a:b])
            out.append(body)
        return out

    def _repaired(self, ids: np.ndarray) -> bytes:
        out, run, head = [], bytearray(), True

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                at += n
            run.clear()

        for i in ids.tolist():
            piece = self.surface[self.begin[i] : self.begin[i] + self.size[i]].tobytes()
            if self.is_byte[i]:
                run += piece
            elif not self.silent[i]:
                flush()
                text = piece.decode()
                out.append(text.removeprefix(" ") if head and i != self.unknown else text)
            else:
                continue
            head = False
        flush()
        return "".join(out).encode()


def _ranges(starts: np.ndarray, lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + length)``."""
    return np.repeat(starts - offsets, lengths) + np.arange(int(lengths.sum()))


def read_model(path: str | None = None) -> bytes:
    """The model file, read once by the driver and sent along with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end, texts) of slices of a column."""
    sizes = np.r_[0, np.cumsum([len(v.as_buffer()) if v.is_valid else 0 for v in column])]
    for begin, end in slices(sizes):
        yield begin, end, [t or "" for t in column.slice(begin, end - begin).to_pylist()]


_OUTPUTS = {
    "n_tokens": ("long", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def encode(
    docs: DataFrame,
    model: bytes | None = None,
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """doc_id and the ``outputs`` of every document's whole text.

    n_tokens, ids, the decoded text, and the SHA-256 of the decimal ids joined by commas and of
    the decoded text in UTF-8.
    """
    model = model or read_model()
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)

        def digests(texts: list[bytes]) -> list[str]:
            return [hashlib.sha256(t).hexdigest() for t in texts]

        for batch in batches:
            keys = batch.column(0)
            for begin, end, texts in _texts(batch.column(1)):
                ids, counts, joined = pieces.encode(texts)
                decoded = pieces.decode(ids, counts)
                ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
                made = {
                    "n_tokens": lambda: counts,
                    "ids": lambda: pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    "decoded": lambda: [d.decode() for d in decoded],
                    "ids_sha256": lambda: digests([j.encode() for j in joined]),
                    "decoded_sha256": lambda: digests(decoded),
                }
                values = [pa.array(made[name](), _OUTPUTS[name][1]) for name in outputs]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(begin, end - begin), *values], names=["doc_id", *outputs]
                )

    schema = ", ".join([f"doc_id {key}", *(f"{name} {_OUTPUTS[name][0]}" for name in outputs)])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """(doc_id, decoded) of rows with ``ids``; null ids decode to an empty text."""
    model = model or read_model()
    key = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            counts = np.array([len(x or ()) for x in lists], np.int64)
            ids = np.array([i for x in lists for i in x or ()], np.int64)
            texts = [t.decode() for t in pieces.decode(ids, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {key}, decoded string")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), outputs=DIGESTS)
