"""Language-model scoring with an Elias-Fano n-gram trie in memory-mapped levels.

First level: the words of the training texts, as a monotone sequence of 64-bit hashes with their
counts; a word's place in it is its id. Every further level: the words that follow each n-gram of the
level before. Their ids, offset by their context's place, are one monotone sequence, pointers
(monotone as well) tell where the successors of a context begin, and quantised logarithms hold their
discounted probabilities. Running sums of the counts follow where a further level needs them. All
sequences are Elias-Fano coded. A word is looked up by successor search from its context's offset.

The model is P(w | v) = max(c(v w) - D, 0) / c(v) + D * T(v) / c(v) * P(w | v'), with T(v) the number
of successors of v, from the pointers, v' the context v without its first word, and P(w) the add-0.1
share of w. An unseen context leaves P(w | v'). Contexts begin with the end that stands before a
text's first word and reach no further back; ``order`` is the length of the longest n-gram.

All levels are cut into shards by ranges of hashes and keys, so each is built by a task of its own
from sorted, counted blocks; a word that is very frequent is cut across shards. Scoring tasks map the
shards' files from the shared folder, so memory stays bounded whatever the corpus.

Defined results: a null or empty text is just its end; a null id is neither learnt from nor held
out; repeated rows count each; without training texts every word has probability 1 / 0.1 * 0.1; an
empty table gives an empty result; further columns don't matter, whatever their names. Words of one
64-bit hash count as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.llm import files
from citygrain.llm.columns import text_volume
from citygrain.llm.words import lowered, slices, text_bytes, word_hashes
from citygrain.session import staged

DISCOUNT = 0.75
ADDED = 0.1

#: Words of the longest n-gram of the query.
ORDER = 3

#: Bytes of input per shard of words, and tokens per shard of a further level.
WORD_SHARD_BYTES = 48 << 20
PAIR_SHARD_TOKENS = 4_000_000

#: Words or pairs that a task counts before it hands blocks on, and bytes of text looked up at once.
COUNTED = 1_500_000
BATCH_BYTES = 4 << 20

#: Codes 1 to 255 of a probability stand for so many steps from 0 down to 10^-9.
LOWEST, CODES = -9.0, 255

END_HASH = np.uint64(0x5851F42D4C957F2D)


_BYTES, _HIGH_BITS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: For every byte and rank the place of the one of that rank.
_PLACE_IN_BYTE = np.array([([bit for bit in range(8) if byte >> bit & 1] + [0] * 8)[rank] for byte in range(256) for rank in range(8)], dtype=np.uint64)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, with a count of zeros per 64 bits."""

    HEADER = 6

    def __init__(self, data: memoryview, at: int = 0) -> None:
        head = np.frombuffer(data, dtype=np.int64, count=self.HEADER, offset=at)
        self.count, self.low_bits, words, low_bytes = (int(value) for value in head[:4])
        at += 8 * self.HEADER
        self.upper = np.frombuffer(data, dtype=np.uint64, count=words, offset=at)
        at += 8 * words
        self.zeros = np.frombuffer(data, dtype=np.int64, count=words + 1, offset=at)
        at += 8 * (words + 1)
        self.low = np.frombuffer(data, dtype=np.uint8, count=low_bytes, offset=at)
        self.end = at + low_bytes
        self._ones: np.ndarray | None = None
        self._wide = np.ndarray(max(0, low_bytes - 7), dtype="<u8", buffer=data, offset=at, strides=(1,)) if low_bytes > 7 else None

    @staticmethod
    def encode(values: np.ndarray, bound: int) -> bytes:
        """Bytes of a sequence whose values are below ``bound``; their number is a multiple of 8."""
        count = len(values)
        low_bits = min(56, max(0, (max(1, bound) // max(1, count)).bit_length() - 1))
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        size = count + (max(0, bound - 1) >> low_bits) + 2
        words = -(-size // 64)
        bits = np.zeros(words * 64, dtype=np.uint8)
        bits[high + np.arange(count)] = 1
        upper = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(upper).astype(np.int64))])
        parts = []
        for begin in range(0, count if low_bits else 0, 1 << 16):  # a multiple of 8 values fills whole bytes
            part = values[begin : begin + (1 << 16), None] >> np.arange(low_bits, dtype=np.uint64)[None, :]
            parts.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes())
        low = b"".join(parts) + b"\0" * 8
        low += b"\0" * (-len(low) % 8)
        head = np.array([count, low_bits, words, len(low), 0, 0], dtype=np.int64)
        return head.tobytes() + upper.tobytes() + zeros.astype(np.int64).tobytes() + low

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.uint64)
        at = index * self.low_bits
        mask = np.uint64((1 << self.low_bits) - 1)
        return (self._wide[at >> 3] >> (at & 7).astype(np.uint64)) & mask

    @staticmethod
    def _select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the one of that rank, from 0, in each 64-bit word: its byte by sums over bytes, then a table."""
        sums = words - ((words >> np.uint64(1)) & np.uint64(0x5555555555555555))
        sums = (sums & np.uint64(0x3333333333333333)) + ((sums >> np.uint64(2)) & np.uint64(0x3333333333333333))
        sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _BYTES  # ones up to each byte
        own = rank.astype(np.uint64)
        # The high bit of a byte stays where its sum is at most the rank: so many bytes lie before the one.
        passed = (((own * _BYTES) | _HIGH_BITS) - sums) & _HIGH_BITS
        shift = np.bitwise_count(passed).astype(np.uint64) << np.uint64(3)
        before = ((sums << np.uint64(8)) >> shift) & np.uint64(0xFF)
        byte = (words >> shift) & np.uint64(0xFF)
        return (shift + _PLACE_IN_BYTE[(byte << np.uint64(3)) | (own - before)]).astype(np.int64)

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of the zero of that rank in the high bits."""
        word = np.searchsorted(self.zeros, rank, side="right") - 1
        return word * 64 + self._select_in_word(~self.upper[word], rank - self.zeros[word])

    def access(self, index: np.ndarray) -> np.ndarray:
        """Values at these places."""
        if self._ones is None:
            self._ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(self._ones, index, side="right") - 1
        place = word * 64 + self._select_in_word(self.upper[word], index - self._ones[word])
        return ((place - index).astype(np.uint64) << np.uint64(self.low_bits)) | self._lows(index)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 if it isn't there: the first element not below it, then compared."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not self.count or not len(values):
            return out
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        inside = high < self.zeros[-1]
        open_ = np.flatnonzero(inside)
        high = high[open_]
        wanted = values[open_] & np.uint64((1 << self.low_bits) - 1)
        # The elements with these high bits lie between two zeros; a frequent context may have many of
        # them, so the first one not below is found by halving.
        low = np.zeros(len(open_), dtype=np.int64)
        later = high > 0
        low[later] = self._zero(high[later] - 1) + 1 - high[later]
        end = self._zero(high) - high
        top = end.copy()
        active = np.flatnonzero(low < top)
        while len(active):
            middle = (low[active] + top[active]) >> 1
            below = self._lows(middle) < wanted[active]
            low[active[below]] = middle[below] + 1
            top[active[~below]] = middle[~below]
            active = active[low[active] < top[active]]
        there = np.flatnonzero(low < end)
        hit = there[self._lows(low[there]) == wanted[there]]
        out[open_[hit]] = low[hit]
        return out


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of a text column: first and last text, the words' hashes with an end after every text, and where texts begin."""
    data, offsets = text_bytes(column)
    for low, high in slices(offsets, BATCH_BYTES):
        words, first = word_hashes(lowered(data[offsets[low] : offsets[high]]), offsets[low : high + 1] - offsets[low])
        counts = np.diff(first)
        begins = first + np.arange(high - low + 1)
        hashes = np.full(len(words) + high - low, END_HASH, dtype=np.uint64)
        hashes[np.arange(len(words)) + np.repeat(np.arange(high - low), counts)] = words
        yield low, high, hashes, begins


def _packed(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as compressed differences."""
    steps = np.diff(values, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * count, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64)[:, 0], dtype=np.uint64)


BLOCK_SCHEMA = "part long, n long, keys binary, counts binary"


class _Counter:
    """Sorted, counted keys of a task, handed on as one block per part."""

    def __init__(self, part_of) -> None:
        self.part_of, self.keys, self.counts, self.size = part_of, [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = _summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.size = [], [], 0
        parts = self.part_of(keys)
        edges = np.flatnonzero(np.diff(parts, prepend=parts[0] - 1))
        for low, high in zip(edges, np.append(edges[1:], len(keys)), strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(parts[low])], pa.int64()),
                    pa.array([int(high - low)], pa.int64()),
                    pa.array([_packed(keys[low:high])], pa.binary()),
                    pa.array([pa.compress(counts[low:high].astype(np.int64).tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                ],
                ["part", "n", "keys", "counts"],
            )


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def _merged(blocks: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """All counted keys of a part, sorted; blocks are merged as they come, so copies don't pile up."""
    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    held_keys, held_counts, held = [], [], 0
    for batch in blocks:
        for row in range(batch.num_rows):
            n = batch.column("n")[row].as_py()
            held_keys.append(_unpacked(batch.column("keys")[row].as_py(), n))
            raw = pa.decompress(batch.column("counts")[row].as_py(), decompressed_size=8 * n, codec="zstd", asbytes=True)
            held_counts.append(np.frombuffer(raw, dtype=np.int64))
            held += n
            if held > max(1 << 20, len(keys)):
                keys, counts = _summed(np.concatenate([keys, *held_keys]), np.concatenate([counts, *held_counts]))
                held_keys, held_counts, held = [], [], 0
    return _summed(np.concatenate([keys, *held_keys]), np.concatenate([counts, *held_counts]))


def _word_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


class Words:
    """First level, mapped: id and count of words by hash."""

    def __init__(self, folder: str, parts: list[tuple[int, int]], shards: int) -> None:
        self.folder, self.shards = folder, shards
        self.begins, total = {}, 0
        for part, count in sorted(parts):
            self.begins[part] = total
            total += count
        self.size = total
        self._open: dict[int, tuple[EliasFano, np.ndarray]] = {}

    def _shard(self, part: int) -> tuple[EliasFano, np.ndarray]:
        if part not in self._open:
            data = files.mapped(f"{self.folder}/words-{part:06d}")
            keys = EliasFano(data)
            self._open[part] = keys, np.frombuffer(data, dtype=np.int64, count=keys.count, offset=keys.end)
        return self._open[part]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 if unknown) and counts of sorted hashes."""
        ids, counts = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        parts = _word_part(hashes, self.shards)
        for part in np.unique(parts).tolist():
            if part in self.begins:
                low, high = np.searchsorted(parts, part), np.searchsorted(parts, part, side="right")
                keys, own = self._shard(part)
                place = keys.find(hashes[low:high] - np.uint64(_part_begin(part, self.shards)))
                known = place >= 0
                ids[low:high][known] = place[known] + self.begins[part]
                counts[low:high][known] = own[place[known]]
        return ids, counts


def _part_begin(part: int, parts: int) -> int:
    """Smallest hash of a part."""
    return -(-(part << 32) // parts) << 32


class Level:
    """A further level, mapped: places and discounted shares of n-grams, numbers of successors, and counts."""

    def __init__(self, folder: str, number: int, edges: list[int], begins: list[int], size: int) -> None:
        self.folder, self.number, self.size = folder, number, size
        self.edges = np.array(edges, dtype=np.uint64)  # first key of each shard but the first
        self.begins = np.array(begins, dtype=np.int64)  # n-grams before each shard, and all of them
        self._open: dict[int, tuple[int, int, EliasFano, EliasFano, np.ndarray, EliasFano | None] | None] = {}

    def _shard(self, shard: int) -> tuple[int, int, EliasFano, EliasFano, np.ndarray, EliasFano | None] | None:
        if shard not in self._open:
            data = files.mapped(_level_file(self.folder, self.number, shard))
            if len(data) == 0:
                self._open[shard] = None
            else:
                base, first, counted = (int(value) for value in np.frombuffer(data, dtype=np.uint64, count=3))
                pointers = EliasFano(data, 24)
                keys = EliasFano(data, pointers.end)
                codes = np.frombuffer(data, dtype=np.uint8, count=keys.count, offset=keys.end)
                sums = EliasFano(data, keys.end + -(-keys.count // 8) * 8) if counted else None
                self._open[shard] = base, first, pointers, keys, codes, sums
        return self._open[shard]

    def successors(self, contexts: np.ndarray) -> np.ndarray:
        """Number of different words seen after each context, by sorted places in the level before."""
        out = np.zeros(len(contexts), dtype=np.int64)
        size = np.uint64(self.size)
        low = np.searchsorted(self.edges, contexts.astype(np.uint64) * size, side="right")
        high = np.searchsorted(self.edges, contexts.astype(np.uint64) * size + size - np.uint64(1), side="right")
        for shard in range(int(low.min(initial=len(self.edges))), int(high.max(initial=-1)) + 1):
            begin, end = np.searchsorted(high, shard), np.searchsorted(low, shard, side="right")
            opened = self._shard(shard) if end > begin else None
            if opened is not None:
                _, first, pointers, _, _, _ = opened
                place = contexts[begin:end] - first
                inside = (place >= 0) & (place < pointers.count - 1)
                place = place[inside]
                out[begin:end][inside] += (pointers.access(place + 1) - pointers.access(place)).astype(np.int64)
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1 if never seen) and code of the share (0 then) of each n-gram, by sorted keys."""
        places, out = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.uint8)
        if not len(keys):
            return places, out
        bounds = np.searchsorted(keys, self.edges)
        for shard, (low, high) in enumerate(zip(np.append([0], bounds), np.append(bounds, len(keys)), strict=True)):
            opened = self._shard(shard) if high > low else None
            if opened is not None:
                base, _, _, coded, codes, _ = opened
                own = keys[low:high]
                fits = own >= np.uint64(base)
                place = np.full(len(own), -1, dtype=np.int64)
                place[fits] = coded.find(own[fits] - np.uint64(base))
                known = place >= 0
                out[low:high][known] = codes[place[known]]
                places[low:high][known] = place[known] + self.begins[shard]
        return places, out

    def counts(self, places: np.ndarray) -> np.ndarray:
        """How often the n-grams at these sorted places were seen."""
        out = np.zeros(len(places), dtype=np.int64)
        bounds = np.searchsorted(places, self.begins)
        for shard, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if high > low:
                sums = self._shard(shard)[5]
                own = places[low:high] - self.begins[shard]
                out[low:high] = (sums.access(own + 1) - sums.access(own)).astype(np.int64)
        return out


def _level_file(folder: str, number: int, shard: int) -> str:
    return f"{folder}/level{number}-{shard:06d}"


@lru_cache(maxsize=1)
def _words(folder: str, parts: tuple[tuple[int, int], ...], shards: int) -> Words:
    return Words(folder, list(parts), shards)


@lru_cache(maxsize=1)
def _levels(folder: str, levels: tuple[tuple[tuple[int, ...], tuple[int, ...]], ...], size: int) -> list[Level]:
    return [Level(folder, number, list(edges), list(begins), size) for number, (edges, begins) in enumerate(levels, 2)]


def _edges_of(parts: list, heavy: list[tuple[int, int]], size: int, shards: int) -> list[int]:
    """Keys that cut a level into shards of about as many tokens.

    ``parts`` are (first place, n-grams, tokens) of the shards of the level before. Between heavy ones,
    (place, count), tokens count as spread evenly over places; those of a heavy one over the ids of words.
    """
    places, masses = [0], [0.0]
    by_id = dict(heavy)
    for first, words, tokens in parts:
        own = sorted(i for i in by_id if first <= i < first + words)
        light = tokens - sum(by_id[i] for i in own)
        each = light / max(1, words - len(own))
        at = first
        for word in own:
            places += [word * size, (word + 1) * size]
            masses += [masses[-1] + each * (word - at), masses[-1] + each * (word - at) + by_id[word]]
            at = word + 1
        places.append((first + words) * size)
        masses.append(masses[-1] + each * (first + words - at))
    wanted = np.linspace(0, masses[-1], shards + 1)[1:-1]
    edges = []
    for mass in wanted.tolist():  # whole numbers, as keys may have more digits than a double
        i = min(max(1, int(np.searchsorted(masses, mass, side="left"))), len(places) - 1)
        span = masses[i] - masses[i - 1]
        share = (mass - masses[i - 1]) / span if span > 0 else 0
        edges.append(places[i - 1] + int((places[i] - places[i - 1]) * share))
    return sorted(set(edges))


class NgramModel:
    """Where the levels lie, and the totals; small enough to go with every task."""

    def __init__(self, folder: str, parts, word_shards: int, tokens: int, size: int, levels=()) -> None:
        self.folder, self.parts, self.word_shards = folder, tuple(parts), word_shards
        self.tokens, self.size, self._levels = tokens, size, tuple(levels)

    def with_level(self, edges: list[int], begins: list[int]) -> NgramModel:
        levels = (*self._levels, (tuple(edges), tuple(begins)))
        return NgramModel(self.folder, self.parts, self.word_shards, self.tokens, self.size, levels)

    @property
    def words(self) -> Words:
        return _words(self.folder, self.parts, self.word_shards)

    @property
    def levels(self) -> list[Level]:
        """All levels but that of the words."""
        return _levels(self.folder, self._levels, self.size)

    def share(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.tokens + ADDED * (self.size + 1))

    def keys(self, contexts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return contexts.astype(np.uint64) * np.uint64(self.size) + ids.astype(np.uint64)


def _next_contexts(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Contexts one word longer: the n-gram that ends before each token, -1 at a text's first."""
    out = np.concatenate([[-1], places[:-1]])
    out[begins[:-1]] = -1
    return out


def fit(docs: DataFrame, train: Column, order: int = 2) -> NgramModel:
    """Count the n-grams, up to ``order`` words, of all rows of ``docs`` that ``train`` holds for, and write all levels."""
    spark = docs.sparkSession
    folder = files.new_folder(spark, "ngram-model")
    texts = docs.where(train).select("text")
    shards = int(max(1, text_volume(docs) // WORD_SHARD_BYTES))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(lambda keys: _word_part(keys, shards))
        for batch in batches:
            for _, _, hashes, _ in _tokens(batch.column("text")):
                counter.add(*np.unique(hashes, return_counts=True))
                if counter.size > COUNTED:
                    yield from counter.blocks()
        yield from counter.blocks()

    def build_words(key: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = key[0].as_py()
        keys, counts = _merged(blocks)
        begin, end = _part_begin(part, shards), _part_begin(part + 1, shards)
        files.write_file(f"{folder}/words-{part:06d}", EliasFano.encode(keys - np.uint64(begin), end - begin) + counts.tobytes())
        total = int(counts.sum())
        # words above one part in 4096 of their shard's tokens: 4096 at most
        large = np.flatnonzero(counts * 4096 > total)
        yield pa.RecordBatch.from_pydict(
            {
                "part": [part],
                "words": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([total], pa.int64()),
                "places": pa.array([large.tolist()], pa.list_(pa.int64())),
                "counts": pa.array([counts[large].tolist()], pa.list_(pa.int64())),
            }
        )

    counted = texts.mapInArrow(count_words, BLOCK_SCHEMA).groupBy("part")
    written = counted.applyInArrow(build_words, "part long, words long, tokens long, places array<long>, counts array<long>")
    manifest = sorted(staged(written, "words").collect(), key=lambda row: row["part"])
    parts = [(row["part"], row["words"]) for row in manifest]
    size, tokens = sum(row["words"] for row in manifest), sum(row["tokens"] for row in manifest)
    if size >= 1 << 31:
        raise ValueError("more than 2^31 different words: cut the corpus by language or source")
    first, spans, heavy = 0, [], []
    for row in manifest:
        spans.append((first, row["words"], row["tokens"]))
        heavy += [(first + place, n) for place, n in zip(row["places"], row["counts"], strict=True)]
        first += row["words"]
    model = NgramModel(folder, parts, shards, tokens, size)
    for number in range(2, order + 1 if size else 2):
        model, spans, heavy = _add_level(texts, model, number, number < order, spans, heavy)
    return model


def _add_level(texts: DataFrame, model: NgramModel, number: int, counted: bool, spans: list, heavy: list) -> tuple[NgramModel, list, list]:
    """The model with one more level, and the spans and heavy n-grams of that level; ``counted``: with counts for the next."""
    folder, size, before = model.folder, model.size, spans[-1][0] + spans[-1][1]
    if before * size >= 1 << 64:
        raise ValueError(f"keys of {number} words exceed 64 bits: cut the corpus by language or source")
    tokens = sum(span[2] for span in spans)
    shards = max(1, tokens // PAIR_SHARD_TOKENS)
    edges = _edges_of(spans, [(place, n) for place, n in heavy if n * 4 * shards > tokens], size, shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array(edges, dtype=np.uint64)
        counter = _Counter(lambda keys: np.searchsorted(cuts, keys, side="right").astype(np.int64))
        end = int(model.words.find(np.array([END_HASH]))[0][0])
        for batch in batches:
            for _, _, hashes, begins in _tokens(batch.column("text")):
                known, inverse = np.unique(hashes, return_inverse=True)
                ids = model.words.find(known)[0][inverse]
                contexts = np.concatenate([[end], ids[:-1]])
                for level in model.levels:
                    held = contexts >= 0
                    keys, inverse = np.unique(model.keys(contexts[held], ids[held]), return_inverse=True)
                    places = np.full(len(ids), -1, dtype=np.int64)
                    places[held] = level.find(keys)[0][inverse]
                    contexts = _next_contexts(places, begins)
                held = contexts >= 0
                counter.add(*np.unique(model.keys(contexts[held], ids[held]), return_counts=True))
                if counter.size > COUNTED:
                    yield from counter.blocks()
        yield from counter.blocks()

    def build(key: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        keys, counts = _merged(blocks)
        contexts = (keys // np.uint64(size)).astype(np.int64)
        first, last = int(contexts[0]), int(contexts[-1])
        pointers = np.searchsorted(contexts, np.arange(first, last + 2)).astype(np.uint64)
        if model.levels:
            seen = model.levels[-1].counts(np.arange(first, last + 1))
        else:
            seen = _context_counts(model, first, last)
        share = (counts - DISCOUNT) / seen[contexts - first]
        codes = np.clip(np.rint(np.log10(share) / LOWEST * (CODES - 1)), 0, CODES - 1).astype(np.uint8) + np.uint8(1)
        base, total = int(keys[0]), int(counts.sum())
        head = np.array([base, first, counted], dtype=np.uint64).tobytes()
        data = head + EliasFano.encode(pointers, len(keys) + 1) + EliasFano.encode(keys - np.uint64(base), int(keys[-1]) - base + 1)
        data += codes.tobytes()
        if counted:
            sums = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)
            data += b"\0" * (-len(keys) % 8) + EliasFano.encode(sums, total + 1)
        files.write_file(_level_file(folder, number, shard), data)
        large = np.flatnonzero(counts * 4096 > total) if counted else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "part": [shard],
                "grams": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([total], pa.int64()),
                "places": pa.array([large.tolist()], pa.list_(pa.int64())),
                "counts": pa.array([counts[large].tolist()], pa.list_(pa.int64())),
            }
        )

    grouped = texts.mapInArrow(count, BLOCK_SCHEMA).groupBy("part")
    written = grouped.applyInArrow(build, "part long, grams long, tokens long, places array<long>, counts array<long>")
    built = {row["part"]: row for row in staged(written, f"level{number}").collect()}
    begins, spans, heavy = [0], [], []
    for shard in range(len(edges) + 1):
        row = built.get(shard)
        if row is None:
            files.write_file(_level_file(folder, number, shard), b"")
        else:
            spans.append((begins[-1], row["grams"], row["tokens"]))
            heavy += [(begins[-1] + place, n) for place, n in zip(row["places"], row["counts"], strict=True)]
        begins.append(begins[-1] + (row["grams"] if row else 0))
    return model.with_level(edges, begins), spans, heavy


def _context_counts(model: NgramModel, first: int, last: int) -> np.ndarray:
    """Counts of the words with ids ``first`` to ``last``, from the first level."""
    out = np.zeros(last - first + 1, dtype=np.int64)
    words = model.words
    for part, begin in words.begins.items():
        keys, counts = words._shard(part)
        low, high = max(first, begin), min(last + 1, begin + keys.count)
        if low < high:
            out[low - first : high - first] = counts[low - begin : high - begin]
    return out


def score(docs: DataFrame, model: NgramModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 of the probability) of every whole text."""
    logs = np.concatenate([[0.0], 10.0 ** (np.arange(CODES) * LOWEST / (CODES - 1))])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, hashes, begins in _tokens(batch.column("text")):
                known, inverse = np.unique(hashes, return_inverse=True)
                ids, counts = model.words.find(known) if model.size else (np.full(len(known), -1), np.zeros(len(known), dtype=np.int64))
                share = model.share(counts)
                own_ids, own_share = ids[inverse], share[inverse]
                chance = own_share.copy()
                # Contexts are places among the different words, then among the different n-grams, of the slice.
                if model.size:
                    # an end stands before every text's first word
                    context = np.concatenate([[int(np.searchsorted(known, END_HASH))], inverse[:-1]])
                    present = np.flatnonzero(ids >= 0)
                    present = present[np.argsort(ids[present])]
                    grams, seen = ids, counts[present]
                    for number, level in enumerate(model.levels):
                        if number:
                            present = np.flatnonzero(grams >= 0)
                            seen = model.levels[number - 1].counts(grams[present])
                        kept = np.ones(len(grams))
                        kept[present] = DISCOUNT * level.successors(grams[present]) / np.maximum(seen, 1)
                        before = np.where(context >= 0, grams[context], -1)
                        held = np.flatnonzero(before >= 0)
                        chance[held] *= kept[context[held]]
                        both = held[own_ids[held] >= 0]
                        keys, place = np.unique(model.keys(before[both], own_ids[both]), return_inverse=True)
                        grams, codes = level.find(keys)
                        chance[both] += logs[codes][place]
                        places = np.full(len(own_ids), -1, dtype=np.int64)
                        places[both] = place
                        context = _next_contexts(places, begins)
                starts = begins[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("held_out").slice(low, high - low),
                        pa.array(np.diff(begins)),
                        pa.array(np.add.reduceat((own_ids >= 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(np.log10(own_share), starts)),
                        pa.array(np.add.reduceat(np.log10(chance), starts)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return docs.mapInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, folds: int = 10, order: int = 2) -> DataFrame:
    """Fit on the texts whose crc32(id) modulo ``folds`` isn't 0 and score all of them."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    model = fit(docs.select("doc_id", "text"), remainder != 0, order)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "text")
    return score(rows, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
