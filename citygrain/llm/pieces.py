"""SentencePiece encoding and decoding with a suffix array over the words of a batch.

The distinct words of a batch are one concatenated text. Its suffixes, as far as the longest piece
reaches, are sorted; a binary search gives each piece the range of its occurrences. The occurrences
are edges from a position to a later one. Sorted by position, they are relaxed: every position keeps
the one last piece of the encoding of what lies before it.

In a BPE model a sequence of pieces is what merging gives if and only if each two neighbours are
what merging gives for the two of them. So an edge relaxes its end when its piece may follow the last
piece kept at its start; of the edges into a position exactly one does.

Words are cut before a run of blanks and around characters that no piece holds, which no merge
crosses. Defined results: a null or empty text has no pieces; characters without a piece become byte
pieces; control symbols written in a text are ordinary text; repeated rows each get the same pieces;
an empty table gives an empty result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

BLANK = "▁"

#: Bytes of text whose new words are matched together, and words that a task remembers at most.
BATCH_BYTES = 8 << 20
REMEMBERED_WORDS = 400_000

#: Characters of words that are one concatenated text; about five edges each are held at once.
MATCHED_CHARACTERS = 3 << 17

#: Places of the table of checked pairs of a task.
PAIR_BITS = 21

# Fixed values of the published model format: field numbers and kinds of pieces.
FIELD_PIECES, FIELD_TEXT, FIELD_SCORE, FIELD_KIND = 1, 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """Field number, wire type and value of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, kind, data[at : at + size]
            at += size


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """Text, score and kind of every piece of a model, by id."""
    out = []
    for field, _, value in _fields(model):
        if field == FIELD_PIECES:
            own = {number: item for number, _, item in _fields(value)}
            score = np.frombuffer(own.get(FIELD_SCORE, b"\0\0\0\0"), dtype="<f4")[0]
            out.append((own.get(FIELD_TEXT, b"").decode(), float(score), own.get(FIELD_KIND, NORMAL)))
    return out


class Vocabulary:
    """Pieces of a BPE model, how each is merged, and which two may follow each other."""

    def __init__(self, model: bytes) -> None:
        self.pieces = read_pieces(model)
        usable = [i for i, (_, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER)]
        self.ids = {self.pieces[i][0]: i for i in usable}
        self.bytes = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.byte_ids = np.array([self.bytes.get(i, 0) for i in range(256)], dtype=np.int32)
        # Order of merging: rank 0 is merged first. Single characters are never merged into being.
        by_score = sorted((i for i in usable if len(self.pieces[i][0]) > 1), key=lambda i: (-self.pieces[i][1], i))
        count = len(self.pieces)
        self.rank = np.full(count, -1, dtype=np.int64)
        self.rank[by_score] = np.arange(len(by_score))
        self.left, self.right = np.full(count, -1, dtype=np.int64), np.full(count, -1, dtype=np.int64)
        pairs = {}
        for i in by_score:
            text = self.pieces[i][0]
            for cut in range(1, len(text)):
                one, two = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if one is not None and two is not None:
                    pairs[one * count + two] = i
        self.in_order = True  # whether halves are always merged before what they make, as training ensures
        # A piece can be matched only if merging its own characters ends in it; its last merge gives its halves.
        runs = re.compile(f"{BLANK}{BLANK}+")
        matched = []
        for i in usable:
            text = self.pieces[i][0]
            if len(text) == 1:
                matched.append(i)
            elif not runs.search(text):
                steps: list[tuple[int, int]] = []
                if self.merged(text, steps) == [i]:
                    matched.append(i)
                    self.left[i], self.right[i] = steps[-1]
                    self.in_order &= bool(max(self.rank[list(steps[-1])]) < self.rank[i])
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = self.rank[np.array([pairs[key] for key in self.pair_keys.tolist()], dtype=np.int64)]
        self.matched = np.array(matched, dtype=np.int64)
        self.lengths = np.array([len(self.pieces[i][0]) for i in matched], dtype=np.int64)
        self.longest = int(self.lengths.max(initial=1))
        self.spelling = np.zeros((len(matched), self.longest), dtype=np.uint32)  # code points, 0 after the end
        for place, i in enumerate(matched):
            self.spelling[place, : self.lengths[place]] = [ord(character) for character in self.pieces[i][0]]
        self.characters = {text for text in self.ids if len(text) == 1}
        # No merge crosses the place before a blank if no piece has a blank after another character.
        self.cut_at_blanks = not any(re.search(f"[^{BLANK}]{BLANK}", text) for text in self.ids)
        self.text_bytes = [text.replace(BLANK, " ").encode() for text, _, _ in self.pieces]
        for value, i in self.bytes.items():
            self.text_bytes[i] = bytes([value])
        for i, (_, _, kind) in enumerate(self.pieces):
            if kind == CONTROL:
                self.text_bytes[i] = b""

    def merged(self, text: str, steps: list[tuple[int, int]] | None = None) -> list[int]:
        """Pieces by merging pairs, best score first, then leftmost; -1 for characters without a piece.

        This is the definition. Encoding uses it for runs of blanks, whose pieces share one score.
        """
        own = [self.ids.get(character, -1) for character in text]
        words = list(text)
        after = [*range(1, len(own)), -1]
        before = [-1, *range(len(own) - 1)]
        heap = []

        def offer(one: int, two: int) -> None:
            joined = self.ids.get(words[one] + words[two])
            if joined is not None:
                heapq.heappush(heap, (-self.pieces[joined][1], one, two, len(words[one]) + len(words[two]), joined))

        for i in range(len(own) - 1):
            offer(i, i + 1)
        while heap:
            _, one, two, size, joined = heapq.heappop(heap)
            if not words[one] or not words[two] or len(words[one]) + len(words[two]) != size or after[one] != two:
                continue
            if steps is not None:
                steps.append((own[one], own[two]))
            own[one], words[one], words[two] = joined, words[one] + words[two], ""
            after[one] = after[two]
            if after[one] >= 0:
                before[after[one]] = one
                offer(one, after[one])
            if before[one] >= 0:
                offer(before[one], one)
        return [piece for piece, word in zip(own, words, strict=True) if word]

    def may_follow(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two pieces ends in just these two; -1 stands for none.

        Undoes merges from the later one on: if, at a moment before both sides were whole, a pair
        across the border could have been merged earlier than the next merge inside, it would have been.
        """
        one, two = one.astype(np.int64).copy(), two.astype(np.int64).copy()
        count = np.int64(len(self.pieces))
        answer = np.ones(len(one), dtype=bool)
        active = np.flatnonzero((one >= 0) & (two >= 0))
        one, two = one[active], two[active]
        # A pair across the border must not be merged before this moment. Equal ranks cannot be of two
        # different pieces; the same piece on both sides of an overlap goes to the leftmost pair.
        limit = np.full(len(active), np.iinfo(np.int64).max)
        strict = np.zeros(len(active), dtype=bool)
        while len(active):
            key = one * count + two
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[place] == key, self.pair_rank[place], np.iinfo(np.int64).max)
            wrong = (rank < limit) | (strict & (rank == limit) & (rank < np.iinfo(np.int64).max))
            answer[active[wrong]] = False
            rank_one, rank_two = self.rank[one], self.rank[two]
            undo_left = rank_one > rank_two
            same = (rank_one == rank_two) & (rank_one >= 0)  # the right one was merged last
            undo_left &= ~same
            limit = np.where(undo_left, rank_one, rank_two)
            # Against a merge on the right, a pair across the border lies further left and wins a tie.
            strict = ~undo_left
            keep = ~wrong & (limit >= 0)
            active, limit, strict, undo_left = active[keep], limit[keep], strict[keep], undo_left[keep]
            one = np.where(undo_left, self.right[one[keep]], one[keep])
            two = np.where(undo_left, two[keep], self.left[two[keep]])
        return answer


@lru_cache(maxsize=2)
def vocabulary_of(model: bytes) -> Vocabulary:
    """The vocabulary of a model, made once per process."""
    return Vocabulary(model)


class Encoder:
    """Pieces of words, remembered in a task, and of whole texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        cut = sorted(set("\n") - vocabulary.characters) if vocabulary.cut_at_blanks else []
        self.breaks_lines = bool(cut)
        self._forget()
        self.pair_keys = np.full(1 << PAIR_BITS, -1, dtype=np.int64)
        self.pair_answers = np.zeros(1 << PAIR_BITS, dtype=bool)

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.pool = np.zeros(1 << 20, dtype=np.int32)
        self.used = 0
        self.begins = np.zeros(1 << 16, dtype=np.int64)

    def words_of(self, text: str) -> list[str]:
        """Words whose pieces, one after the other, are those of the text.

        A word that begins with neither blank nor line feed stands for itself after one blank.
        """
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if not self.vocabulary.cut_at_blanks:
            return [text]
        if self.breaks_lines:
            words = text.replace("\n", " \n").split(" ")
            if "" not in words and text[0] != "\n" and " \n" not in text:
                return words
            found = re.findall("\n[^ \n]*| *[^ \n]+| +", " " + text)
        else:
            words = text.split(" ")
            if "" not in words:
                return words
            found = re.findall(" *[^ ]+| +", " " + text)
        return [word[1:] if word[0] == " " and word[1:2] not in ("", "\n") and word[1] != " " else word for word in found]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts, one after the other, and where each text begins."""
        words = [self.words_of(text or "") for text in texts]
        fresh = set().union(*words) - self.places.keys()
        if len(self.places) + len(fresh) > REMEMBERED_WORDS:
            self._forget()
            fresh = set().union(*words)
        if fresh:
            self._learn(list(fresh))
        counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        places = map(self.places.__getitem__, chain.from_iterable(words))
        own = np.fromiter(places, dtype=np.int64, count=int(counts.sum()))
        low, size = self.begins[own], self.begins[own + 1] - self.begins[own]
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(low - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edges = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.concatenate([[0], ends])[edges]

    def _learn(self, fresh: list[str]) -> None:
        texts = [word if word[0] == "\n" and self.breaks_lines else BLANK + word if word[:1] != " " else word for word in fresh]
        texts = [text.replace(" ", BLANK) if " " in text else text for text in texts]
        runs = {i for i, text in enumerate(texts) if text[:2] == BLANK + BLANK or BLANK + BLANK in text}
        ids, begins = self._matched([text for i, text in enumerate(texts) if i not in runs] if runs else texts)
        if runs:
            fresh = [word for i, word in enumerate(fresh) if i not in runs] + [fresh[i] for i in sorted(runs)]
            merged = [self._merged_ids(texts[i]) for i in sorted(runs)]
            begins = np.concatenate([begins, begins[-1] + np.cumsum([len(item) for item in merged])])
            ids = np.concatenate([ids, *merged]).astype(np.int32)
        known = len(self.places)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while known + len(begins) > len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.begins[known : known + len(begins)] = self.used + begins
        self.used += len(ids)
        self.places.update(zip(fresh, range(known, known + len(fresh)), strict=True))

    def _merged_ids(self, text: str) -> np.ndarray:
        flat, at = [], 0
        for piece in self.vocabulary.merged(text):
            if piece < 0:
                flat.extend(self.vocabulary.byte_ids[list(text[at].encode())].tolist())
                at += 1
            else:
                flat.append(piece)
                at += len(self.vocabulary.pieces[piece][0])
        return np.array(flat, dtype=np.int32)

    def _matched(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of every text, and where each begins, by suffix array, edges and relaxation."""
        ids, begins, low = [], [np.zeros(1, dtype=np.int64)], 0
        total = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) < MATCHED_CHARACTERS):
                size += len(texts[high]) + 1
                high += 1
            own, first = self._relaxed(texts[low:high])
            ids.append(own)
            begins.append(first[1:] + total)
            total += len(own)
            low = high
        return np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), np.concatenate(begins)

    def _suffixes(self, codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions sorted by what follows, as far as the longest piece, and those sorted strings."""
        per = 64 // bits
        keys = []
        for low in range(0, self.vocabulary.longest, per):
            key = np.zeros(len(codes), dtype=np.uint64)
            for step in range(low, low + per):
                key <<= np.uint64(bits)
                if step < self.vocabulary.longest:
                    key[: max(0, len(codes) - step)] |= codes[step:]
            keys.append(key)
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
        strings = np.stack([key[order] for key in keys], axis=1).astype(">u8")
        return order, np.ascontiguousarray(strings).view(f"S{8 * len(keys)}")[:, 0]

    def _edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every occurrence of a piece; -1 for a character without one.

        ``text`` holds the mark of code point 0, which sorts before every character.
        """
        own = self.vocabulary
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        known, codes = np.unique(points, return_inverse=True)
        bits = 8 if len(known) <= 255 else 16 if len(known) <= 65535 else 32
        kind = np.dtype(f">u{bits // 8}")
        width = -(-own.longest * bits // 64) * 64 // bits
        table = np.zeros(0x110000, dtype=np.uint32)
        table[known] = np.arange(len(known))
        spelled = np.zeros((len(own.matched), width), dtype=np.uint32)
        spelled[:, : own.longest] = table[own.spelling]
        inside = np.arange(width)[None, :] < own.lengths[:, None]
        usable = ((spelled > 0) | ~inside).all(axis=1)
        wanted, inside, spelled = own.matched[usable], inside[usable], spelled[usable]
        order, strings = self._suffixes(codes.astype(np.uint64), bits)
        lows = np.ascontiguousarray(spelled.astype(kind)).view(strings.dtype)[:, 0]
        highs = np.ascontiguousarray(np.where(inside, spelled, (1 << bits) - 1).astype(kind)).view(strings.dtype)[:, 0]
        begin, end = np.searchsorted(strings, lows, side="left"), np.searchsorted(strings, highs, side="right")
        many = end - begin
        offsets = np.cumsum(many)
        total = int(offsets[-1]) if len(many) else 0
        start = order[np.repeat(begin - (offsets - many), many) + np.arange(total)]
        without = np.array([point != 0 and chr(point) not in own.characters for point in known.tolist()])
        alone = np.flatnonzero(without[codes])
        return (
            np.concatenate([start, alone]).astype(np.int32),
            np.concatenate([np.repeat(own.lengths[usable], many), np.ones(len(alone), dtype=np.int64)]).astype(np.int32),
            np.concatenate([np.repeat(wanted, many), np.full(len(alone), -1)]).astype(np.int32),
        )

    def _follows(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """``may_follow`` with a table of pairs seen before."""
        key = one * np.int64(len(self.vocabulary.pieces) + 1) + two
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        answer = self.pair_answers[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            _, at, inverse = np.unique(key[new], return_index=True, return_inverse=True)
            found = self.vocabulary.may_follow(one[new[at]], two[new[at]])
            answer[new] = found[inverse]
            self.pair_keys[slot[new[at]]] = key[new[at]]
            # two new pairs may want one slot; the key written last must go with its own answer
            held = self.pair_keys[slot[new[at]]] == key[new[at]]
            self.pair_answers[slot[new[at]][held]] = found[held]
        return answer

    def _relaxed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # A mark of code point 0 ends each text. Texts with that character itself are not concatenated.
        joined = "\0".join(texts) + "\0" if not any("\0" in text for text in texts) else None
        if joined is None:
            return self._one_by_one(texts)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        start, length, piece = self._edges(joined)
        # Edges by end within their text, then longest first: one sort of a packed key.
        text_of = np.repeat(np.arange(len(texts)), sizes + 1)
        inside = start.astype(np.int64) + length - first[text_of[start]]
        width = int(self.vocabulary.longest) + 1
        if int(sizes.max(initial=0) + 1) * (len(joined) + 1) * width < 1 << 62:
            order = np.argsort((inside * (len(joined) + 1) + start + length) * width - length)
        else:
            order = np.lexsort((-length, start + length, inside))
        start, length, piece, inside = start[order], length[order], piece[order], inside[order]
        end = start + length
        last = np.full(len(joined) + 1, -2, dtype=np.int64)  # -2: not reached; -1: a character without a piece
        back = np.zeros(len(joined) + 1, dtype=np.int64)
        at_begin = np.zeros(len(joined) + 1, dtype=bool)
        at_begin[first] = True
        steps = np.searchsorted(inside, np.arange(1, int(sizes.max(initial=0)) + 2))
        for low, high in zip(steps[:-1], steps[1:], strict=True):
            own_end = end[low:high]
            heads = np.flatnonzero(np.concatenate([[True], own_end[1:] != own_end[:-1]]))
            many = np.diff(np.concatenate([heads, [high - low]]))
            edge = heads + low
            left = many.copy()
            while len(edge):
                begin = start[edge]
                fine = at_begin[begin].copy()
                ask = np.flatnonzero(~fine)
                before = last[begin[ask]]
                both = (before >= 0) & (piece[edge[ask]] >= 0)
                answer = before != -2
                if both.any():
                    answer[both] = self._follows(before[both], piece[edge[ask]][both])
                fine[ask] = answer
                done = edge[fine]
                last[end[done]] = piece[done]
                back[end[done]] = length[done]
                left = left - 1
                more = ~fine & (left > 0)
                edge, left = edge[more] + 1, left[more]
        # Walk back from the ends of all texts at once.
        place, own = first + sizes, np.arange(len(texts))
        owners, places, found = [], [], []
        while len(place):
            open_ = place > first[own]
            place, own = place[open_], own[open_]
            owners.append(own)
            places.append(place)
            found.append(last[place])
            place = place - back[place]
        owner, place, piece = (np.concatenate(items) if items else np.zeros(0, dtype=np.int64) for items in (owners, places, found))
        if (piece == -2).any():
            raise ValueError("a word has no encoding")
        order = np.argsort(place, kind="stable")
        owner, place, piece = owner[order], place[order], piece[order]
        lost = np.flatnonzero(piece < 0)
        counts = np.ones(len(piece), dtype=np.int64)
        raw = [joined[place[i] - 1].encode() for i in lost.tolist()]
        counts[lost] = [len(item) for item in raw]
        out = np.repeat(piece, counts).astype(np.int32)
        if len(lost):
            out[np.repeat(piece < 0, counts)] = self.vocabulary.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_text)])

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts with the mark in them: cut there, as no piece holds it, and encode what lies between."""
        parts, kinds, owner = [], [], []
        for place, text in enumerate(texts):
            for i, part in enumerate(text.split("\0")):
                if i:
                    parts.append("")
                    kinds.append(True)
                    owner.append(place)
                if part:
                    parts.append(part)
                    kinds.append(False)
                    owner.append(place)
        ids, begins = self._relaxed([part for part, mark in zip(parts, kinds, strict=True) if not mark])
        lists, plain = [[] for _ in texts], 0
        zero = self.vocabulary.byte_ids[:1]
        for mark, place in zip(kinds, owner, strict=True):
            lists[place].append(zero if mark else ids[begins[plain] : begins[plain + 1]])
            plain += not mark
        joined = [np.concatenate(items) if items else np.zeros(0, dtype=np.int32) for items in lists]
        return np.concatenate(joined).astype(np.int32), np.concatenate([[0], np.cumsum([len(item) for item in joined])])


class Decoder:
    """Texts of pieces; the blank put before the first word goes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        sizes = np.array([len(item) for item in vocabulary.text_bytes], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.sizes = sizes
        self.data = np.frombuffer(b"".join(vocabulary.text_bytes), dtype=np.uint8)

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts, and where each begins."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(self.first[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        offsets = np.concatenate([[0], ends])[begins]
        blank = np.zeros(len(data), dtype=bool)
        some = np.flatnonzero(np.diff(offsets) > 0)
        heads = offsets[:-1][some]
        blank[heads[data[heads] == 32]] = True
        return data[~blank], offsets - np.concatenate([[0], np.cumsum(blank)])[offsets]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _text_slices(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    texts, size, low = [], 0, 0
    for value in column:
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= limit:
            yield low, texts
            low, texts, size = low + len(texts), [], 0
    if texts:
        yield low, texts


def encode_documents(docs: DataFrame, model: str = MODEL, id_column: str = "doc_id") -> DataFrame:
    """The id, ``n_pieces``, ``ids`` and ``round_trip`` of every whole text.

    ``round_trip`` tells whether decoding the pieces gives the text again; it does unless the text
    holds the mark that stands for a blank. The model, under 1 MB, is read on the driver and broadcast.
    """
    data = docs.sparkSession.sparkContext.broadcast(read_model(model))
    schema = docs.select(id_column).schema.add("n_pieces", "long").add("ids", ArrayType(IntegerType())).add("round_trip", "boolean")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(data.value)
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            for low, texts in _text_slices(batch.column(1)):
                ids, begins = encoder.encode(texts)
                back, offsets = decoder.decode(ids, begins)
                whole = back.tobytes()
                same = [whole[offsets[i] : offsets[i + 1]] == text.encode() for i, text in enumerate(texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, len(texts)),
                        pa.array(np.diff(begins)),
                        pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids)),
                        pa.array(same),
                    ],
                    names=schema.names,
                )

    return docs.select(id_column, "text").mapInArrow(encoded, schema)


def decode_documents(encoded: DataFrame, model: str = MODEL, id_column: str = "doc_id") -> DataFrame:
    """The id and ``text`` of rows with a column ``ids``; null ids are an empty text, damaged bytes U+FFFD."""
    data = encoded.sparkSession.sparkContext.broadcast(read_model(model))
    schema = encoded.select(id_column).schema.add("text", "string")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary_of(data.value))
        for batch in batches:
            rows = [np.array(row or [], dtype=np.int64) for row in batch.column(1).to_pylist()]
            begins = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int64)
            back, offsets = decoder.decode(np.concatenate([np.zeros(0, dtype=np.int64), *rows]), begins)
            texts = [back[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace") for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(id_column, "ids").mapInArrow(decoded, schema)
