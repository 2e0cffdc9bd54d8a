"""Vector codes, id files and ranked search, held against plain definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from citygrain.llm import files, id_files, norm_buckets, vector_codes
from tests.llm.tables import awkward_rows, frame, lower, prose, row

# vector codes

VECTORS = "vec_id long, embedding array<float>, label int, code string, `a b` string"


def test_search_finds_the_nearest_entry():
    dice = np.random.default_rng(5)
    for width, count in ((1, 16), (3, 16), (8, 16), (8, 1), (4, 200)):
        entries = dice.integers(-6, 6, (count, width))  # small numbers, so many ties and equal entries
        points = dice.integers(-7, 7, (500, width)).astype(np.int64)
        apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        index = vector_codes.Orchard(entries)
        best, nearest = index.search(points)
        assert (best == apart.argmin(axis=1)).all() and (nearest == apart.min(axis=1)).all()
    spread = dice.integers(-1000, 1000, (200, 2))
    index = vector_codes.Orchard(spread)
    index.search(spread[dice.integers(0, 200, 2000)])
    assert index.compared < 2000 * 200 / 3


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [([max(-(1 << 26), min(1 << 26, math.floor(4096 * float(np.float32(x))))) for x in r[1]], r) for r in kept]
    whole.sort(key=lambda w: (w[1][0] is None, w[1][0] or 0, w[0]))
    whole = [w for w in whole if len(w[0]) == len(whole[0][0])]
    width = -(-len(whole[0][0]) // parts) if whole else 0
    cut = [[(v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width] for p in range(parts)] for v, _ in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for c in cut:
                members[nearest(c[p], book)[1]].append(c[p])
            books[p] = [[sum(x) // len(members[i]) for x in zip(*members[i], strict=True)] if i in members else e for i, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, totals = [], Counter()
    for c, (_, r) in zip(cut, whole, strict=True):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        totals[r[2]] += error
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), error))
    return Counter((i, code, error, totals[label], digest) for i, label, code, error in out)


def vectors(seed, count, width):
    dice = random.Random(seed)
    return [(i, [round(dice.gauss(0, 0.3), 2) for _ in range(width)], dice.choice([0, 1, None]), "x", "y") for i in range(100, 100 + count)]


def broken_vectors():
    nan, inf = float("nan"), float("inf")
    rows = vectors(1, 60, 16)
    rows += [(1, None, 0, "", ""), (2, [], 0, "", ""), (3, [nan] * 16, 0, "", ""), (4, [0.5] * 15 + [None], 1, "", "")]
    rows += [(5, [inf] + [0.0] * 15, 1, "", ""), (6, [-0.0, 1e30, -1e30, 3.4e38] * 4, 1, "", ""), (None, [0.25] * 16, None, "", "")]
    return rows + [(7, [0.1] * 9, 1, "", ""), (8, [0.2] * 16, 1, "", ""), (8, [0.2] * 16, 1, "", ""), (8, [0.1] * 16, 2, "", "")]


@pytest.mark.parametrize("rows", [broken_vectors(), vectors(2, 40, 13), vectors(3, 5, 64), vectors(4, 30, 3), [(1, None, 0, "", "")], []])
def test_codes_are_those_of_plain_loops(spark, rows):
    got = vector_codes.compress_vectors(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == plain_codes(rows)


def test_codes_stand_for_vectors(spark):
    rows = vectors(6, 400, 16)
    books, whole = vector_codes.fit_codebooks(vector_codes.integer_vectors(spark.createDataFrame(rows, VECTORS)).cache())
    codes = vector_codes.encode_vectors(whole, books).cache()
    errors = {r["vec_id"]: r["error"] for r in codes.collect()}
    for r in vector_codes.decode_vectors(codes, books).collect():
        own = [math.floor(4096 * float(np.float32(x))) for x in rows[r["vec_id"] - 100][1]]
        assert errors[r["vec_id"]] == sum((a - round(b * 4096)) ** 2 for a, b in zip(own, r["embedding"], strict=True))


# id files


@pytest.fixture(scope="module")
def encoder():
    return id_files.PieceEncoder()


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(id_files.TOKENIZER)
    return [encoded.ids for encoded in tokenizer.encode_batch(texts, add_special_tokens=False)]


BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0    ​    　﻿᠎"


def test_pieces_are_encoded_like_whole_texts(encoder, monkeypatch):
    monkeypatch.setattr(id_files, "_SEGMENT", 40)
    monkeypatch.setattr(id_files, "_KEPT_PIECES", 50)
    monkeypatch.setattr(id_files, "_KEPT_TOKENS", 50)
    dice = random.Random(11)
    texts = [r[1] or "" for r in awkward_rows()]
    texts += ["".join(dice.choice(BLANKS * 2 + "ab1'!ésﬀ あ\U0001f600\0") for _ in range(dice.randrange(1, 200))) for _ in range(1500)]
    texts += ["".join(dice.choice("ab1'!sdtmrevl <|>_\t\n\0\x7f") for _ in range(dice.randrange(1, 100))) for _ in range(1500)]
    texts += ["".join(dice.choice([chr(dice.randrange(0x80, 0x260)), " ", "a", "'", "1", "-"]) for _ in range(dice.randrange(1, 60))) for _ in range(1500)]
    texts += [" " * 1000 + "a", "it's  we'll\n\n\n x", "<|endoftext|> <|endoftext|>a <|endof text|>", "́ á ́"]
    for text, ids in zip(texts, library_ids(texts), strict=True):
        assert np.frombuffer(encoder.encode(text), f"<u{encoder.width}").tolist() == ids, repr(text)


def test_other_vocabularies_are_encoded_whole():
    from tokenizers import Tokenizer

    path = id_files.TOKENIZER.replace("byte_bpe_50k", "word_bpe_49k")
    encoder, library = id_files.PieceEncoder(path), Tokenizer.from_file(path)
    for text in ("The cat  sat.", "ÀÉ 12 x"):
        assert np.frombuffer(encoder.encode(text), f"<u{encoder.width}").tolist() == library.encode(text, add_special_tokens=False).ids


def test_very_long_texts_are_encoded(encoder):
    for text in (" " * 1_000_000 + "a", "b" * 1_000_000, "word and " * 300_000):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library_ids([text])[0]


def wanted_ids(rows):
    """Contract rows by ascending id, null ids first; rows of one id may stand in either order."""
    groups = defaultdict(list)
    for r, ids in zip(rows, library_ids([r[1] or "" for r in rows]), strict=True):
        groups[r[0]].append([*ids, 0])
    return groups


@pytest.mark.parametrize("limit", [64 << 20, 500])
def test_files_hold_all_ids_in_order(spark, monkeypatch, limit):
    monkeypatch.setattr(id_files, "FILE_BYTES", limit)
    rows = awkward_rows() + [row(1000 + i, prose(i, i % 90)) for i in range(150)] + [row(2000, "same text")] * 40
    dice = random.Random(1)
    dice.shuffle(rows)
    folder = files.new_folder(spark, "ids")
    manifest = id_files.write_ids(frame(spark, rows).repartition(5), folder)
    got = sorted(id_files.read_ids(manifest, folder, ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    left, start = wanted_ids(rows), 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        left[r["doc_id"]].remove(r["ids"])
        start += r["n_tokens"]
    assert not any(left.values())
    assert [ids.tolist() for ids in id_files.read_document(spark, manifest, folder, 16)] == wanted_ids([r for r in rows if r[0] == 16])[16]
    assert id_files.read_document(spark, manifest, folder, 999_999) == []


def test_another_dictionary_is_refused(spark):
    folder = files.new_folder(spark, "ids")
    manifest = id_files.write_ids(frame(spark, [row(i, prose(i, 200)) for i in range(120)]), folder)
    name = manifest.first()["file"]
    with files.open_read(f"{folder}/dictionary") as file:
        dictionary = file.read()
    with id_files.IdFile(name, dictionary) as source:
        assert [source.document(i).tolist() for i in range(len(source.tokens))] == [ids.tolist() for ids in source.documents(100)]
    with pytest.raises(ValueError, match="dictionary"):
        id_files.IdFile(name, dictionary + b"x")


def test_no_documents_no_files(spark):
    folder = files.new_folder(spark, "ids")
    assert id_files.read_ids(id_files.write_ids(frame(spark, []), folder), folder).collect() == []


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranking(rows, items, best=10):
    texts = [(r[0], TERM.findall(lower(r[1]))) for r in rows]
    texts = [(doc_id, Counter(terms), len(terms)) for doc_id, terms in texts if terms]
    count, total = len(texts), sum(n for *_, n in texts)
    holding = Counter(term for _, terms, _ in texts for term in terms)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id].update(TERM.findall(lower(text)))
    out = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, own, n in texts:
            m = 10 + (90 * n * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * holding[t] + 1))) * ((1_000_000_000 * own[t]) // (1000 * own[t] + 8 * m)) for t in terms if t in own
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -low) for rank, (low, *_, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:best], 1)]
    return Counter(out)


def ranking_rows():
    dice = random.Random(4)
    rows = awkward_rows() + [row(5000 + i, prose(i % 70, dice.randrange(1, 120)) + f" rare{i % 13} x{i}") for i in range(400)]
    return rows + [row(900 + i, prose(70, 30)) for i in range(60)] + [row(950, prose(70, 30))] * 3


ITEMS = [(i, prose(i, 25) + f" Rare{i} rare{i + 1}") for i in range(20)]
ITEMS += [(50, None), (51, ""), (52, "-- ''"), (53, "nowhere zzz"), (54, prose(70, 30)), (54, "extra words rare5"), (None, "ONE two"), (55, prose(1, 30_000)), (56, "é あ ÀÉ")]


@pytest.mark.parametrize(("first", "bounded", "block", "focus"), [(8192, 512, 2048, 8), (20, 7, 3, 2), (1, 64, 2048, 30)])
def test_ranking_is_that_of_all_scores(spark, monkeypatch, first, bounded, block, focus):
    monkeypatch.setattr(norm_buckets, "FIRST_DOCUMENTS", first)
    monkeypatch.setattr(norm_buckets, "BOUNDED", bounded)
    monkeypatch.setattr(norm_buckets, "BLOCK_ITEMS", block)
    monkeypatch.setattr(norm_buckets, "FOCUS", focus)
    rows = ranking_rows()
    items = spark.createDataFrame([(*item, "x") for item in ITEMS], "item_id long, text string, doc_id string")
    got = norm_buckets.ranked_documents(frame(spark, rows).repartition(4), items).collect()
    assert Counter(tuple(r) for r in got) == plain_ranking(rows, ITEMS)


def test_no_documents_or_items_no_ranking(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert norm_buckets.ranked_documents(frame(spark, []), items).collect() == []
    assert norm_buckets.ranked_documents(frame(spark, ranking_rows()), items.limit(0)).collect() == []


def test_bounds_leave_few_documents_to_score():
    """Bounds never drop a document of the answer, and drop most others."""
    dice = np.random.default_rng(9)
    terms, docs = 400, 3000
    share = 1 / np.arange(1, terms + 1)  # the first terms are frequent and weigh little
    share /= share.sum()
    weights = (1000 * np.log(1 / share)).astype(np.int64)
    asked = [np.unique(dice.choice(terms, 12, p=(share + 1 / terms) / 2)) for _ in range(20)]
    items = norm_buckets._Items(asked, weights)
    own = [np.unique(dice.choice(terms, dice.integers(2, 60), p=share)) for _ in range(docs)]
    own[:200] = [asked[i % 20] for i in range(200)]
    impacts = [weights[t] * dice.integers(200_000, 600_000, len(t)) for t in own]
    lengths = np.array([math.sqrt(float((i.astype(float) ** 2).sum())) for i in impacts])
    search = norm_buckets._Search(items, np.ones(20, dtype=np.int64), 10)
    order = np.argsort(-lengths, kind="stable")
    for low in range(0, docs, 100):
        part = order[low : low + 100]
        begins = np.concatenate([[0], np.cumsum([len(own[d]) for d in part])])
        search.add(part, np.zeros(len(part), dtype=np.int64), lengths[part], begins, np.concatenate([own[d] for d in part]), np.concatenate([impacts[d] for d in part]))
    assert search.scored < search.bounded < 20 * docs and search.scored < 20 * docs / 3
    for item, terms_of in enumerate(asked):
        scores = sorted(((-sum(x for t, x in zip(own[d], impacts[d].tolist(), strict=True) if t in set(terms_of.tolist())), d) for d in range(docs)))[:10]
        assert [(r[1], r[3]) for r in search.found.tolist() if r[0] == item] == scores
