"""Operators that look at one document at a time, and the exact ones."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from citygrain.llm import exact_dedup, fingerprints, ngram_lm, pieces, quality, token_counts
from citygrain.llm.words import MinHash, lowered, shingle_hashes, text_bytes, word_hashes
from tests.llm.tables import DOCS, awkward_rows, frame, jaccard, lower, prose, row, shingles, words


def test_words_and_shingles_are_those_of_the_definition(monkeypatch):
    monkeypatch.setattr("citygrain.llm.words.SLICE_BYTES", 64)
    texts = [r[1] for r in awkward_rows()]
    data, offsets = text_bytes(pa.array(texts))
    hashes, first = word_hashes(lowered(data), offsets)
    assert np.diff(first).tolist() == [len(words(text)) for text in texts]
    spelled = [word for text in texts for word in words(lower(text))]
    assert len(set(zip(spelled, hashes.tolist(), strict=True))) == len(set(spelled)) == len(set(hashes.tolist()))
    found, begins = shingle_hashes(hashes, first)
    sets = [frozenset(found[begins[i] : begins[i + 1]].tolist()) for i in range(len(texts))]
    wanted = [shingles(text) for text in texts]
    assert [len(item) for item in sets] == [len(item) for item in wanted]
    for i in range(len(texts)):
        for j in range(i):
            assert len(sets[i] & sets[j]) == len(wanted[i] & wanted[j])


def test_minhash_estimates_similarity():
    hasher = MinHash(256)
    both = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    agreed = (hasher.signature(both[:2000]) == hasher.signature(both[1000:])).mean()
    assert abs(agreed - 1 / 3) < 0.12


# quality


def labelled(spark, count=160):
    rows = [row(i, prose(i, 80) if i % 4 else " ".join(f"{w.upper()}!!" for w in prose(i, 80).split())) for i in range(count)]
    labels = [(i, int(i % 4 > 0), 0) for i in range(count)] + [(3, None, 0), (None, 1, 0), (10_000, 1, 1), (5, 1, 0)]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_learns_from_some_and_holds_for_others(spark):
    docs, labels = labelled(spark)
    model = quality.fit_quality_model(docs, labels, F.col("doc_id") % 3 != 0)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    assert all((got[i] >= 0.7) == (i % 4 > 0) for i in range(0, 160, 3))
    again = quality.fit_quality_model(docs.repartition(5), labels.repartition(3), F.col("doc_id") % 3 != 0)
    assert all(np.array_equal(model.weights[name], again.weights[name]) for name in model.weights)


def test_quality_of_awkward_texts(spark):
    docs, labels = labelled(spark)
    model = quality.fit_quality_model(docs, labels, F.lit(True), max_documents=40)
    rows = awkward_rows()
    scores = quality.score_quality(frame(spark, rows), model).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)
    kept = quality.keep_good(frame(spark, rows), model, 0.0)
    assert kept.columns == DOCS.names and sorted(map(str, kept.collect())) == sorted(map(str, frame(spark, rows).collect()))
    assert quality.score_quality(frame(spark, []), model).count() == 0
    one_sided = quality.fit_quality_model(docs, labels.where("quality = 1"), F.lit(True))
    assert {r["score"] for r in quality.score_quality(docs, one_sided).collect()} == {1.0}
    nothing = quality.fit_quality_model(docs, labels.where("false"), F.lit(True))
    assert {r["score"] for r in quality.score_quality(docs, nothing).collect()} == {0.5}



def test_learning_takes_whole_rows_with_labels(spark):
    rows = [row(i, prose(i, 300)) for i in range(40)] + [row(100, prose(1, 30_000)), row(101, None), row(5, prose(5, 300)), row(6, prose(99, 300))]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40, 2)] + [(i, 1) for i in range(1000, 9000)] + [(100, 1), (101, 0)], "doc_id long, quality int")
    texts = {r["doc_id"]: 0 for r in labels.collect()}
    sizes = {r["_text"]: r["n"] for r in docs.select(F.xxhash64("text").alias("_text"), F.octet_length("text").alias("n")).collect()}

    def taken(most, passages):
        found = quality.training_rows(docs, labels, F.lit(True), most, passages).collect()
        assert all(r["doc_id"] in texts for r in found) and len({(r["doc_id"], r["_text"]) for r in found}) == len(found)
        return found

    everything = taken(100, 100_000)  # labels without a document take no place
    assert {r["doc_id"] for r in everything} == {*range(0, 40, 2), 100, 101} and len(everything) == 23
    few = taken(100, 40)
    assert 0 < sum(-(-(sizes[r["_text"]] or 0) // quality.PASSAGE_BYTES) for r in few) <= 40 and 100 not in {r["doc_id"] for r in few}
    assert len(taken(7, 100_000)) == 7


def test_attention_gradients():
    random = np.random.default_rng(0)
    model = quality.AttentionModel()
    model.weights = {name: value.astype(np.float64) for name, value in model.weights.items()}
    passages, first = random.normal(size=(7, quality.FEATURES)), np.array([0, 3, 4, 7])
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = model._forward(passages, first)["logit"]
        return float(np.mean(np.logaddexp(0, logit) - labels * logit))

    for name, gradient in model._gradients(passages, first, labels).items():
        value = model.weights[name].ravel()
        for place in random.integers(0, value.size, 3):
            before = value[place]
            value[place] = before + 1e-6
            up = loss()
            value[place] = before - 1e-6
            down = loss()
            value[place] = before
            assert abs((up - down) / 2e-6 - gradient.ravel()[place]) < 1e-5, name


def test_long_text_has_the_passages_of_its_parts(monkeypatch):
    monkeypatch.setattr(quality, "SLICE_BYTES", 1024)
    data = np.frombuffer(prose(9, 2000).encode(), dtype=np.uint8)
    features, first = quality.passage_features(data, np.array([0, len(data)]))
    assert first.tolist() == [0, -(-len(data) // 512)] and np.allclose((features**2).sum(axis=1), 1, atol=1e-3)


# exact dedup


def brute_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in sorted(ids, key=lambda i: (i is not None, i)):
            stays = i == keep and left
            left -= bool(stays)
            out[(i, keep, len(ids), bool(stays), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("polynomial", [exact_dedup.Polynomial(), exact_dedup.Polynomial((3, 2), (1, 1))])
def test_exact_duplicates(spark, polynomial):
    """The second hash is so weak that many texts collide and comparison must part them."""
    rows = awkward_rows() + [row(100 + i, "ab cd"[i % 5 :] + "ab cd"[: i % 5]) for i in range(10)]
    got = exact_dedup.mark_exact_duplicates(frame(spark, rows), polynomial).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == brute_groups(rows)


def test_dropped_duplicates_keep_columns(spark):
    rows = awkward_rows()
    got = exact_dedup.drop_exact_duplicates(frame(spark, rows))
    wanted = Counter((key[0], key[4]) for key, n in brute_groups(rows).items() if key[3] for _ in range(n))
    assert got.columns == DOCS.names
    assert Counter((r["doc_id"], hashlib.sha256(lower(r["text"]).encode()).hexdigest()) for r in got.collect()) == wanted
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.mark_exact_duplicates(frame(spark, [])).count() == 0


def test_fingerprints_compose(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "CHUNK_BYTES", 7)
    polynomial = exact_dedup.Polynomial()
    texts = [prose(1, 40).encode(), b"", b"abc", prose(2, 9).encode()]
    whole = [polynomial.text(np.frombuffer(text, dtype=np.uint8), polynomial.powers()) for text in texts]
    one, two = (sum((b + 1) * pow(base, i, m) for i, b in enumerate(texts[0])) % m for base, m in zip(polynomial.bases, polynomial.moduli, strict=True))
    assert whole[0] == one << 31 | two
    chunks = [(i, seq, text[at : at + 5]) for i, text in enumerate(texts) for seq, at in enumerate(range(0, max(1, len(text)), 5))]
    got = exact_dedup.fingerprint_chunks(spark.createDataFrame(chunks, "doc_id long, seq long, chunk binary").repartition(6))
    assert {r["doc_id"]: (r["n_bytes"], r["fingerprint"]) for r in got.collect()} == {i: (len(text), whole[i]) for i, text in enumerate(texts)}


# fingerprints


@pytest.mark.parametrize("parts", [1, 9])
def test_edited_texts(spark, parts):
    rows = awkward_rows()
    got = fingerprints.edit_fingerprints(frame(spark, rows).repartition(parts)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [len(got)] == [len(rows)]
    wanted = Counter()
    close = []
    for place, r in enumerate(ordered):
        text, after = r[1] or "", ordered[(place + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted[(r[0], len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
        close.append((r[0], jaccard(shingles(text), shingles(edited)), jaccard(shingles(text), shingles(after))))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == wanted
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, edited, after in close:
        if doc_id is not None and doc_id != 21:
            assert abs(by_id[doc_id]["near_edited"] - edited) < 0.2 and abs(by_id[doc_id]["near_next"] - after) < 0.2
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == by_id[3]["fingerprint"] and by_id[4]["fingerprint"] == by_id[5]["fingerprint"]


def test_edited_texts_of_few_rows(spark):
    assert fingerprints.edit_fingerprints(frame(spark, [])).count() == 0
    alone = fingerprints.edit_fingerprints(frame(spark, [row(1, "abcd")])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and alone["near_next"] == 1


def test_verified_links(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    got = fingerprints.verified_links(frame(spark, rows)).collect()
    texts = {r[0]: shingles(r[1]) for r in rows}
    assert got and all(r["jaccard"] == jaccard(texts[r["doc_id"]], texts[r["leader_id"]]) >= 0.8 for r in got)
    assert {(2, 1), (3, 1), (14, 13), (15, 13), (12, 11), (9, 8)} <= {(max(r[0], r[1]), min(r[0], r[1])) for r in got}


# pieces


def test_pieces_are_those_of_the_library(spark, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 3000)
    monkeypatch.setattr(pieces, "MATCHED_CHARACTERS", 5000)
    rows = awkward_rows() + [row(200 + i, text) for i, text in enumerate(["  a  b\n\n c ", " ", "\n \n", "e" * 40 + " " * 33, "日本 語テ", "\r\t "])]
    got = pieces.encode_documents(frame(spark, rows).coalesce(2))
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    wanted = Counter((r[0], tuple(library.encode(r[1] or ""))) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == wanted
    assert {r["doc_id"] for r in got.where("not round_trip").collect()} == {17}
    back = pieces.decode_documents(got.where("doc_id <> 21"))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {
        r[0]: (r[1] or "").replace("▁", " ") for r in rows if r[0] is not None and r[0] != 21
    }
    assert pieces.encode_documents(frame(spark, [])).count() == 0


def test_every_piece_may_follow_as_merging_says():
    vocabulary = pieces.vocabulary_of(pieces.read_model())
    random = np.random.default_rng(4)
    one, two = (random.choice(vocabulary.matched, 3000) for _ in range(2))
    short = [i for i in vocabulary.matched.tolist() if len(vocabulary.pieces[i][0]) <= 3]
    one[:2000], two[:2000] = random.choice(short, 2000), random.choice(short, 2000)
    got = vocabulary.may_follow(one, two)
    for a, b, answer in zip(one.tolist(), two.tolist(), got.tolist(), strict=True):
        text = vocabulary.pieces[a][0] + vocabulary.pieces[b][0]
        if pieces.BLANK * 2 not in text:
            assert (vocabulary.merged(text) == [a, b]) == answer, text
    assert vocabulary.in_order


# language model


def test_elias_fano():
    random = np.random.default_rng(2)
    for count, bound in ((0, 10), (1, 1), (1000, 1 << 60), (5000, 7000), (70_000, 1 << 33)):
        values = np.sort(random.integers(0, bound, count, dtype=np.uint64))
        coded = ngram_lm.EliasFano(memoryview(ngram_lm.EliasFano.encode(values, bound)))
        assert coded.access(np.arange(count)).tolist() == values.tolist()
        asked = np.unique(np.concatenate([values, random.integers(0, bound, 500, dtype=np.uint64)]))
        place = coded.find(asked)
        assert np.array_equal(place >= 0, np.isin(asked, values)) and np.array_equal(values[place[place >= 0]], asked[place >= 0])


def test_scores_are_those_of_the_definition(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "PAIR_SHARD_TOKENS", 2000)
    monkeypatch.setattr(ngram_lm, "WORD_SHARD_BYTES", 1 << 14)
    monkeypatch.setattr(ngram_lm, "COUNTED", 3000)
    rows = awkward_rows() + [row(300 + i, prose(i, 60)) for i in range(40)]
    docs = frame(spark, rows).coalesce(3)
    got = ngram_lm.score_documents(docs).collect()
    counts, pairs, after = Counter(), Counter(), defaultdict(set)
    for r in rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10:
            line = [*words(lower(r[1])), "\0"]
            counts.update(line)
            for u, v in zip(["\0", *line], line, strict=False):
                pairs[u, v] += 1
                after[u].add(v)
    total, size = sum(counts.values()), len(counts)
    share = lambda v: (counts[v] + 0.1) / (total + 0.1 * (size + 1))
    wanted = defaultdict(list)
    for r in rows:
        line = [*words(lower(r[1])), "\0"]
        score = sum(
            np.log10(
                (max(pairs[u, v] - 0.75, 0) / counts[u] + 0.75 * len(after[u]) / counts[u] * share(v)) if counts[u] else share(v)
            )
            for u, v in zip(["\0", *line], line, strict=False)
        )
        wanted[r[0]].append((len(line), sum(counts[v] > 0 for v in line), total, sum(np.log10(share(v)) for v in line), score))
    assert len(got) == len(rows)
    for r in got:
        known = min(wanted[r["doc_id"]], key=lambda w: abs(w[3] - r["base_score"]))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == known[:3]
        assert abs(r["base_score"] - known[3]) < 1e-6 * len(wanted) and abs(r["score"] - known[4]) < 0.02 * r["n_tokens"]
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)


def test_scores_without_training(spark):
    assert ngram_lm.score_documents(frame(spark, [])).count() == 0
    got = ngram_lm.score_documents(frame(spark, [row(None, "a b"), row(None, None)])).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got) == [(1, 0, 0, 0), (3, 0, 0, 0)]


# token counts


def test_token_histogram(spark):
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.read_ranks(), special_tokens={})
    rows = awkward_rows()
    lengths = [len(encoding.encode_ordinary(r[1] or "")) for r in rows]
    histogram = token_counts.length_histogram(token_counts.token_counts(frame(spark, rows)))
    got = {r["n_tokens"]: r for r in histogram.collect()}
    assert {n: r["docs"] for n, r in got.items()} == Counter(lengths)
    for n, r in got.items():
        assert r["docs_longer"] == sum(length > n for length in lengths) and r["docs_total"] == len(rows)
        assert r["truncated_total"] == sum(min(length, n) for length in lengths) and r["tokens_total"] == sum(lengths)
    assert token_counts.truncated_total(histogram, 17).first()[0] == sum(min(length, 17) for length in lengths)
    assert token_counts.quantile(histogram, 0.5).first()[0] == sorted(lengths)[(len(lengths) - 1) // 2]
    empty = token_counts.length_histogram(token_counts.token_counts(frame(spark, [])))
    assert empty.count() == 0 and token_counts.truncated_total(empty, 5).first()[0] == 0


def test_long_runs_of_blanks_and_letters_are_counted(spark):
    import tiktoken

    encoding = tiktoken.Encoding("counts", pat_str=token_counts.PATTERN, mergeable_ranks=token_counts.read_ranks(), special_tokens={})
    run = 200_000
    texts = [" " * run, " " * run + "a", "b" + "\n" * run + " c d", "x" + "　" * run, "a\t" + " " * run + "\n", "no  run"]
    for text in texts:
        assert token_counts.text_length(encoding, text) == len(encoding.encode_ordinary(text))
    rows = [row(1, " " * 1_000_000 + "a"), row(2, "a" * 1_000_000), row(None, "\n" * 1_000_001)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(frame(spark, rows)).collect()}
    assert got == {1: 1_000_000, 2: 250_000, None: 500_001}
