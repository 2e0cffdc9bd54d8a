"""Operators that must do the whole job, held against plain definitions."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from citygrain.llm import fingerprints, lsh_forest, ngram_lm, quality
from tests.llm.tables import awkward_rows, frame, jaccard, lower, prose, row, shingles, words
from tests.llm.test_tables import brute_classes, near_copies


@pytest.mark.parametrize("blocks", [(2048, 512, 1 << 21), (8, 16, 1 << 10)])
def test_band_links_are_all_links(spark, monkeypatch, blocks):
    """Near copies around 0.8, most of them below it to the smallest document of their bands."""
    monkeypatch.setattr(lsh_forest, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(lsh_forest, "MOST_GROUP_NODES", blocks[1])
    monkeypatch.setattr(lsh_forest, "BLOCK_SHINGLES", blocks[2])
    rows = awkward_rows() + near_copies(1000, 40, 12) + [row(3000 + i, prose(77, 100)) for i in range(5)]
    got = fingerprints.verified_links(frame(spark, rows)).collect()
    wanted, _, _ = brute_classes(rows)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == Counter(
        {key: n for key, n in wanted.items() if key[2]}
    )
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    texts = dict(sets)
    for r in got:
        linked = [i for i, other in sets if jaccard(texts[r["doc_id"]], other) >= 0.8]
        linked.remove(r["doc_id"])
        assert r["leader_id"] == min(linked) and r["jaccard"] == jaccard(texts[r["doc_id"]], texts[r["leader_id"]])


@pytest.mark.parametrize("order", [1, 3, 4])
def test_scores_use_all_words_of_the_order(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "PAIR_SHARD_TOKENS", 2000)
    monkeypatch.setattr(ngram_lm, "WORD_SHARD_BYTES", 1 << 14)
    monkeypatch.setattr(ngram_lm, "COUNTED", 3000)
    texts = [prose(i % 25, 60) + f" {prose(i, 20)}" for i in range(60)]
    rows = [r for r in awkward_rows() if r[0] not in (None, 21)] + [row(300 + i, text) for i, text in enumerate(texts)]
    got = ngram_lm.score_documents(frame(spark, rows).coalesce(3), order=order).collect()
    lines = {r[0]: [*words(lower(r[1])), "\0"] for r in rows}
    counts, after = Counter(), defaultdict(set)
    total = size = 0
    for doc_id, line in lines.items():
        if zlib.crc32(str(doc_id).encode()) % 10:
            total += len(line)
            padded = ["\0", *line]
            for i in range(1, len(padded)):
                counts[padded[i],] += 1
                for n in range(2, min(order, i + 1) + 1):
                    gram = tuple(padded[i - n + 1 : i + 1])
                    counts[gram] += 1
                    after[gram[:-1]].add(gram[-1])
    size = sum(len(gram) == 1 for gram in counts)

    def chance(context, word):
        if not context:
            return (counts[word,] + 0.1) / (total + 0.1 * (size + 1))
        shorter = chance(context[1:], word)
        if not after[context]:
            return shorter
        seen = sum(counts[(*context, w)] for w in after[context])
        return max(counts[(*context, word)] - 0.75, 0) / seen + 0.75 * len(after[context]) / seen * shorter

    assert len(got) == len(rows)
    for r in got:
        padded = ["\0", *lines[r["doc_id"]]]
        wanted = sum(np.log10(chance(tuple(padded[max(0, i - order + 1) : i]), padded[i])) for i in range(1, len(padded)))
        assert abs(r["score"] - wanted) < 0.02 * r["n_tokens"]


@pytest.mark.parametrize("threshold", [0.6, 0.7])
def test_links_below_the_usual_threshold(spark, threshold):
    rows = awkward_rows() + near_copies(1000, 40, 20)
    got = lsh_forest.similar_documents(frame(spark, rows), threshold).collect()
    wanted, _, _ = brute_classes(rows, threshold)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == wanted


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.7, 0.8, 0.95])
def test_sketches_lose_next_to_nothing_at_the_threshold(threshold):
    least, dice = lsh_forest.least_agreeing(threshold), np.random.default_rng(1)
    assert 0 < least < threshold * lsh_forest.SKETCH
    assert dice.binomial(lsh_forest.SKETCH, threshold, 1_000_000).min() >= least
    assert lsh_forest.least_agreeing(1.0) == lsh_forest.SKETCH


def test_passages_of_a_text_do_not_depend_on_the_text_before():
    texts = [b"Abc", b"", b"9 x" * 300, b"|", b"|", b"", b"zz"]
    alone = [quality.passage_features(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)]))[0] for t in texts]
    for order in (range(7), (6, 4, 2, 0, 1, 3, 5), (3, 2, 4, 1, 5, 0, 6)):
        data = np.frombuffer(b"".join(texts[i] for i in order), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in order])])
        features, first = quality.passage_features(data, offsets)
        for place, i in enumerate(order):
            assert np.array_equal(features[first[place] : first[place + 1]], alone[i])


def test_scores_do_not_depend_on_order_and_partitions(spark):
    rows = [row(i, prose(i, 3 + i % 4)) for i in range(40)] + [row(100, "ab"), row(100, "ab"), row(101, "")]
    model = quality.AttentionModel()
    made = [quality.score_quality(frame(spark, own).repartition(parts), model).collect() for own in (rows, rows[::-1]) for parts in (1, 5)]
    known = [{(r["doc_id"], round(r["score"], 6)) for r in got} for got in made]
    assert all(one == known[0] for one in known) and len(known[0]) == 42
