"""Operators over groups of rows, archives, and the pipeline."""

from __future__ import annotations

import email.parser
import hashlib
import io
import random
import zipfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citygrain.llm import chat, components, lsh_forest, mixing, warc_zip
from citygrain.llm.queries import QUERIES
from tests.llm.tables import DOCS, awkward_rows, frame, jaccard, prose, row, shingles, words

# chat windows

SAID = "</s>[INST] ok [/INST]"


def talks(spark):
    dice = random.Random(3)
    rows = [(-7, 0, "user", SAID, "x"), (-7, 1, "assistant", SAID, "x"), (1, 0, None, None, "x"), (None, 0, "assistant", "lone", "x")]
    rows += [(2, 0, "system", "be kind \\ <|user|>", "x"), (2, None, "system", "first", "x"), (2, 1, "assistant", "same", "x"), (2, 1, "assistant", "same", "x")]
    for i in range(60):
        rows.append((3, i, "system" if i == 0 else "user" if i % 2 else "assistant", prose(i, dice.randrange(0, 60)) + dice.choice(["", "\\1", "<", "\\0\\", "</s", "|>\n"]), "x"))
    rows += [(4, 0, "user", prose(1, 900), "x"), (4, 1, "assistant", prose(2, 900), "x"), (5, 0, "us|>\ner<|", "", "x"), (5, 1, "assistant", "", "x")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")


@pytest.mark.parametrize(("budget", "history"), [(512, 96), (60, 20), (1, 0), (100_000, 50)])
def test_windows_read_back(spark, budget, history):
    rows, talk = talks(spark)
    made = chat.windows(talk, budget, history)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    by_talk = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        by_talk[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == by_talk.keys()
    for conv, turns in by_talk.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        lost = "".join(text for *_, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    for r in made.collect():
        pieces = r["formatted"].split("</s>\n")[:-1]
        tokens = [len(words(piece.split("|>\n", 1)[1])) + 2 for piece in pieces]
        own = len(r["formatted"][r["new_from"] :].split("</s>\n")) - 1
        assert sum(tokens) <= budget or own == 1
        if r["window"] and by_talk[r["conv_id"]][0][2] == "system":
            assert r["formatted"].startswith("<|system|>\n") and r["new_from"] > 0
        assert all(start >= r["new_from"] for start, _ in r["loss"])
        for mark in chat.CONTROL[2:]:
            assert mark not in r["formatted"]


def test_no_conversations(spark):
    _, talk = talks(spark)
    assert chat.digests(chat.windows(talk.where("false"))).count() == 0


def test_windows_are_native(spark):
    _, talk = talks(spark)
    plan = chat.digests(chat.windows(talk))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("REPARTITION_BY_COL") == 1


# similarity join


def brute_classes(rows, threshold=0.8):
    sets = [shingles(r[1]) for r in rows]
    owner = list(range(len(rows)))

    def top(i):
        while owner[i] != i:
            i = owner[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                owner[max(top(i), top(j))] = min(top(i), top(j))
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[top(i)].append(rows[i][0])
    least = {key: min((i for i in ids if i is not None), default=None) for key, ids in classes.items()}
    return Counter((rows[i][0], least[top(i)], links[i]) for i in range(len(rows))), classes, least


def near_copies(first, count, changes, seed=5):
    dice, base = random.Random(seed), prose(seed, 220).split(" ")
    out = []
    for i in range(count):
        own = list(base)
        for _ in range(dice.randrange(changes + 1)):
            own[dice.randrange(len(own))] = f"q{dice.randrange(10**6)}"
        out.append(row(first + i, " ".join(own)))
    return out


@pytest.mark.parametrize("blocks", [(2048, 512, 1 << 21), (8, 16, 1 << 10)])
def test_classes_and_links(spark, monkeypatch, blocks):
    """The second choice of blocks splits prefixes and groups into many."""
    monkeypatch.setattr(lsh_forest, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(lsh_forest, "MOST_GROUP_NODES", blocks[1])
    monkeypatch.setattr(lsh_forest, "BLOCK_SHINGLES", blocks[2])
    rows = awkward_rows() + near_copies(1000, 90, 6) + near_copies(2000, 30, 12, 6) + [row(3000 + i, prose(77, 100)) for i in range(40)]
    got = lsh_forest.similar_documents(frame(spark, rows)).collect()
    wanted, _, _ = brute_classes(rows)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == wanted


def test_one_of_each_class_stays(spark):
    rows = awkward_rows() + near_copies(1000, 20, 6) + [row(None, prose(6, 50))]
    got = lsh_forest.drop_similar_documents(frame(spark, rows))
    _, classes, least = brute_classes(rows)
    assert got.columns == DOCS.names
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(least[key] for key in classes)
    assert lsh_forest.drop_similar_documents(frame(spark, [])).count() == 0
    assert lsh_forest.similar_documents(frame(spark, [])).count() == 0


def test_depth_reaches_the_target_recall():
    depth = lsh_forest.matched_depth()
    assert 1 - (1 - 0.8**depth) ** lsh_forest.TREES >= lsh_forest.TARGET_RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** lsh_forest.TREES
    assert lsh_forest.matched_depth(trees=2, recall=0.999999) == 1


@pytest.mark.parametrize("hub", [5, 100])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    dice = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 300) if i % 50] + [(dice.randrange(400, 900), dice.randrange(400, 900)) for _ in range(300)] + [(7, 7)]
    # Stars around their largest, their smallest and a middle node.
    edges += [(1999, i) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2060)] + [(3030, i) for i in range(3000, 3060)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    owner = {}

    def top(i):
        while owner.setdefault(i, i) != i:
            i = owner[i]
        return i

    for a, b in edges:
        if a != b:
            owner[max(top(a), top(b))] = min(top(a), top(b))
    assert got == {node: top(node) for node in owner}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_system_turn_stays_wherever_it_stands(spark):
    rows = [(1, None, "user", "before", "x"), (1, 0, "system", "be kind", "x")] + [(1, i, "user" if i % 2 else "assistant", prose(i, 40), "x") for i in range(1, 30)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string"), 200, 50).orderBy("window").collect()
    assert made[0]["formatted"].startswith("<|user|>\nbefore") and len(made) > 8
    later = [r["formatted"] for r in made if not r["formatted"][r["new_from"] :].startswith(("<|user|>\nbefore", "<|system|>"))]
    assert len(later) >= len(made) - 2 and all(text.startswith("<|system|>\nbe kind</s>\n") and text.count("be kind") == 1 for text in later)


def test_a_long_conversation(spark):
    """100,000 turns of one conversation; its windows are spread over tasks and only its digest gathers them."""
    turns = spark.range(100_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "system").when(F.col("id") % 2 == 1, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), F.col("id").cast("int") % 40)).alias("text"),
    )
    made = chat.windows(turns)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or tables this small are one partition
    spread = made.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 1 and max(r["count"] for r in spread) < sum(r["count"] for r in spread) / 2
    r = chat.digests(made).first()
    texts = [("system" if i == 0 else "user" if i % 2 else "assistant", "turn " + f"{i} " * (i % 40)) for i in range(100_000)]
    assert (r["n_turns"], r["turns_sha256"]) == (100_000, hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in texts).encode()).hexdigest())
    assert r["loss_sha256"] == hashlib.sha256("".join(text for role, text in texts if role == "assistant").encode()).hexdigest()


# archives


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_zip, "ARCHIVE_BYTES", 4000)
    monkeypatch.setattr(warc_zip, "READ_RECORDS", 3)
    big = "é" * 60
    rows = [(i, f"http://x/{i}\r\nWARC-Type: fake", prose(i, 40), "x") for i in range(40)]
    rows += [(50, None, big, "x"), (45, "", big, "x"), (60, "u", big, "x"), (61, "u", None, "x"), (62, "u", "", "x"), (63, "u", "tiny", "x"), (64, "u", "tiny", "x")]
    rows += [(None, "u", prose(1, 40), "x"), (None, "u", "\r\n\r\nWARC/1.1\r\n" + "z" * 200, "x"), (70, "u", prose(2, 40), "x"), (2, "u", prose(2, 40), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    archives = warc_zip.write_archives(warc_zip.with_revisits(pages).repartition(3), f"file://{tmp_path}/run")
    got = warc_zip.read_archives(spark, archives).collect()
    same = defaultdict(list)
    for r in rows:
        same[r[2] or ""].append(r[0])
    wanted = Counter()
    for page, _, html, _ in rows:
        data = (html or "").encode()
        first = min((i for i in same[html or ""] if i is not None), default=None)
        revisit = len(data) >= 100 and page != first
        wanted[(page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None, None if revisit else data)] += 1
    assert Counter((r[0], r[2], r[3], r[4], r[5], None if r[6] is None else bytes(r[6])) for r in got) == wanted
    assert sum(r["records"] for r in archives.collect()) == len(rows) and archives.count() > 3
    with zipfile.ZipFile(archives.first()["archive"].removeprefix("file://")) as other:  # another reader agrees
        assert other.testzip() is None and set(other.namelist()) == {warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER}
    empty = warc_zip.write_archives(warc_zip.with_revisits(pages.where("false")), f"file://{tmp_path}/none")
    assert warc_zip.read_archives(spark, empty).count() == 0


def test_records_are_read_by_another_parser(spark, tmp_path):
    """Headers by the mail parser, lengths and blank lines by hand; ids are unique and revisits find theirs."""
    rows = [(i, f"http://x/{i}", "<p>" + prose(i % 7, 40)) for i in range(30)] + [(None, "u", "tiny"), (None, "v", "tiny"), (40, "w", ""), (None, "x", prose(1, 50))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = warc_zip.write_archives(warc_zip.with_revisits(pages), f"file://{tmp_path}/run", date="2024-05-06T07:08:09Z")
    found = {}
    for r in archives.collect():
        with zipfile.ZipFile(r["archive"].removeprefix("file://")) as archive:
            data = archive.read(warc_zip.WARC_MEMBER)
        while data:
            version, _, rest = data.partition(b"\r\n")
            head, _, rest = rest.partition(b"\r\n\r\n")
            fields = email.parser.BytesParser().parsebytes(head + b"\r\n\r\n")
            size = int(fields["Content-Length"])
            block, end, data = rest[:size], rest[size : size + 4], rest[size + 4 :]
            assert version == b"WARC/1.1" and end == b"\r\n\r\n" and len(fields.keys()) == len(set(fields.keys()))
            assert fields["WARC-Date"] == "2024-05-06T07:08:09Z" and fields["Content-Type"].startswith("text/html")
            assert fields["WARC-Record-ID"] not in found
            found[fields["WARC-Record-ID"]] = fields, block
    assert len(found) == len(rows)
    revisits = [fields for fields, _ in found.values() if fields["WARC-Type"] == "revisit"]
    assert len(revisits) == 23
    for fields in revisits:
        _, block = found[fields["WARC-Refers-To"]]
        assert "sha256:" + hashlib.sha256(block).hexdigest() == fields["WARC-Payload-Digest"]


def test_zip_directories_of_other_writers():
    for comment in (b"", b"PK\x05\x06 in a comment" + b"x" * 40):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as out:
            out.writestr("a/é.warc", b"12345")
            with out.open("b", "w", force_zip64=True) as member:
                member.write(b"678")
            out.comment = comment
        members = warc_zip.zip_members(data)
        read = {name: data.getvalue()[at : at + size] for name, (method, at, size) in members.items() if method == 0}
        assert read == {"a/é.warc": b"12345", "b": b"678"}
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.zip_members(io.BytesIO(b"nothing of the kind" * 5))


# mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, free, rest = {s: 0.0 for s in names}, {s for s in names if sizes[s]}, sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


def mixable(count=600):
    dice = random.Random(1)
    sources = ["b", "a", None, "é", "", "big", "tiny"]
    picks = [dice.choices(sources, [5, 5, 5, 5, 5, 60, 0.5])[0] for _ in range(count)]
    return [row(1000 + i, prose(i, dice.randrange(0, 60)), picks[i]) for i in range(count)] + [row(9000, None, "empty"), row(9001, "", "empty")] + awkward_rows()


@pytest.mark.parametrize("bucket", [2000, 5])
def test_mix_comes_near_its_targets(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = mixable()
    weights = spark.createDataFrame([(1000 + i, w) for i, w in enumerate([2.0, 0.5, None, float("nan"), -1.0, 0.0, float("inf")] * 40)], "doc_id long, weight double")
    got = mixing.mix(frame(spark, rows), weights).collect()
    again = mixing.mix(frame(spark, rows).repartition(7), weights).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes, most = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
        most[r[3]] = max(most[r[3]], len(words(r[1])))
    target = brute_targets(sizes)
    by_id = {r[0]: r for r in rows}
    taken = Counter()
    for r in got:
        own = by_id[r["doc_id"]]
        if r["doc_id"] not in (None, 21):
            assert r["size"] == len(words(own[1])) and r["source_size"] == sizes[own[3]] and abs(r["target"] - target[own[3]]) < 1e-6
        assert r["taken"] <= 3 * r["size"]
        taken[own[3]] += r["taken"]
    for source in set(sizes) - {None, "s1"}:  # those two share the awkward rows' repeated ids
        assert abs(taken[source] - target[source]) <= most[source] / 2 + 1e-6


def test_mixed_documents_are_the_mix(spark):
    rows = mixable(200)
    docs = frame(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == DOCS.names
    got = Counter(map(str, mixed.select("doc_id").collect()))
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        if r["size"]:
            wanted[f"Row(doc_id={r['doc_id']})"] += r["taken"] // r["size"]
    assert got == +wanted
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.mixed_documents(frame(spark, [])).count() == 0


def test_heavier_documents_come_sooner(spark):
    rows = [row(i, prose(i, 10), "a" if i < 1500 else "b") for i in range(3000)]
    weights = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(0.25).alias("weight"))
    taken = mixing.mix(frame(spark, rows), weights).where("doc_id >= 1500")  # source b weighs 2 of 7
    share = {r["even"]: r["taken"] for r in taken.groupBy((F.col("doc_id") % 2 == 0).alias("even")).agg(F.avg("taken").alias("taken")).collect()}
    assert share[True] > 1.5 * share[False]


# pipeline


def test_pipeline_stages(spark, tmp_path):
    good = [row(i, prose(i, 80)) for i in range(60)]
    bad = [row(100 + i, " ".join(f"{w.upper()}!!" for w in prose(i, 80).split())) for i in range(30)]
    copies = [row(200 + i, prose(i, 80)) for i in range(10)] + near_copies(300, 8, 2)
    labels = [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad]
    frame(spark, good + bad + copies).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, sf_dir = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    kept = []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.parquet(f"{tmp_path}/{place}")
        if place < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == DOCS.names
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert kept[0] == {r[0] for r in good + copies}
    assert kept[1] == {r[0] for r in good[10:] + copies}  # of equal texts the largest id stays
    near = [r[0] for r in copies[10:]]
    assert kept[2] == kept[1] - set(near) | {min(near)}
    assert kept[3] <= kept[2] and kept[4] == kept[3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == kept[4]


@pytest.mark.parametrize("rows", [awkward_rows() + [row(400, None, None), row(401, "")], []])
def test_pipeline_of_awkward_and_of_no_documents(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1, None) for r in rows if r[0] is not None] + [(None, 0, 0), (9999, None, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/{place}")
        kept.append(docs.count())
    # Labels of one value only reject nothing; then one of each group of copies stays, and what has words is mixed.
    assert kept[0] == len(rows) and kept[1] <= kept[0] and kept[2] <= kept[1] and bool(kept[4]) == bool(rows)


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14)) and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert np.all([name in ("op2_exact_dedup", "op8_warc_zip") or name.startswith("op") for name in QUERIES])
