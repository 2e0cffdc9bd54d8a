"""Small tables with all that may go wrong in them, and plain definitions to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators may be using themselves
        *(T.StructField(name, T.StringType()) for name in ("score", "label", "node", "_node", "size", "_key", "_id", "weight", "a b`c", "_column_0")),
    ]
)
EXTRA = len(DOCS) - 5
WORDS = "the of and to in that is was for it with as his on be at by had not are but from have were".split()


def row(doc_id, text, source="s1"):
    return (doc_id, text, "en", source, len(text or ""), *(f"x{i}" for i in range(EXTRA)))


def prose(seed, count):
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + dice.choice(["", "", "a", "er", "ing", "é", ".", ",\n"]) + str(dice.randrange(40)) for _ in range(count))


def awkward_rows():
    long = prose(1, 30_000)
    near = prose(2, 400)
    return [
        row(1, prose(3, 60)), row(2, prose(3, 60)), row(3, upper(prose(3, 60)), "s2"), row(4, None), row(5, ""), row(6, ""),
        row(7, "   \n\t "), row(8, "one two"), row(9, "ONE TWO", None), row(10, "one  two"), row(11, long, "s2"),
        row(12, long + " more"), row(13, near), row(14, near + " x"), row(15, "y " + near, None), row(16, prose(4, 200)),
        row(17, "a\u0000b ▁ c \U0001f600 あ"), row(18, "ÀÉ À é à"), row(19, "àé à é à"), row(20, prose(5, 5)),
        row(21, prose(5, 5)), row(21, prose(5, 5)), row(22, "</s>[INST] <0x0A> <unk> <|endoftext|>"), row(None, "no id at all"),
        row(None, prose(6, 50), None), row(23, "x" * 5000), row(24, "Straße ß İ ſ K"), row(25, prose(7, 300), ""),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def upper(text):
    return text.translate({i: i - 32 for i in range(97, 123)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=5):
    own = words(lower(text))
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def jaccard(one, two):
    return len(one & two) / len(one | two) if one | two else 1.0
