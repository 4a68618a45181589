"""Small tables with the awkward cases, and brute-force helpers."""

from __future__ import annotations

import random

SPACE = b" \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empties, repeated rows, one
    id with two texts, copies, near copies, a long text, odd white space."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage, long = say(120), say(40), say(30_000)
    near = base.split(" ")
    near[50] = "changed"
    texts = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, "two words"), (6, "TWO words"),
             (7, base), (8, base), (8, base), (9, " ".join(near)), (10, base.upper()), (11, base + " tail"),
             (12, say(30) + " " + passage + " " + say(25)), (13, passage + "\n" + say(50)), (14, say(60) + "\t" + passage),
             (15, long), (16, long[:5000] + " " + say(3000)), (17, say(20)), (17, say(20)), (None, base),
             (18, "a b c \x1c d\x85e " + say(15)), (19, say(7) * 3), (20, "x " * 300), (21, "y z\n" * 60),
             (22, "café \U0001f600 " + say(30)), (23, passage), (24, passage), (25, say(13)), (26, say(12))]
    out = []
    for k, (i, t) in enumerate(texts):
        source = None if k % 7 == 3 else f"s{k % 4}"
        out.append((i, t, "en" if k % 2 else None, source, None if t is None else len(t)))
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def with_clashes(df):
    """More columns, named like columns that operators make or use inside."""
    from pyspark.sql import functions as F

    for name in ("size", "target", "taken", "score", "predicted", "n_words", "n_removed", "kept_text", "node", "key",
                 "row", "n", "low", "h", "hits", "component", "words", "posterior", "kept", "epochs", "_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def components(n: int, links) -> list[int]:
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def tuples(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
