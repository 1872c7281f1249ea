"""Small tables with the cases every operator has to bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results or inside.
        T.StructField("score", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("bucket", T.StringType()),
    ]
)


def texts(seed=5, n=40):
    """Made-up prose with shared passages, copies, odd white space, nulls, empty and very long texts."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeéñü") for _ in range(draw.randint(1, 7))) for _ in range(150)]
    passage = " ".join(draw.choice(words) for _ in range(60))
    out = []
    for _ in range(n):
        body = " ".join(draw.choice(words) for _ in range(draw.randint(1, 90)))
        if draw.random() < 0.3:
            body += ".\n" + passage + ".\n" + " ".join(draw.choice(words) for _ in range(8))
        out.append(body)
    out += ["", None, " ", "\n\n", out[0], out[0], out[1] + " x", "  two  blanks \n \n end ", "A", "Word " * 300]
    out.append(" ".join(draw.choice(words) for _ in range(12000)))
    return out


def rows(seed=5, n=40):
    found = [(i, t, "xx", "src", len(t) if t is not None else None, "s", "f", "h", "l", "b") for i, t in enumerate(texts(seed, n))]
    found.append(found[2])  # a repeated row
    found.append((None, found[3][1], None, None, None, None, None, None, None, None))
    found.append((None, None, None, None, None, None, None, None, None, None))
    return found


def docs(spark, seed=5, n=40):
    return spark.createDataFrame(rows(seed, n), DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)
