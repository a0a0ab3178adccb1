import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, kinds=400):
    return [f"{rng.choice(['wo', 'Ré', 'the', 'an', 'Ña', 'x'])}{rng.randrange(kinds)}" for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """Documents with every odd thing that the operators must take."""
    rng = random.Random(3)
    line = lambda n=9: " ".join(words(rng, n))
    passage, block = " ".join(words(rng, 60)), "\n".join(line() for _ in range(4))
    base = [line(70), line(90)]
    near = words(rng, 200)
    texts = [
        None, "", " \n\t ", "one", "two words", base[0], base[0], base[0].upper(),
        base[1] + " " + passage, passage + "\n" + line(50), line(40) + "\t" + passage + " " + line(30),
        block + "\n" + line(), line() + "\n\n" + block, "\n".join(["a b"] * 7), "x " * 3000, " \u0085 \x1c odd\x00spaces",
        " ".join(near), " ".join(near[:-1]), " ".join(near[1:] + ["q"]), " ".join(near[:150] + words(rng, 50)),
        "\n".join(line(12) for _ in range(1500)), "\n".join(line(12) for _ in range(30)),
        "Here under the MIT License, or Apache License Version 2; cc by-nc. CC BY NC " + line(30),
        *["".join(rng.choice("ab \n") for _ in range(rng.randrange(300))) for _ in range(20)],
    ]
    found = [(i, t, "en", f"src{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    found += [(5, texts[5], "en", "src1", 1), (5, texts[5], "en", "src1", 1), (None, texts[8], None, None, None), (None, None, None, None, None), (8, "other text of an id " + line(60), "en", "src0", None)]
    return found


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with further columns, whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["text_key", "row", "kept", "places", "w", "h", "n", "key", "size", "range", "node", "copies", "label", "head", "i", "k", "spans", "taken"]
    return df.select("*", *[F.lit(j).alias(c) for j, c in enumerate(clash)]).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
