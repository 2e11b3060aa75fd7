import random

import pytest

#: Names that the operators use inside, as extra columns of the input.
CLASHING = ["row", "found", "digest", "best", "fingerprint", "size", "block", "shard", "copy", "windows", "n_words", "score", "a.b"]


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="session")
def texts(vocabulary):
    """Nulls, empty and long texts, copies, near copies, shared passages, odd characters."""
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = [prose(rng.randint(1, 120)) for _ in range(60)]
    passage = prose(40)
    out = [None, None, "", "   \n\t", "Ab", "aB", "ab", "one two", "\x00\x1f \x85  word", "💡 " * 30]
    out += base + base[:20] + [b.upper() for b in base[:5]] + [b.replace(" ", "  \n") for b in base[5:10]]
    out += [f"{b} {passage} {prose(30)}" for b in base[20:40]]
    out += [b.replace(b.split()[0], "changed", 1) for b in base[40:]]
    out += [prose(20_000), " ".join(["again"] * 3000), passage]
    return out


@pytest.fixture(scope="session")
def rows(texts):
    """(doc_id, source, text), with null ids and sources, ids used twice and repeated rows."""
    out = [(None if k % 41 == 7 else (k * 37) % 200, None if k % 13 == 5 else f"s{k % 6}", t) for k, t in enumerate(texts)]
    return out + out[10:14] + [out[0], out[8]]


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, clashing=False):
        df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
        if clashing:
            for k, c in enumerate(CLASHING):
                from pyspark.sql import functions as F

                df = df.withColumn(c, F.lit(f"kept {k}"))
        return df

    return make


def plain_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
