import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(WORDS) + r.choice(WORDS)[:3] + str(r.randrange(9)) * (r.random() < 0.02)
        out.append(w.capitalize() if i % 9 == 0 else w + ". " * (i % 9 == 8) + "\n" * (i % 27 == 26))
    return " ".join(out)


@pytest.fixture(scope="session")
def texts():
    """Texts of every awkward kind, by doc_id."""
    base = prose(1, 300)
    near = base.split(" ")
    near[150] = "changed"
    rows = [(1, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, None), (5, "", "en"), (6, "one", "de"),
            (7, "One", None), (8, "Zwei Wörter", "de"), (9, "zwei wörter", "de"), (10, "... !!! 123", "fr"), (11, prose(2, 40), "fr"),
            (12, prose(3, 20_000), "en"), (13, "x" * 50_000, "en"), (14, "日本語のテキスト。" * 20, "ja"), (15, " \t\n ", "en"),
            (16, "a b c d e", "en"), (17, "A B  C\td e", "en"), (18, "\u0085nbsp word é É", "fr"), (19, prose(2, 41), "fr"),
            (20, "+1 (988) 555-2485 a@b.co 10.0.0.1 and 4337166598464399", "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, lang, f"src{i % 3}", len(t or "")) for i, t, lang in texts], DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def cluttered(docs):
    """The same documents with extra columns whose names clash with results."""
    from pyspark.sql import functions as F
    out = docs
    for c in ("score", "predicted", "size", "shard", "slot", "component", "class", "range", "copy", "elements", "u", "v", "h", "n", "held_out", "spans"):
        out = out.withColumn(c, F.lit("clash"))
    return out


@pytest.fixture(autouse=True, scope="session")
def few_partitions(spark):
    """Small tables: fewer tasks for each of the many small jobs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
