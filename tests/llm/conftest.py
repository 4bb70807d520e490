import pytest
from pyspark.sql import types as T

LONG = 60_000


DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

#: Names that the operators use inside or add.
CLASHING = (
    "id size shard shard_group unit cell cell_start slot law kept keep_id group_size run digest fp row u v root node score "
    "items item_id distance part seeded taken target source_size epochs cut cut_words s copy gone gone_id gone_lines host "
    "wrapper licenses kind start end label stays line no at h1 h2 words total weight text_col"
).split()


@pytest.fixture(scope="session")
def awkward(spark):
    """Null in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(LONG // 6))
    prose = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the deep dark wood"
    rows = [
        (1, prose, "en", "a", 10),
        (2, prose, "en", "a", 10),
        (2, prose, "en", "a", 10),
        (3, prose + " now", "en", "b", None),
        (4, None, "en", "b", 0),
        (5, "", None, "b", 0),
        (6, "   \n\t ", "de", None, 5),
        (None, "no identifier here at all", "de", "c", 1),
        (None, "no identifier here at all", "de", "c", 1),
        (7, long, "en", "c", LONG),
        (8, "x" * LONG, "en", "c", LONG),
        (9, "7" * LONG, "en", None, LONG),
        (10, "Zeile eins ist lang genug\nZeile eins ist lang genug\nZeile eins ist lang genuk", "de", "d", 3),
        (None, None, None, None, None),
        (11, "mail a.b@example.com now", "en", "d", 2),
        (-5, "short", "en", "d", 5),
    ]
    docs = spark.createDataFrame(rows, DOCUMENT)
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("kept as it is") for name in CLASHING})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
