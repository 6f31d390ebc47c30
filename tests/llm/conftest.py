import pytest
from pyspark.sql import types as T

from sheetloom.llm.common import ship

PROSE = (
    "The river of the old town is wide and the boats of the harbour lie in a row, waiting for the morning tide.\n"
    "From the hill above you see the roofs, the mill and the long road that leads to the coast in the west.\n"
    "In winter the water is cold and the ferry stays at the pier, as it did in the days of our grandparents."
)
OTHER = (
    "Der Fluss in der alten Stadt ist breit und die Boote liegen im Hafen und warten auf die Flut am Morgen.\n"
    "Von dem Berg sieht man die Dächer, die Mühle und die lange Straße, die nach Westen an die Küste führt."
)
LONG = " ".join(f"word{i % 4001} of number{i % 977}" for i in range(30_000))
ODD = "★ 日本語 <|endoftext|> ▁▁ a  b  x\t\x00y \n  z "

#: Nulls, empty and very long texts, copies, repeated rows, one id with two texts, odd characters.
MESSY = [
    (1, PROSE), (2, None), (3, ""), (4, LONG), (5, PROSE), (6, " \n\n \t"), (7, ODD), (7, ODD),
    (8, OTHER), (8, PROSE + " Once more."), (None, OTHER), (None, None), (9, "x"), (10, "x" * 5000),
]
#: Extra columns with names that operators use themselves.
CLASHING = (
    "row score ids id nth row_key print fingerprint hash counts lang_pred bucket peek at whole gone host path rule verdict "
    "shard slot block rank length start text_key component_id keeper kept label parts lines"
).split()


def table(spark, rows):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHING]
    langs = {PROSE: "en", OTHER: "de"}
    return spark.createDataFrame([(i, t, langs.get(t), *(["kept as it is"] * len(CLASHING))) for i, t in rows], T.StructType(fields))


@pytest.fixture(scope="session")
def modules(spark):
    ship(spark)


@pytest.fixture(scope="session")
def messy(spark, modules):
    return table(spark, MESSY)


@pytest.fixture(scope="session")
def empty(spark, modules):
    return table(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1), (8, 0), (3, None), (None, 1), (6, 0), (4, 1)], "doc_id long, quality int")
