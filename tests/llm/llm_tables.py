"""Small tables with the awkward cases that every operator must define."""

import pytest
from pyspark.sql import types as T

LONG = "der lange text mit vielen worten " * 3000

#: doc_id, text, lang: nulls in any column, empty, blank and long texts, ties, repeated rows.
AWKWARD = [
    (1, "the cat sat on the mat and the dog ran to the river by the old mill", "en"),
    (2, "THE CAT SAT ON THE MAT AND THE DOG RAN TO THE RIVER BY THE OLD MILL", "en"),
    (3, "le chat est assis sur la chaise et le chien court vers la maison du village", "fr"),
    (4, None, "en"),
    (5, "", None),
    (6, " \t\n ", "de"),
    (7, "12345 !!! 678", None),
    (None, "der hund und die katze sind im haus und schlafen in der nacht", "de"),
    (None, None, None),
    (9, LONG, "de"),
    (10, LONG + "ende", "de"),
    (11, "el perro y el gato duermen en la casa del pueblo durante la noche", "es"),
    (11, "el perro y el gato duermen en la casa del pueblo durante la noche", "es"),
    (11, "otra cosa muy distinta que nadie ha visto en el pueblo", "es"),
    (12, "Ünïcode ßtraße don't 'S 日本語 😀  two  spaces\n\nlines", None),
]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("id", "row", "n", "kept", "word", "score", "uid", "size")],
    ]
)


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, *["x"] * 8) for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
