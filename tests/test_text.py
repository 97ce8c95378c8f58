import pytest
from pyspark.sql import functions as F

from metaenrich.functions import text as T


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "tokens"),
    [("oldTownHall", ["old", "Town", "Hall"]), ("PDFReader2Go", ["PDF", "Reader2", "Go"]), ("riverbank", ["riverbank"]), ("NASA", ["NASA"]), ("ÉtéIndien", ["ÉtéIndien"]), ("a  B", ["a", "B"]), ("   ", [])],
)
def test_camel_tokens(spark, text, tokens):
    assert one(spark, T.camel_tokens(F.col("t")), t=text) == tokens


@pytest.mark.parametrize(("text", "joined"), [("oldTownHall", "oldtownhall"), ("riverbank", None), ("Two words", "twowords"), ("", None)])
def test_camel_concat(spark, text, joined):
    assert one(spark, T.camel_concat(F.col("t"), {}), t=text) == joined


@pytest.mark.parametrize(
    ("text", "expected"),
    [("Field  Notes", "fieldnotes"), ("semi-final_report", "semifinalreport"), ("Map/Atlas [old]", "mapatlasold"), ("What? Who!", "whatwho"), ("\u2003wide\u00a0space ", "widespace"), ("C++ & D#", "c++&d#"), ("'\"()", ""), (" ", "")],
)
def test_normalize(spark, text, expected):
    assert one(spark, T.normalize(F.col("t"), {}), t=text) == expected


def test_normalize_corrects_whole_words_only(spark):
    fixes = {"nots": "notes", "feild": "field"}
    assert one(spark, T.normalize(F.col("t"), fixes), t="FEILD nots") == "fieldnotes"
    assert one(spark, T.normalize(F.col("t"), fixes), t="nots, notsfeild") == "notesnotsfeild"
    assert one(spark, T.normalize(F.col("t"), fixes), t="feild-nots!") == "fieldnotes"


@pytest.mark.parametrize(("a", "b", "ratio"), [("", "", 1.0), ("x", "", 0.0), ("riverbed", "riverbank", 1 - 3 / 9), ("ö", "o", 0.0), ("\U0001f600a", "a", 0.5)])
def test_similarity(spark, a, b, ratio):
    assert one(spark, T.similarity(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(ratio, abs=1e-12)
