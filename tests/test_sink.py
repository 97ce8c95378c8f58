"""The sink's single file: parts made by all tasks, joined in order."""

from pathlib import Path

from pyspark.sql import functions as F

from metaenrich.sources import sink


def lines(folder: Path) -> list[str]:
    files = sorted(folder.glob("part-*"))
    assert len(files) == 1
    return files[0].read_text("utf-8").splitlines()


def test_one_file_of_many_parts_in_order(spark, tmp_path):
    out = tmp_path / "out"
    rows = spark.range(0, 5000, 1, 7).select(F.concat(F.lit('{"é":'), "id", F.lit("}")).alias("value"), F.lit(1).alias("other"))
    for _ in range(2):  # the second run replaces the first one
        sink.write_jsonl(rows, str(out), single_file=True)
        assert lines(out) == [f'{{"é":{i}}}' for i in range(5000)]
    assert (out / "_SUCCESS").exists() and not (tmp_path / "out.parts").exists()


def test_records_are_made_by_all_tasks(spark, tmp_path):
    tasks = spark.range(0, 70, 1, 7).select(F.spark_partition_id().cast("string").alias("value"))
    sink.write_jsonl(tasks, str(tmp_path / "out"), single_file=True)
    assert set(lines(tmp_path / "out")) == {str(i) for i in range(7)}


def test_no_records_and_empty_parts(spark, tmp_path):
    rows = spark.range(0, 100, 1, 10).select(F.col("id").cast("string").alias("value"))
    sink.write_jsonl(rows.where("value is null"), str(tmp_path / "none"), single_file=True)
    assert lines(tmp_path / "none") == []
    assert spark.read.text(str(tmp_path / "none")).count() == 0
    sink.write_jsonl(rows.where("id = 55"), str(tmp_path / "one"), single_file=True)
    assert lines(tmp_path / "one") == ["55"]


def test_a_failed_run_leaves_the_earlier_file(spark, tmp_path):
    out = tmp_path / "out"
    sink.write_jsonl(spark.createDataFrame([("kept",)], "value string"), str(out), single_file=True)
    broken = spark.range(10).select(F.raise_error(F.lit("broken")).cast("string").alias("value"))
    try:
        sink.write_jsonl(broken, str(out), single_file=True)
        raise AssertionError("must fail")
    except Exception as error:  # noqa: BLE001
        assert "broken" in str(error)
    assert lines(out) == ["kept"]
