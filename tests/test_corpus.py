"""One pass over gzip files: their lines, and what is wrong with a file."""

import gzip
import json
import os
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter

from metaenrich.operators.resource_type import ResourceTypeGeneral
from metaenrich.plans import catalogue
from metaenrich.plans.catalogue import PROVENANCE
from metaenrich.plans.runner import RunOptions, run
from metaenrich.plans.views import shipped_rules
from metaenrich.sources.corpus import judge_files, list_files, read_lines
from metaenrich.sources.gzip_lines import Unpacker, between, read_gzip_lines, unpack


def read(data, cuts=None, block=1 << 20, size=None):
    """(lines, damage) of a file with these bytes, given as Spark's reader gives it, in Arrow batches cut at random."""
    pieces = data.split(b"\n")
    if pieces[-1] == b"":
        pieces.pop()
    rng, at, batches = random.Random(cuts), 0, []
    while at < len(pieces):
        n = rng.randrange(1, 4) if cuts else len(pieces)
        part = pieces[at : at + n]
        batches.append(pa.RecordBatch.from_arrays([pa.array(["f"] * len(part)), pa.array([len(data) if size is None else size] * len(part)), pa.array(part, pa.binary())], ["path", "size", "piece"]))
        at += n
    lines, verdicts = [], []
    for batch in unpack(iter(batches), block):
        lines += [v for v in batch.column(0).cast(pa.binary()).to_pylist() if v is not None]
        verdicts += [f for f in batch.column(1).to_pylist() if f]
    assert len(verdicts) == (1 if pieces else 0) and all(v["lines"] == len(lines) for v in verdicts)
    return lines, verdicts[0]["damage"] if verdicts else None


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"\n", b"\n\n", b"a\r\nb\rc\n\nd", b"\n" * 100_000, os.urandom(300_000), b"x" * 3_000_000 + b"\n\xff\xfe\n"], ids=range(9))
def test_lines_are_those_of_the_text(text):
    expected = text.split(b"\n")
    expected = expected[:-1] if expected[-1] == b"" else expected
    for packed in (gzip.compress(text), gzip.compress(text[: len(text) // 3]) + gzip.compress(text[len(text) // 3 :]), gzip.compress(text, 0), gzip.compress(text) + b"\0" * 9):
        for cuts, block in ((None, 1 << 20), (3, 4096), (4, 7 if len(text) < 10 else 1000)):
            assert read(packed, cuts, block) == (expected, None)


def test_damage_is_told_and_lines_before_it_are_kept():
    lines = [b"line %d %s" % (i, os.urandom(20).hex().encode()) for i in range(20_000)]
    packed = gzip.compress(b"\n".join(lines) + b"\n")
    for cut in (len(packed) - 1, len(packed) - 9, len(packed) // 2, 5):
        found, damage = read(packed[:cut], 5, 5000)
        assert damage == "cut short" and found == lines[: len(found)] and (cut < 100 or len(found) > 4000)
    flipped = bytearray(packed)
    flipped[-6] ^= 1  # of the checksum
    assert read(bytes(flipped))[1] and read(b"not gzip")[1] and read(packed + b"junk")[1] and read(packed + packed[:30])[1]
    assert read(packed, size=len(packed) + 10)[1] == "not read to its end"
    assert read(packed + packed)[0] == lines * 2


def test_a_file_of_three_gib_is_read_in_bounded_blocks_and_its_damage_found():
    """Unpacked 3 GiB and 64 KiB; the last bytes of the checksum are wrong."""
    chunk, packer = b"0123456789abcde\n" * (1 << 16), zlib.compressobj(1, zlib.DEFLATED, 31)
    packed = b"".join([packer.compress(chunk) for _ in range(3 << 10)] + [packer.flush()])
    unpacker, total, most = Unpacker(1 << 16), 0, 0
    for at in range(0, len(packed), 4096):
        piece = packed[at : at + 4096]
        for block in unpacker.feed(piece if at + 4096 < len(packed) else piece[:-5] + bytes([piece[-5] ^ 1]) + piece[-4:]):
            total, most = total + len(block), max(most, len(block))
    assert total >= (3 << 30) - (1 << 16) and most <= 1 << 16 and "incorrect" in unpacker.end()


def write(folder, name, data):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.jsonl.gz").write_bytes(data)


def test_discovery_and_verdicts(spark, tmp_path):
    root = tmp_path / "in"
    text = b"".join(b'{"id":"%d"}\n' % i for i in range(3000))
    write(root / "a b" / "c%20d", "whole", gzip.compress(text))
    write(root, "members", gzip.compress(text[:1000]) + gzip.compress(text[1000:]))
    write(root, "broken", b"not gzip")
    write(root / "a b", "cut", gzip.compress(text)[:-100])
    write(root, "empty", b"")
    write(root / "_hidden", "x", b"never looked at")
    (root / "x.txt").write_text("no")
    read = read_lines(spark, str(root)).cache()
    files = judge_files(spark, read, str(root))
    assert (files.count, files.failed, [p.rsplit("/", 1)[1] for p in files.examples]) == (4, 2, ["cut.jsonl.gz", "broken.jsonl.gz"])  # Spark lists no empty files
    verdicts = {r.file.path.rsplit("/", 1)[1].split(".")[0]: (r.file.lines, r.file.damage) for r in read.where("file is not null").collect()}
    assert verdicts["whole"] == verdicts["members"] == (3000, None) and set(verdicts) == {"whole", "members", "broken", "cut"} and verdicts["cut"][1] == "cut short"
    assert read.where("file is null").count() == sum(n for n, _ in verdicts.values())
    assert list_files(spark, str(root)).count() == 4
    assert read_lines(spark, str(tmp_path / "missing")).count() == 0 and judge_files(spark, read.limit(0), str(tmp_path / "missing")).count == 0


def test_files_of_a_task_are_told_apart(spark, tmp_path):
    """Many small files in few tasks, small blocks, lines longer than a block."""
    expected = {}
    for i in range(40):
        lines = [b"%d " % i + b"x" * (j * 37 % 900) for j in range(i)]
        write(tmp_path / "in", f"f{i:02}", gzip.compress(b"\n".join(lines)))
        expected[f"f{i:02}"] = len(lines)
    read = read_gzip_lines(spark, str(tmp_path / "in"), "*.jsonl.gz", block=64)
    assert {r.file.path[-14:-9].strip("/")[-3:]: (r.file.lines, r.file.damage) for r in read.where("file is not null").collect()} == {k: (n, None) for k, n in expected.items()}


def test_a_file_cut_midway_is_reported(spark, tmp_path):
    lines = [json.dumps({"id": f"10.9/{i}", "attributes": {"types": {"resourceType": f"Dataset {i * 7919}"}}}).encode() for i in range(20_000)]
    whole = gzip.compress(b"\n".join(lines))
    write(tmp_path / "in", "one", whole)
    write(tmp_path / "in", "two", whole[: len(whole) // 2])
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE)
    assert (stats.files_processed, stats.files_failed) == (1, 1) and 20_000 <= stats.records_scanned < 40_000 and stats.lines_malformed == 0


@pytest.mark.parametrize(("start", "end"), [(0, 500), (4, 1000), (0, 1000), (3, 4), (999, 1000)])
def test_a_stretch_of_a_file_in_pieces(start, end):
    data = bytes(i * i % 13 for i in range(1000))
    pieces = data.split(b"\n")
    batches = (pa.RecordBatch.from_arrays([pa.array([start] * n), pa.array([end] * n), pa.array(pieces[i : i + n], pa.binary())], ["start", "end", "piece"]) for i in range(0, len(pieces), 7) for n in [len(pieces[i : i + 7])])
    out = [v for b in between(batches) for v in b.column(0).cast(pa.binary()).to_pylist()]
    assert data.count(b"\n") > 50 and b"\n".join(out) == data[start:end]


def test_file_verdicts_sort_nothing_to_write_the_parts(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(catalogue, "read_lines", lambda s, root: seen.append(root) or read_lines(s, root))
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, _text=DataFrameWriter.text, **k: seen.append(self._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")) or _text(self, *a, **k))
    assert sorted((r.part, r.whole) for r in catalogue.file_verdicts(spark, tables).collect()) == [(0, True), (1, True), (2, True), (3, False), (4, False)]
    assert seen[0] == "5" and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_lines_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    seen = []

    class Watched(ResourceTypeGeneral):
        def prepare(self, parsed):
            seen.append(parsed.rdd.getNumPartitions())
            return super().prepare(parsed)

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl.gz").write_bytes(gzip.compress(b'{"id":"1"}\n' * 100))
    assert run(spark, Watched(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE).records_scanned == 100
    assert seen[0] >= 4
