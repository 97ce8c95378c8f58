"""JSON-lines sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .scratch import delete_path

#: Bytes that a copy holds at a time.
_BUFFER = 4 << 20


def write_jsonl(records: DataFrame, path: str, single_file: bool = False) -> None:
    """Writes the string column `value`, one line a record, as part files of the folder `path`, or as one file in it.

    One file is made of part files that all tasks have written and committed, in their order. An empty frame leaves a
    folder without lines. The folder is replaced only once all its bytes are written.
    """
    out = records.select("value")
    if not single_file:
        out.write.mode("overwrite").text(path)
        return
    parts = f"{path.rstrip('/')}.parts"
    out.write.mode("overwrite").text(parts)
    try:
        join_parts(out.sparkSession, parts, path)
    finally:
        delete_path(out.sparkSession, parts)


def join_parts(spark: SparkSession, parts: str, path: str) -> None:
    """Makes the committed files of `parts`, by name, one file in the folder `path`.

    A file system that can concatenate does so without moving a byte; on others the bytes are copied in blocks of a
    fixed size, and records are neither parsed nor made again.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source = hadoop.fs.Path(parts)
    system = source.getFileSystem(conf)
    found = [s.getPath() for s in system.listStatus(source) if s.isFile() and not s.getPath().getName().startswith(("_", ".")) and s.getLen()]
    found.sort(key=lambda p: p.getName())
    folder = hadoop.fs.Path(source, "_one")
    system.mkdirs(folder)
    whole = hadoop.fs.Path(folder, "part-00000.txt")
    if found and system.hasPathCapability(source, "fs.capability.paths.concat"):
        rest = spark._gateway.new_array(hadoop.fs.Path, len(found) - 1)
        for i, part in enumerate(found[1:]):
            rest[i] = part
        if len(rest):
            system.concat(found[0], rest)
        system.rename(found[0], whole)
    else:
        sink = system.create(whole, True)
        try:
            for part in found:
                stream = system.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(stream, sink, _BUFFER, False)
                finally:
                    stream.close()
        finally:
            sink.close()
    system.create(hadoop.fs.Path(folder, "_SUCCESS"), True).close()
    delete_path(spark, path)
    if not system.rename(folder, hadoop.fs.Path(path)):
        raise OSError(f"{path} can't be replaced")
