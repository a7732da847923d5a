"""Looking at text files that somebody else wrote before they are parsed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stagehouse.functions.casts import find_field
from stagehouse.sources.staging import hadoop_path


def plain_path(spark: SparkSession, escaped: str) -> str:
    """The path of an input file, which Spark names as an escaped URI."""
    uri = spark._jvm.java.net.URI(escaped)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a text file, packed or not; some kilobytes are read."""
    path, fs = hadoop_path(spark, file)
    io = spark._jvm.org.apache.hadoop.io.compress
    codec = io.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = fs.open(path)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        java = spark._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def unknown_fields(found: T.DataType, target: T.DataType, at: str = "") -> list[str]:
    """Names in ``found``, at any depth, that ``target`` has no place for."""
    if isinstance(found, T.ArrayType) and isinstance(target, T.ArrayType):
        return unknown_fields(found.elementType, target.elementType, f"{at}[]")
    if not isinstance(found, T.StructType):
        return []
    if isinstance(target, T.MapType):  # every name is a key
        return [n for f in found for n in unknown_fields(f.dataType, target.valueType, f"{at}{{}}")]
    if not isinstance(target, T.StructType):
        return []  # a value of another type, which the parser refuses
    out = []
    for field in found.fields:
        place = find_field(target, field.name)
        name = f"{at}.{field.name}" if at else field.name
        out += [name] if place is None else unknown_fields(field.dataType, place.dataType, name)
    return out
