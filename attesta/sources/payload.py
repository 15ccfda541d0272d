"""Reading and writing payloads: JSON documents in several envelopes, JSON lines, facts, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import Document, json_document

ENVELOPES = ("items", "laptops", "records", "data")


def _array(v: Column, names: tuple[str, ...]) -> Column:
    tries = [F.when(F.schema_of_variant(v).startswith("ARRAY"), v)]
    tries += [F.try_variant_get(v, f"$.{n}", "variant") for n in names]
    return F.coalesce(*tries)


def read_payload(spark: SparkSession, path: str, names: tuple[str, ...] = ENVELOPES, strict: bool = True) -> DataFrame:
    """(path, pos, raw, n_keys): the records of a JSON array, or of the first of the named members; ``raw`` keeps which keys are present.

    Documents are read in splits. Without ``strict``, what holds no list gives no rows.
    """
    return _records(Document(spark, path), path, names, strict)


def _records(doc: Document, path: str, names: tuple[str, ...], strict: bool = True) -> DataFrame:
    lists = doc.outline.select("path", _array(F.col("v"), names).alias("a"))
    if strict and not lists.where("a IS NOT NULL").take(1):
        raise ValueError(f"{path} holds no list of records")
    return doc.records(lists).withColumn("n_keys", F.size(F.json_object_keys("raw")))


class PayloadError(ValueError):
    """A payload that does not have the shape asked for."""


def read_rows(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The rows of a list, or of an object's ``items`` or ``data``, and which of the three it was; anything else, no rows, or a row that is no object is an error."""
    doc = Document(spark, path)
    shape = F.when(F.schema_of_variant("v").startswith("ARRAY"), "list")
    for n in ("items", "data"):
        shape = shape.when(F.schema_of_variant(F.try_variant_get("v", f"$.{n}", "variant")).startswith("ARRAY"), n)
    found = doc.outline.select(shape.alias("s")).first()
    if found is None or found["s"] is None:
        raise PayloadError(f"{path} is neither a list nor an object of items or data")
    rows = _records(doc, path, () if found["s"] == "list" else (found["s"],))
    odd, n = rows.agg(F.count_if(F.col("n_keys").isNull()), F.count(F.lit(1))).first()
    if not n or odd:
        raise PayloadError(f"{path} has no rows" if not n else f"{path} has {odd} rows that are no objects")
    return rows, found["s"]


def read_optional(spark: SparkSession, path: str, names: tuple[str, ...] = ENVELOPES) -> DataFrame | None:
    """The records of a payload that may be missing or empty: none then. One that is there and is no payload is an error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where) or fs.getContentSummary(where).getLength() == 0:
        return None
    return read_payload(spark, path, names)


def read_facts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of facts with the schema given; a file that is missing or is no JSON is an empty table, so that it never stops what asks it."""
    try:
        found = read_optional(spark, path, ())
    except ValueError:
        found = None
    if found is None:
        return spark.createDataFrame([], schema)
    return found.select(F.from_json("raw", schema).alias("r")).select("r.*")


def object_or_empty(text: Column) -> Column:
    """A JSON object as a variant; what is missing, broken or no object is an empty one."""
    v = json_document(text)
    return F.coalesce(F.when(F.schema_of_variant(v).startswith("OBJECT"), v), F.parse_json(F.lit("{}")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(raw) of the lines that are JSON objects; blank, broken and other lines are skipped."""
    return objects(spark.read.text(path), "value")


def objects(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.schema_of_variant(json_document(F.col(column))).startswith("OBJECT")).select("*", F.trim(column).alias("raw"))


#: A JSON string, without backtracking.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def strict_json(text: Column) -> Column:
    """True where a text is JSON without repeated keys and without numbers that are not finite; what strings hold is not looked at."""
    bare = F.regexp_replace(text, STRING, '""')
    return json_document(text).isNotNull() & ~bare.rlike(r"NaN|Infinity|\d[eE]\+?(?:[4-9]\d\d|3[1-9]\d|309|\d{4,})")


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def rewrite_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_payload(df: DataFrame, path: str) -> None:
    """One JSON object a line; a single document of a published table is made by its reader, not in one task."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(ord, path, text) of the logs that are there, numbered in the order given; others are passed over. A handful of files of one run."""
    out = spark.createDataFrame([], "ord int, path string, text string")
    for k, p in enumerate(paths):
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(where) and fs.getFileStatus(where).isFile():
            out = out.unionAll(read_log(spark, p).select(F.lit(k), "path", "text"))
    return out


def joined(logs: DataFrame) -> DataFrame:
    """(text): the logs of one run in their order, a line apart."""
    return logs.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))
