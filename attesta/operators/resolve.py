"""Resolving records: identity groups, field-by-field folds, facts, gates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import listings as L


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    cols = df.columns
    packed = df.select(*keys, F.struct(*(F.col(o) if isinstance(o, str) else o for o in order)).alias("_o"), F.struct(*cols).alias("_r"))
    return packed.groupBy(*keys).agg(F.min_by("_r", "_o").alias("_r")).select("_r.*")


def merged_bool(c: Column) -> Column:
    """Any false makes false, else any true makes true, else unknown."""
    return F.bool_and(c)


def best_value(value: Column, quality: Column, order: Column) -> Column:
    """The value of the highest quality; of equals the first in order."""
    return F.min_by(value, F.struct((-quality).alias("q"), order.alias("o")))


def first_value_map(df: DataFrame, key: str, source: str, value: str, order: str) -> DataFrame:
    """(key, map) of each source's first value that is not empty."""
    one = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(key, source).agg(F.min_by(value, order).alias("_v"))
    return one.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "_v")))).alias("values"))


def last_wins(df: DataFrame, key: str, field: str, value: str, order: str) -> DataFrame:
    """(key, field, value): of each field the value of the last record, which is a map merge without building maps."""
    return df.groupBy(key, field).agg(F.max_by(value, order).alias(value))


def merge_groups(df: DataFrame, key: str, source: str, rank: str, order: str, flags: list[str]) -> DataFrame:
    """One row per identity: tri-state flags, its sources, each source's best rank, the best of all, the first record's order.

    Sources are folded first, so a group of any size reaches the second aggregation as one row a source.
    """
    part = df.groupBy(key, source).agg(F.min(rank).alias("_rank"), F.min(order).alias("_ord"), F.count(F.lit(1)).alias("_n"), *(merged_bool(F.col(f)).alias(f) for f in flags))
    return part.groupBy(key).agg(
        F.array_sort(F.collect_list(source)).alias("sources"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "_rank")))).alias("source_ranks"),
        F.min("_rank").alias("best_rank"), F.min("_ord").alias("first_ord"), F.sum("_n").alias("records"), *(merged_bool(F.col(f)).alias(f) for f in flags),
    )


def gate(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``df`` with ``reasons``, the names of the rules that do not hold for certain, in order, and ``eligible``."""
    reasons = F.filter(F.array(*(F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(name) for name, ok in rules)), lambda r: r.isNotNull())
    return df.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


#: Characters of the pieces by which short names are looked up.
GRAM = 12


def contained(df: DataFrame, names: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, fact_id, name): the names that a text contains. ``names`` has fact_id and name; blank names are in nothing.

    A text that contains a name has each word inside it, between blanks, as a word of its own; so names are looked up by their longest inner word, and those without
    one by their first characters, in equality joins. What is found is compared whole.
    """
    spoken = F.split("name", " ")
    inner = F.filter(F.slice(spoken, 2, F.greatest(F.size(spoken) - 2, F.lit(0))), lambda w: w != "")
    word = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    named = names.where(F.length("name") > 0).withColumn("_w", word).withColumn("_n", F.least(F.length("name"), F.lit(GRAM)))
    texts = df.select(F.col(key), text.alias("_t"))
    by_word = named.where("_w IS NOT NULL").select("fact_id", F.col("_w").alias("_g"))
    pairs = texts.select(key, F.explode(F.array_distinct(F.split("_t", " "))).alias("_g")).join(by_word, "_g").select(key, "fact_id")
    for n in sorted(r["_n"] for r in named.where("_w IS NULL").select("_n").distinct().collect()):  # GRAM widths at most
        grams = named.where((F.col("_n") == n) & F.col("_w").isNull()).select("fact_id", F.substring("name", 1, n).alias("_g"))
        pieces = F.array_distinct(F.regexp_extract_all("_t", F.lit(rf"(?s)(?=(.{{{n}}}))"), 1))
        pairs = pairs.unionAll(texts.select(key, F.explode(pieces).alias("_g")).join(grams, "_g").select(key, "fact_id"))
    whole = texts.join(pairs.distinct(), key).join(named.select("fact_id", "name"), "fact_id")
    return whole.where(F.col("_t").contains(F.col("name"))).select(key, "fact_id", "name").distinct()


def match_facts(df: DataFrame, facts: DataFrame, key: str, title: Column) -> DataFrame:
    """(key, fact_id): of the facts whose name the title contains, the longest, then the first. ``facts`` has fact_id and name."""
    return contained(df, facts, key, title).groupBy(key).agg(F.min_by("fact_id", F.struct((-F.length("name")).alias("l"), F.col("fact_id").alias("f"))).alias("fact_id"))


def fact_for(df: DataFrame, facts: DataFrame, key: str, title: Column) -> DataFrame:
    """(key, fact): the fact of a listing's series and size, as a struct.

    The title's series must contain the fact's, both without spaces, figures and edition words; a fact with a size asks for that size. Of several, the first with a size,
    else the first. ``facts`` has fact_id (its place), series, size_inch and what is to be known.
    """
    # Of facts with one name and size only the first can be chosen: many facts leave few names to be found.
    named = facts.withColumn("name", L.normal_series(F.col("series"))).where(F.coalesce("series", F.lit("")) != "")
    named = named.groupBy("name", F.coalesce("size_inch", F.lit("")).alias("_inch")).agg(F.min_by(F.struct(*facts.columns), "fact_id").alias("f")).select("name", "f.*")
    texts = df.select(F.col(key), L.normal_series(title).alias("_s"), L.screen_of_title(title).alias("_size"))
    found = contained(texts, named.select("fact_id", "name"), key, F.col("_s")).select(key, "fact_id")
    # A series of figures alone is in every title: by size, or the first without one.
    bare = named.where("name = ''")
    found = found.unionAll(texts.join(bare.where(F.coalesce("size_inch", F.lit("")) != "").select("fact_id", F.col("size_inch").alias("_size")), "_size").select(key, "fact_id"))
    if (first := bare.where(F.coalesce("size_inch", F.lit("")) == "").agg(F.min("fact_id")).first()[0]) is not None:
        found = found.unionAll(texts.select(key, F.lit(first)))
    size = F.coalesce("size_inch", F.lit(""))
    fits = found.join(texts.select(key, "_size"), key).join(named, "fact_id").where((size == "") | (size == F.col("_size")))
    order = F.struct((size == "").alias("unsized"), F.col("fact_id").alias("f"))
    return fits.groupBy(key).agg(F.min_by(F.struct(*facts.columns), order).alias("fact"))


def fill(value: Column, fact: Column, evidence: Column, name: str) -> tuple[Column, Column]:
    """The value or else the fact, and the evidence with a note where the fact was used."""
    used = value.isNull() & fact.isNotNull()
    return F.coalesce(value, fact), F.when(used, F.map_concat(evidence, F.create_map(F.lit(f"{name}_fact"), fact.cast("string")))).otherwise(evidence)


def fold_facts(facts: DataFrame, keys: list[str], flags: list[str], order: str, url: str) -> DataFrame:
    """Facts that agree on the keys: the first known value of each flag, and the different URLs in order; URLs are told apart before they are gathered."""
    first = facts.groupBy(*keys).agg(*(F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in flags))
    once = facts.groupBy(*keys, url).agg(F.min(order).alias("_o")).groupBy(*keys)
    urls = once.agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", url))), lambda x: x[url]).alias("urls"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return first.join(urls.withColumnsRenamed({k: f"_{k}" for k in keys}), same).drop(*(f"_{k}" for k in keys))


def merge_new(state: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The rows of ``new`` whose key the state lacks, the first of each key."""
    return keep_first(new.join(state.select(key).distinct(), key, "left_anti"), [key], [order])


def streaks(df: DataFrame, part: str, order: str, flag: Column) -> DataFrame:
    """(part, longest run of rows in order for which the flag holds).

    Rows are dealt by ranges of part and order, so that a part of any size is many tasks' work. Each task sums up what it has of a part: rows, the runs that
    begin and end it, and the longest; the sums of a part, one a task, are put together in their order.
    """
    kind = df.schema[part].dataType
    schema = StructType([StructField("part", kind), StructField("task", LongType()), *(StructField(n, LongType()) for n in ("n", "head", "tail", "most"))])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out: list[list] = []  # part, task, rows, run at the beginning, run at the end, longest
        for batch in batches:
            keys, on = batch.column(0), np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
            if not len(on):
                continue
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(on)]
            for a, b in zip(cuts, cuts[1:]):
                off = np.flatnonzero(~on[a:b])
                n = b - a
                edges = np.concatenate([[-1], off, [n]])
                new = [keys[a].as_py(), task, n, int(edges[1]), int(n - 1 - edges[-2]), int(np.diff(edges).max()) - 1]
                if out and out[-1][0] == new[0]:
                    old = out.pop()
                    new = [old[0], task, old[2] + n, old[2] + new[3] if old[3] == old[2] else old[3], n + old[4] if new[4] == n else new[4], max(old[5], new[5], old[4] + new[3])]
                out.append(new)
        types = [f.type for f in to_arrow_schema(schema)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=schema.names)

    rows = df.select(F.col(part), F.coalesce(flag, F.lit(False)).alias("_f"), order).repartitionByRange(part, order).sortWithinPartitions(part, order)
    parts = rows.select(part, "_f").mapInArrow(sums, schema).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("task", "n", "head", "tail", "most"))).alias("s"))
    zero = F.struct(F.lit(0).cast("long").alias("tail"), F.lit(0).cast("long").alias("most"))
    joined = F.aggregate("s", zero, lambda a, x: F.struct(F.when(x["tail"] == x["n"], a["tail"] + x["n"]).otherwise(x["tail"]).alias("tail"), F.greatest(a["most"], x["most"], a["tail"] + x["head"]).alias("most")))
    return parts.select(F.col("part").alias(part), joined["most"].alias("longest"))
