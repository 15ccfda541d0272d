"""Whole listings: merged field by field, completed by facts, gated, and published under an audit.

A group is any number of records of one identity. Every step is an aggregate that is combined within tasks first, so that a group of a third of
all records leaves each task as one row; maps are folded by (identity, source) or (identity, field) before they are built.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import listings as L
from ..functions.text import let, quality
from .protect import PublishGuardError, require_rows
from .resolve import fact_for
from .staging import staged

#: A listing; other columns are merged by quality as well.
LISTING = """title string, model string, model_identity string, brand string, cpu string, cpu_voltage_type string, price double, product_form string,
  source_category string, numeric_keypad boolean, keyboard_backlight boolean, source string, atomic_source_names array<string>, source_url string,
  source_rank int, source_urls map<string,string>, source_ranks map<string,int>, evidence map<string,string>, fetched_at string"""
#: Columns that have a rule of their own.
RULED = ("source", "atomic_source_names", "source_url", "source_urls", "source_rank", "source_ranks", "numeric_keypad", "keyboard_backlight", "evidence", "source_count", "identity_key")
REQUIREMENTS = {"numeric_keypad": True, "keyboard_backlight": True, "cpu_voltage_types": ["standard_performance", "high_performance", "desktop_performance"], "desktop_cpu_exception": "portable_product_form_evidence_required"}


def completed(df: DataFrame) -> DataFrame:
    """``df`` with the columns of LISTING that it lacks, as nulls."""
    for f in T._parse_datatype_string(LISTING).fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def key_of(df: DataFrame, sources: Column | None = None) -> Column:
    """The identity, always derived anew: keys that came with a record are evidence of its source alone."""
    of = lambda s: L.listing_key(F.col("brand"), F.col("model"), F.col("title"), F.col("cpu"), s, F.col("model_identity"))
    return of(sources) if sources is not None else let(L.atomic_sources(F.col("atomic_source_names"), F.col("source")), of)


#: What an identity is derived from.
TEXTS, SOURCES = ("brand", "model", "title", "cpu", "model_identity"), ("atomic_source_names", "source")


def _least(value: Column, kind: T.DataType, *by: Column) -> Column:
    """The struct of ``by`` and the value ``v`` that comes first; maps have no order themselves."""
    packed = F.struct(*by, value.alias("v"))
    return F.min_by(packed, F.struct(*by)) if "map<" in kind.simpleString() else F.min(packed)


def _quality(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    by = "boolean" if isinstance(kind, T.BooleanType) else "number" if isinstance(kind, T.NumericType) else "array" if isinstance(kind, T.ArrayType) else "string"
    return quality(F.col(name) if by in ("array", "boolean", "number") or isinstance(kind, T.StringType) else F.to_json(F.col(name)), by)


def voltage_of() -> Column:
    return L.voltage(F.col("cpu_voltage_type"), F.col("cpu"), F.try_element_at("evidence", F.lit("cpu")))


def reasons_of() -> Column:
    """Why a listing is not published; empty if it is."""
    portable = L.portable_form(F.col("source_category"), F.col("title"), F.col("model"), F.col("product_form"), F.col("evidence"))
    return L.admission_reasons(F.col("numeric_keypad"), F.col("keyboard_backlight"), F.col("cpu_voltage_type"), portable)


def merge_records(records: DataFrame, order: str, facts: DataFrame | None = None) -> DataFrame:
    """One listing for each identity, with ``identity_key``, ``rejection_reasons`` and ``publish_eligible``.

    The record of most sources, then of most fields, then the first in ``order`` is the base; each field is that of the highest quality, the base's
    of equals, then the next one's. Flags are false if one is; sources and ranks are united; a source's address is the first in order, those a record already
    maps before its own; evidence is that of the last. ``facts`` fill flags that no source gives.
    """
    df = completed(records)
    names = [c for c in df.columns if c not in RULED and c != order]
    varied = [c for c in names if c in records.columns and c not in TEXTS]  # within the records of one input
    kind = {f.name: f.dataType for f in df.schema.fields}
    fields = sum((F.col(c).isNotNull().cast("int") for c in records.columns if c != order), F.lit(0))
    if df.rdd.getNumPartitions() < (cores := df.sparkSession.sparkContext.defaultParallelism):  # a few large splits
        df = df.repartition(cores)
    df = df.withColumn("_in", F.struct(*TEXTS, *SOURCES)).withColumns({"_h": F.xxhash64("_in"), "_f": -fields, "_o": F.col(order)})
    q = lambda c: (-_quality(df, c)).alias("q")
    said_url = F.coalesce(F.col("source_url"), F.lit("")) != ""

    # Records of one input are folded first: they are many, and have one identity, which is dear to derive, and the same sources.
    best = (_least(F.col(c), kind[c], q(c), F.col("_f").alias("f"), F.col("_o").alias("o")).alias(c) for c in varied)
    flags = [F.bool_and(c).alias(c) for c in ("numeric_keypad", "keyboard_backlight")]
    own = (F.min(F.struct("_f", "_o")).alias("_ord"), F.min(F.when(said_url, F.struct(F.col("_o").alias("o"), F.col("source_url").alias("url")))).alias("_url"), F.min(F.col("source_rank").cast("int")).alias("_rank"))
    folded = df.groupBy("_h", "_in").agg(*best, *flags, *own, F.count(F.lit(1)).alias("records"))
    folded = folded.select("*", *(F.col(f"_in.{c}") for c in TEXTS), L.atomic_sources(F.col("_in.atomic_source_names"), F.col("_in.source")).alias("_sources"))
    keyed = staged(folded.withColumn("_key", key_of(folded, F.col("_sources"))), "keyed-records")  # read by each of the folds

    s = (-F.size("_sources")).alias("s")
    best = {c: _least(F.col(f"{c}.v"), kind[c], F.col(f"{c}.q"), s, F.col(f"{c}.f"), F.col(f"{c}.o")) for c in varied}
    best |= {c: _least(F.col(c), kind[c], q(c), s, F.col("_ord._f"), F.col("_ord._o")) for c in names if c in TEXTS and c in records.columns}
    merged = keyed.groupBy("_key").agg(*(v.alias(c) for c, v in best.items()), *flags, F.sum("records").alias("records"))
    merged = merged.select("_key", *(F.col(f"{c}.v").alias(c) if c in best else F.lit(None).cast(kind[c]).alias(c) for c in names), "numeric_keypad", "keyboard_backlight", "records")

    def given(column: str, place: str) -> Column:
        """A record's map as (source, url, rank, i) with canonical names, in its order."""
        at = {"url": F.lit(None).cast("string"), "rank": F.lit(None).cast("int")}
        entry = lambda e, i: F.struct(L.source_name(e["key"]).alias("source"), *((e["value"].cast(k) if n == place else at[n]).alias(n) for n, k in (("url", "string"), ("rank", "int"))), i.alias("i"))
        return F.when(F.size(column) > 0, F.transform(F.map_entries(column), entry)).otherwise(F.array().cast("array<struct<source:string,url:string,rank:int,i:int>>"))

    def of_key(rows: DataFrame) -> DataFrame:
        return rows.join(keyed.select("_h", "_in", "_key"), ["_h", "_in"]).drop("_h", "_in")

    # Of a source: the first address as (record, place in it, url); the record's own stands behind those that it maps.
    own = F.transform("_sources", lambda x, i: F.struct(x.alias("source"), F.when(F.col("_url").isNotNull(), F.struct(F.col("_url.o").alias("o"), (i + 1_000_000).alias("i"), F.col("_url.url").alias("url"))).alias("at"), F.col("_rank").alias("rank"), F.lit(True).alias("own")))
    per = keyed.select("_key", F.inline(own))
    maps = [(c, n) for c, n in (("source_urls", "url"), ("source_ranks", "rank")) if c in records.columns]
    if maps:
        more = df.select("_h", "_in", "_o", F.inline(F.concat(*(given(c, n) for c, n in maps))))
        at = F.min(F.when(F.coalesce(F.col("url"), F.lit("")) != "", F.struct(F.col("_o").alias("o"), "i", "url"))).alias("at")
        more = of_key(more.groupBy("_h", "_in", "source").agg(at, F.min("rank").alias("rank")))
        per = per.unionByName(more.withColumn("own", F.lit(False)))
    sources = per.groupBy("_key", "source").agg(F.min("at")["url"].alias("url"), F.min("rank").alias("rank"), F.bool_or("own").alias("own"))
    of = lambda value: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("source", value)))))
    sources = sources.groupBy("_key").agg(F.array_sort(F.collect_list(F.when(F.col("own"), F.col("source")))).alias("atomic_source_names"), of("url").alias("source_urls"), of("rank").alias("source_ranks"), F.min("rank").alias("source_rank"))
    out, evidence = merged.join(sources, "_key", "left"), F.create_map().cast("map<string,string>")
    if "evidence" in records.columns:
        last = F.max(F.struct(F.col("_o").alias("o"), "value")).alias("last")
        said = of_key(df.select("_h", "_in", "_o", F.explode("evidence").alias("field", "value")).groupBy("_h", "_in", "field").agg(last)).groupBy("_key", "field").agg(F.max("last")["value"].alias("value"))
        said = said.groupBy("_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("evidence"))
        out, evidence = out.join(said, "_key", "left"), F.coalesce("evidence", evidence)
    names = F.coalesce("atomic_source_names", F.array().cast("array<string>"))
    new = {"evidence": evidence, "atomic_source_names": names, "source": F.array_join(names, "+"), "source_count": F.size(names), "brand": L.brand(F.col("brand"), F.col("title")), "cpu": L.cpu_model(F.col("cpu"))}
    out = out.select(*(c for c in out.columns if c not in new and c != "_key"), *(v.alias(k) for k, v in new.items()))
    out = out.withColumn("cpu_voltage_type", voltage_of()).withColumn("identity_key", key_of(out))
    out = staged(out, "merged-listings")
    out = apply_facts(out, facts) if facts is not None else out
    reasons = reasons_of()
    return out.select("*", reasons.alias("rejection_reasons")).withColumn("publish_eligible", F.size("rejection_reasons") == 0)


def _apart_from(*names: str):
    return lambda k, _: ~k.isin(*names)


def apply_facts(listings: DataFrame, facts: DataFrame) -> DataFrame:
    """Unknown flags from the fact of the listing's series and size, each with a note of the fact's text and page in the evidence, and the fact's source in ``fact_sources``."""
    found = fact_for(listings.select("identity_key", "title").dropDuplicates(["identity_key"]), facts, "identity_key", F.col("title"))
    out = listings.join(found, "identity_key", "left")
    evidence, changed = F.col("evidence"), F.lit(False)
    for flag in ("numeric_keypad", "keyboard_backlight"):
        used = F.col(flag).isNull() & F.col(f"fact.{flag}").isNotNull()
        note = F.create_map(F.lit(f"{flag}_fact"), F.coalesce("fact.keyboard_text", F.lit("")), F.lit(f"{flag}_fact_url"), F.coalesce("fact.page_url", F.lit("")))
        others = F.map_filter(evidence, _apart_from(f"{flag}_fact", f"{flag}_fact_url"))
        evidence, changed = F.when(used, F.map_concat(others, note)).otherwise(evidence), changed | used
    flags = {flag: F.coalesce(flag, F.col(f"fact.{flag}")) for flag in ("numeric_keypad", "keyboard_backlight")}
    return out.withColumns({"evidence": evidence, "fact_sources": F.when(changed, F.array(F.coalesce("fact.source", F.lit("official")))), **flags}).drop("fact")


def split_rejected(merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listings to publish, and for the others what they are and why not."""
    rejected = merged.where(~F.col("publish_eligible")).select("identity_key", "title", "atomic_source_names", F.col("rejection_reasons").alias("reasons"))
    return merged.where("publish_eligible").drop("rejection_reasons"), rejected


def payload_sources(items: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """(source): all sources that a payload declares or its items have, without UNKNOWN. ``declared``: (source)."""
    found = items.select(F.explode(L.atomic_sources(F.col("atomic_source_names"), F.col("source"))).alias("source"))
    if declared is not None:
        found = found.unionAll(declared.where(F.trim("source") != "").select(L.source_name(F.col("source"))))
    return found.where("source <> 'UNKNOWN'").distinct()


def missing_identities(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """(identity_key) of what the baseline may publish and the candidate lacks; both are derived anew, so that a new way to make keys does not look like a loss."""
    old = completed(baseline).withColumn("cpu_voltage_type", voltage_of()).where(F.size(reasons_of()) == 0)
    keys = lambda df: df.select(key_of(df).alias("identity_key")).where("identity_key IS NOT NULL").distinct()
    return keys(old).join(keys(completed(candidate)), "identity_key", "left_anti")


def audit_payload(items: DataFrame, count: int | None = None, baseline: DataFrame | None = None, order: str = "identity_key") -> DataFrame:
    """(check_ord, row_ord, error): everything that keeps a payload from being published, check by check and row by row; no row if nothing does."""
    df = completed(items)
    df = df.withColumn("cpu_voltage_type", voltage_of())
    missing = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    key = F.coalesce(F.col("identity_key"), F.lit("None"))
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing("identity_key")).alias("blank"))
    total = F.when(~F.col("n").eqNullSafe(F.lit(count).cast("long")), F.concat(F.lit(f"count mismatch: metadata={count} actual="), F.col("n").cast("string")))
    blank = F.when(F.col("blank") > 0, F.lit("every item must have identity_key"))
    whole = sums.select(F.explode(F.array(F.struct(F.lit(0).alias("check_ord"), total.alias("error")), F.struct(F.lit(1).alias("check_ord"), blank.alias("error")))).alias("e")).select("e.check_ord", F.lit("").alias("row_ord"), "e.error")
    twice = df.groupBy("identity_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit(2), F.lit(""), F.lit("duplicate identity_key values"))
    reasons, sources = reasons_of(), L.atomic_sources(F.col("atomic_source_names"), F.col("source"))
    found = F.array(
        F.when(F.size(reasons) > 0, F.concat(F.lit("ineligible item "), key, F.lit(": "), F.array_join(reasons, ","))),
        F.when(F.size(sources) == 0, F.concat(F.lit("item "), key, F.lit(" has no atomic source"))),
        F.when(~F.col("source_count").eqNullSafe(F.size(sources)), F.concat(F.lit("item "), key, F.lit(" source_count mismatch"))) if "source_count" in df.columns else F.concat(F.lit("item "), key, F.lit(" source_count mismatch")),
    )
    rows = df.select(F.col(order).cast("string").alias("row_ord"), F.posexplode(found).alias("i", "error")).select((F.col("i") + 3).alias("check_ord"), "row_ord", "error")
    out = whole.unionAll(twice).unionAll(rows)
    if baseline is not None:
        lost = payload_sources(completed(baseline)).join(payload_sources(df), "source", "left_anti").agg(F.array_join(F.array_sort(F.collect_list("source")), ",").alias("s")).where("s <> ''")
        out = out.unionAll(lost.select(F.lit(6), F.lit(""), F.concat(F.lit("source regression: missing "), F.col("s"))))
    return out.where("error IS NOT NULL")


def preserve(candidate: DataFrame, baseline: DataFrame | None, order: str, facts: DataFrame | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Candidate and those listings of the baseline that may be published, merged anew, and how many of each went in and were kept by the baseline alone."""
    placed = lambda df, side: completed(df).withColumn("_o", F.struct(F.lit(side).alias("side"), F.col(order).cast("string").alias("o")))
    both, n = placed(candidate, 0), 0
    if baseline is not None:
        old = completed(baseline).withColumn("cpu_voltage_type", voltage_of()).where(F.size(reasons_of()) == 0)
        n = old.count()
        both = both.unionByName(placed(old, 1), allowMissingColumns=True)
    known = {f.name for f in T._parse_datatype_string(LISTING).fields}
    drop = [c for c in (order, "source_count", "publish_eligible", "rejection_reasons", "records", "fact_sources", "identity_key") if c in both.columns and c not in known]
    merged = merge_records(both.drop(*drop), "_o", facts)
    kept = merged.where("publish_eligible").select("identity_key").distinct().join(completed(candidate).transform(lambda x: x.select(key_of(x).alias("identity_key"))), "identity_key", "left_anti").count()
    return merged, {"candidate_count": candidate.count(), "baseline_count": n, "preserved_count": kept}


def _write(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def _lines(df: DataFrame, path: str) -> None:
    _write(df.select(F.to_json(F.struct("*")).alias("value")), path)


def publish(merged: DataFrame, folder: str, generated_at: str, baseline: DataFrame | None = None, least: int = 0, schema_version: int = 1, config: str | None = None) -> DataFrame:
    """Writes items, rejected, manifest, envelope and, if given, the configuration (JSON) under ``folder`` and returns the manifest; a payload that fails the audit, or of fewer than ``least`` items, is refused before anything is written.

    Items are JSON lines in publication order of any number of files; the envelope names them, and holds count, sources and requirements.
    """
    merged = merged.persist()  # read by each count, check and file
    try:
        out = _publish(merged, folder, generated_at, baseline, least, schema_version)
        if config is not None:
            spark = merged.sparkSession
            _write(spark.createDataFrame([(json.dumps(json.loads(config), ensure_ascii=False, separators=(",", ":")),)], "value string").coalesce(1), f"{folder}/filter_conditions")
        return out
    finally:
        merged.unpersist()


def _publish(merged: DataFrame, folder: str, generated_at: str, baseline: DataFrame | None, least: int, schema_version: int) -> DataFrame:
    items, rejected = split_rejected(merged)
    if least:
        require_rows(items, least, "the publication")
    n = items.count()
    if wrong := [r["error"] for r in audit_payload(items, n, baseline).orderBy("check_ord", "row_ord").limit(20).collect()]:
        raise PublishGuardError("; ".join(wrong))
    spark = merged.sparkSession
    in_order = items.orderBy(F.desc("source_count"), F.coalesce(F.col("source_rank"), F.lit(10**9)), F.coalesce("title", F.lit("")))
    _lines(in_order, f"{folder}/items")
    _lines(rejected, f"{folder}/rejected")
    counts = items.select(F.explode("atomic_source_names").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    by_source = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "rows"))))
    head = counts.agg(by_source.alias("sourceCounts")).select(F.lit(schema_version).alias("schemaVersion"), F.lit(generated_at).alias("updatedAt"), F.lit(n).alias("rowCount"), "sourceCounts")
    _lines(head.coalesce(1), f"{folder}/manifest")
    pipeline = json.dumps({"rejected_count": rejected.count(), "requirements": REQUIREMENTS})
    envelope = head.select(F.to_json(F.struct(F.lit(schema_version).alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.lit(n).alias("count"), F.map_keys("sourceCounts").alias("sources"), F.lit("items").alias("items"))).alias("e"))
    last = envelope.select(F.concat(F.expr("substring(e, 1, length(e) - 1)"), F.lit(f', "pipeline": {pipeline}}}')).alias("value")).coalesce(1)
    _write(last, f"{folder}/payload")
    return spark.read.json(f"{folder}/manifest")
