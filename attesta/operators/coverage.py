"""How well sources cover the same things: single-source rows, where else they occur, and why they were not joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import listings as L
from ..functions.text import casefolded, clean, compatible, empty_to_null, number

# Names of sources, words that name none, and the fields of the three domains.
NAMES = {
    "ah": "汽车之家", "dcd": "懂车帝", "yc": "易车", "zol": "中关村在线", "pconline": "太平洋电脑网", "cnmo": "CNMO", "jd": "JD", "taobao": "淘宝", "pdd": "拼多多",
}
NO_SOURCE = ("-", "--", "unknown", "未知", "none", "null")
SOURCE_FIELDS = ("atomic_source_names", "source", "数据来源", "来源")
SERIES_IDS = ("车系ID", "车款ID", "易车车型ID", "车型ID", "spec_id", "specId")
SERIES_SOURCES = {"DCD": ("懂车帝", "DCD"), "AH": ("汽车之家", "AH"), "YC": ("易车", "YC")}
RAW_SOURCES = ("ZOL", "JD", "PConline")


class CoverageError(ValueError):
    """Rows that cannot be judged: without an identity or a source."""


def folded(c: Column) -> Column:
    """A part of an identity: compatible form, single blanks, case folded; missing is empty."""
    return F.coalesce(casefolded(c.cast("string")), F.lit(""))


def tokens(c: Column, names: dict[str, str] = NAMES) -> Column:
    """The different sources of a list, in order: words that say "only" and words for none go, known names become canonical."""
    bare = lambda x: F.trim(F.regexp_replace(F.trim(x), r"^(?:仅|单源\s*[:：]?)", ""))
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    name = lambda x: F.coalesce(F.try_element_at(known, F.lower(clean(compatible(x)))), clean(x))
    kept = F.filter(F.transform(c, bare), lambda x: (x != "") & ~F.lower(clean(compatible(x))).isin(*NO_SOURCE))
    return F.array_distinct(F.transform(kept, name))


def split_sources(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), r"[,，+、|/]")


def sources_of(df: DataFrame, fields: tuple[str, ...] = SOURCE_FIELDS) -> DataFrame:
    """``df`` with ``sources``, the tokens of all source fields in order, and ``source_field``, the first field that has any; both are null where none has."""
    of = {f: tokens(F.col(f) if df.schema[f].dataType.simpleString() == "array<string>" else split_sources(F.col(f).cast("string"))) for f in fields if f in df.columns}
    of = {f: F.coalesce(c, F.array().cast("array<string>")) for f, c in of.items()}
    if not of:
        raise CoverageError("no field names a source")
    both = F.array_distinct(F.concat(*of.values()))
    return df.withColumn("sources", F.when(F.size(both) > 0, both)).withColumn("source_field", F.coalesce(*(F.when(F.size(c) > 0, F.lit(f)) for f, c in of.items())))


def identity(df: DataFrame, kind: str) -> Column:
    """The identity of a row of ``cars``, ``phones`` or ``laptops``; null where it has none."""
    has = lambda c: c in df.columns
    raw = lambda *names: F.coalesce(*(empty_to_null(F.col(n).cast("string")) for n in names if has(n)), F.lit(None).cast("string"))
    joined = lambda *parts: F.concat_ws("|", *(empty_to_null(folded(p)) for p in parts))
    told = lambda p: folded(p) != ""
    if kind == "cars":
        number_ = F.coalesce(*(empty_to_null(folded(F.col(n))) for n in SERIES_IDS if has(n)), F.lit(None).cast("string"))
        model, year = raw("车型名称", "车型"), raw("年款")
        parts = F.when(number_.isNotNull(), joined(F.concat(F.lit("id:"), number_), model, year)).otherwise(joined(raw("品牌"), raw("车系"), model, year))
        return F.when(told(model) & told(year), parts)
    if kind == "phones":
        model = raw("型号", "name")
        return F.when(told(model), joined(raw("品牌"), model, raw("内存"), raw("存储")))
    if kind != "laptops":
        raise CoverageError(f"unknown kind: {kind}")
    brand, model = raw("brand"), raw("model", "title")
    built = F.when(told(brand) & told(model), joined(brand, model, raw("cpu", "cpu_model")))
    if not has("identity_key"):
        return built
    given = folded(F.col("identity_key"))
    return F.when(F.col("identity_key").isNull(), built).when(given.rlike(r"^[0-9a-f]{24,64}$"), F.concat(F.lit("identity:"), given))


def judged(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with identity, sources and source_field; a row without identity or source is an error."""
    out = sources_of(rows.withColumn("identity", identity(rows, kind)))
    bad = out.agg(F.count_if(F.col("identity").isNull()), F.count_if(F.col("sources").isNull())).first()
    if any(bad):
        raise CoverageError(f"{bad[0]} rows have no identity, {bad[1]} no source")
    return out


def gaps(rows: DataFrame) -> DataFrame:
    """(identity, sources, rows, cause) of identities with single-source rows, out of (identity, sources): of one source only, or with other sources that were not joined."""
    parts = rows.groupBy("identity", F.array_sort("sources").alias("s")).agg(F.count(F.lit(1)).alias("n"))  # few sets of sources for any number of rows
    per = parts.groupBy("identity").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("sources"), F.sum("n").alias("all"), F.coalesce(F.sum(F.when(F.size("s") == 1, F.col("n"))), F.lit(0)).alias("single"))
    one = F.size("sources") <= 1
    return per.select("identity", "sources", F.when(one, F.col("all")).otherwise(F.col("single")).alias("rows"), F.when(one, "identity_only_single").otherwise("cross_source_merge_gap").alias("cause")).where("rows > 0")


def analysis(rows: DataFrame, kind: str, order: str, show: int = 30, sample: int = 8) -> dict:
    """The report on a payload: counts, rates, sources, causes, the largest single-source identities, and first rows. Every figure is an aggregate over all rows."""
    x = judged(rows, kind)
    n, single, multi = x.agg(F.count(F.lit(1)), F.count_if(F.size("sources") == 1), F.count_if(F.size("sources") >= 2)).first()
    if not n:
        raise CoverageError("the payload has no rows")
    count = lambda df, by: df.groupBy(by.alias("k")).agg(F.count(F.lit(1)).alias("rows"))
    found = gaps(x)
    of = lambda df: {r["k"]: r["rows"] for r in df.collect()}
    pairs = F.array_join(F.array_sort("sources"), "+")
    causes = {r["cause"]: r["n"] for r in found.groupBy("cause").agg(F.sum("rows").alias("n")).collect()}
    return {
        "kind": kind, "total": n, "single_count": single, "multi_count": multi, "single_rate": round(single * 100 / n, 2), "multi_rate": round(multi * 100 / n, 2),
        "source_fields": of(count(x, F.col("source_field"))), "source_distribution": of(count(x, pairs).orderBy(F.desc("rows"), "k").limit(show)),
        "available_sources": sorted(r[0] for r in x.select(F.explode("sources")).distinct().collect()), "causes": {c: causes.get(c, 0) for c in ("identity_only_single", "cross_source_merge_gap")},
        "top_single": [r.asDict() for r in found.orderBy(F.desc("rows"), "identity").limit(show).collect()],
        "sample": [r.asDict() for r in x.orderBy(order).select(F.col(order).alias("index"), "identity", F.array_sort("sources").alias("sources"), "source_field").limit(sample).collect()],
    }


def by_series(rows: DataFrame, series: str, number_: str, source: str, names: dict[str, tuple[str, ...]] = SERIES_SOURCES) -> DataFrame:
    """(series, id, sources, rows, single_rows): the sources whose names a series' rows contain, how many rows it has, and how many name one source."""
    said = F.coalesce(F.col(source), F.lit(""))
    has = {s: F.max(F.greatest(*(said.contains(w) for w in words)) if len(words) > 1 else said.contains(words[0])) for s, words in names.items()}
    one = F.count_if((said == "") | (L.source_count(said) <= 1))
    out = rows.groupBy(F.coalesce(F.col(series), F.lit("")).alias("series"), F.coalesce(F.col(number_).cast("string"), F.lit("")).alias("id")).agg(*(c.alias(f"_{s}") for s, c in has.items()), F.count(F.lit(1)).alias("rows"), one.alias("single_rows"))
    return out.select("series", "id", F.filter(F.array(*(F.when(F.col(f"_{s}"), F.lit(s)) for s in names)), lambda x: x.isNotNull()).alias("sources"), "rows", "single_rows")


def series_totals(found: DataFrame) -> DataFrame:
    one = F.size("sources") <= 1
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return found.agg(total(F.when(one, F.col("rows")), "single_series_rows"), total(F.when(~one, F.col("single_rows")), "multi_series_single_rows"), F.count(F.lit(1)).alias("total_series"), F.count_if(one).alias("single_source_series"), F.count_if(~one).alias("multi_source_series"))


def source_set(names: Column, joined: Column, category: Column, known: tuple[str, ...] = RAW_SOURCES) -> Column:
    """A row's sources; where it has none, the known ones whose names its source or else its category contains."""
    listed, said = L.atomic_sources(names, joined), F.coalesce(empty_to_null(joined), category, F.lit(""))
    return F.when(F.size(listed) > 0, listed).otherwise(F.filter(F.array(*map(F.lit, known)), lambda s: F.contains(said, s)))


def title_spec(title: Column) -> Column:
    """struct(memory, storage) in gigabytes of a figure such as 16GB/1TB; nulls without one."""
    part = lambda k: empty_to_null(F.regexp_extract(title, r"(\d+)GB/(\d+)(TB|GB)", k))
    return F.struct(part(1).cast("double").alias("memory"), (part(2).cast("double") * F.when(part(3) == "TB", 1024).otherwise(1)).alias("storage"))


def configuration(memory: Column, storage: Column, title: Column) -> Column:
    """struct(memory, storage): the fields, or what the title says where one is missing."""
    told = title_spec(title)
    return F.struct(F.coalesce(number(memory), told["memory"]).alias("memory"), F.coalesce(number(storage), told["storage"]).alias("storage"))


def same_configuration(a: Column, b: Column) -> tuple[Column, Column]:
    """compatible, incompatible or unknown, and why: a difference decides; without one both figures of both sides must be known."""
    text = lambda c: c.cast("string")
    differ = F.filter(F.array(*(F.when(a[n] != b[n], F.concat(F.lit(f"{n} "), text(a[n]), F.lit("GB vs "), text(b[n]), F.lit("GB"))) for n in ("memory", "storage"))), lambda x: x.isNotNull())
    known = a["memory"].isNotNull() & b["memory"].isNotNull() & a["storage"].isNotNull() & b["storage"].isNotNull()
    kind = F.when(F.size(differ) > 0, "incompatible").when(known, "compatible").otherwise("unknown")
    return kind, F.when(F.size(differ) > 0, F.array_join(differ, "; ")).when(known, "memory/storage consistent").otherwise("insufficient config fields to confirm")


def indexed(raw: DataFrame, key: str, source: str, order: str) -> DataFrame:
    """(key, source, first) of rows whose key can be built: the first row of each source."""
    return raw.where(F.col(key).isNotNull()).groupBy(key, source).agg(F.min(order).alias("first"))


def elsewhere(single: DataFrame, raw: DataFrame, key: str, sources: str, source: str) -> DataFrame:
    """``single`` with ``status`` and ``matched_sources``: the other sources whose raw rows have the same key, in order; rows without a key are unparseable."""
    keys = raw.where(F.col(key).isNotNull()).select(key, F.col(source).alias("_s")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("_s")).alias("_all"))
    out = single.join(keys, key, "left")
    matched = F.filter(F.coalesce("_all", F.array().cast("array<string>")), lambda s: ~F.array_contains(F.col(sources), s))
    status = F.when(F.col(key).isNull(), "unparseable_identity").when(F.size(matched) > 0, "match_found").otherwise("no_match")
    return out.withColumn("matched_sources", matched).withColumn("status", status).drop("_all")


def gain(candidates: DataFrame, total: int) -> DataFrame:
    """(status, rows, gain): rows by status, and the rate in per cent that joining all matches would add."""
    share = F.when((F.col("status") == "match_found") & F.lit(total > 0), F.bround(F.col("rows") / F.lit(max(total, 1)) * 100, 2)).otherwise(0.0)
    return candidates.groupBy("status").agg(F.count(F.lit(1)).alias("rows")).withColumn("gain", share)


def single_by_source(single: DataFrame, sources: str) -> DataFrame:
    return single.select(F.explode(sources).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
