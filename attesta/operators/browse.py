"""Filter, sort and group specifications compiled to column expressions, so that Catalyst pushes them to the scan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T
from .postings import BOUND, Postings
from .staging import staged


def compile_filters(spec: dict[str, Any]) -> list[Column]:
    """Predicates of a specification.

    search: (columns, text); equals: {column: value}; least / most: {column: number}, where a missing number counts as 0;
    is_true / not_true: [column], where only true is true; among: {column: values}.
    """
    out: list[Column] = []
    if "search" in spec:
        columns, text = spec["search"]
        joined = F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
        out.append(joined.contains(text.strip().lower()))
    out += [F.col(c) == v for c, v in spec.get("equals", {}).items()]
    out += [F.coalesce(F.col(c), F.lit(0)) >= v for c, v in spec.get("least", {}).items()]
    out += [F.coalesce(F.col(c), F.lit(0)) <= v for c, v in spec.get("most", {}).items()]
    out += [F.col(c).eqNullSafe(F.lit(True)) for c in spec.get("is_true", ())]
    out += [~F.col(c).eqNullSafe(F.lit(True)) for c in spec.get("not_true", ())]
    out += [F.col(c).isin(*v) for c, v in spec.get("among", {}).items()]
    out += [~F.col(c).eqNullSafe(F.lit(v)) for c, v in spec.get("differs", {}).items()]
    return out


def forced(config: dict[str, Any]) -> dict[str, Any]:
    """The specification of a configuration's forced rules: ``value`` (true or another), ``allowed_values`` or ``not_equals`` by field."""
    out: dict[str, Any] = {}
    for name, rule in config.get("forced", {}).items():
        column = rule.get("field", name)
        if "allowed_values" in rule:
            out.setdefault("among", {})[column] = rule["allowed_values"]
        elif "not_equals" in rule:
            out.setdefault("differs", {})[column] = rule["not_equals"]
        elif rule.get("value") is True:
            out.setdefault("is_true", []).append(column)
        else:
            out.setdefault("equals", {})[column] = rule.get("value")
    return out


#: Sort modes: (column, descending, what a missing value counts as); most fall back on the rank.
LAST = 2**53 - 1
_RANK = ("source_rank", False, LAST)
SORTS = {
    "source_rank": [("source_count", True, 0), _RANK], "source_count": [("source_count", True, 0), _RANK], "price_asc": [("price", False, LAST)], "price_desc": [("price", True, -1)],
    "screen_desc": [("screen_size", True, 0), _RANK], "refresh_desc": [("refresh_rate", True, 0), _RANK], "memory_desc": [("memory_gb", True, 0), _RANK], "storage_desc": [("storage_gb", True, 0), _RANK],
    "numpad_first": [("numeric_keypad", True, 0), _RANK], "backlight_first": [("keyboard_backlight", True, 0), _RANK],
}


def sorted_by(df: DataFrame, mode: str, tie: str) -> DataFrame:
    """``df`` in the order of a mode; an unknown mode is that of the rank. Texts that begin with a number count as it, flags as 1 and 0."""
    value = lambda c: F.regexp_extract(F.col(c).cast("string"), r"^\s*([+-]?\d*\.?\d+)", 1).try_cast("double") if df.schema[c].dataType.simpleString() == "string" else F.col(c).cast("double")
    keys = [(lambda x, d=down: x.desc() if d else x.asc())(F.coalesce(value(c), F.lit(float(v)))) for c, down, v in SORTS.get(mode, SORTS["source_rank"])]
    return df.orderBy(*keys, tie)


def facet(df: DataFrame, column: str) -> DataFrame:
    """(value) of the different values of a column, in the order of Chinese dictionaries."""
    return df.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col(column).alias("value")).distinct().orderBy(F.collate("value", "zh"), "value")


def presented(df: DataFrame) -> DataFrame:
    """Listings as a table or card shows them: link, texts with units, price, tags and badges."""
    links = F.coalesce(T.empty_to_null(F.col("source_url")), F.get(F.map_values(F.map_filter("source_urls", lambda _, v: v != "")), F.lit(0)), F.lit("#"))
    title = F.coalesce(T.empty_to_null(F.col("title")), F.col("model"))
    dedicated = F.coalesce(F.col("dedicated_gpu"), F.lit(False))
    tags = F.array(F.when(F.col("cpu_voltage_type") == "desktop_performance", "桌面级 CPU · 形态已核验").otherwise("H 系"), F.when(dedicated, "独显").otherwise("集显"), F.lit("数字键盘"), F.lit("背光"))
    show = lambda c, unit="": T.display(F.col(c), unit)
    return df.select(
        links.alias("link"), title.alias("title"), F.coalesce(T.empty_to_null(F.col("brand")), F.lit("品牌待确认")).alias("brand"), (F.coalesce("source_count", F.lit(0)) >= 2).alias("multi"), tags.alias("tags"),
        show("cpu").alias("cpu"), show("gpu").alias("gpu"), show("screen_size", "″").alias("screen"), F.concat_ws(" · ", show("resolution"), show("refresh_rate", "Hz")).alias("display"),
        show("memory_gb", "GB").alias("memory"), show("storage_gb", "GB SSD").alias("storage"), T.money(F.col("price")).alias("price"), F.coalesce("atomic_source_names", F.array().cast("array<string>")).alias("badges"), show("source_rank").alias("rank"),
    )


def pills(config: dict[str, Any], allowed: str = "H / HX / HS / HK；桌面级 CPU 仅限形态证据例外") -> list[str]:
    """What the forced rules of a configuration are called."""
    said = lambda r: "是" if r.get("value") is True else allowed if r.get("allowed_values") else r.get("value")
    return [f"{r.get('label')} · {said(r)}" for r in config.get("forced", {}).values()]


def active_filters(spec: dict[str, Any]) -> int:
    return sum(len(v) if isinstance(v, (dict, list)) else 1 for v in spec.values())


def browse(df: DataFrame, spec: dict[str, Any], order: list[tuple[str, bool, Any]] = (), tie: str | None = None, limit: int | None = None, index: Postings | None = None) -> DataFrame:
    """The rows that pass, in order: (column, descending, what a missing value counts as). With an index of the columns searched, only what it finds is looked at."""
    if index is not None and "search" in spec:
        df = index.containing(spec["search"][1])
    for p in compile_filters(spec):
        df = df.where(p)
    keys = [(lambda c: c.desc() if down else c.asc())(F.coalesce(F.col(c), F.lit(v))) for c, down, v in order]
    if keys:
        df = df.orderBy(*keys, *([tie] if tie else []))
    return df if limit is None else df.limit(limit)


def short_identity(title: Column, most: int = 18, least: int = 4) -> Column:
    """A title up to its first parenthesis; longer ones are cut at the last space within ``most`` characters, if beyond ``least``."""
    head = F.trim(F.regexp_extract(title, r"^([^(（]*)", 1))
    cut = F.length(F.regexp_extract(F.substring(head, 1, most), r"^(.*) [^ ]*$", 1))
    return F.when(F.length(head) <= most, head).when(cut > least, F.regexp_extract(F.substring(head, 1, most), r"^(.*) [^ ]*$", 1)).otherwise(F.substring(head, 1, most))


#: Marks at which a long title may be cut.
CUTS = (" ", "·", "-", "【")


def product_line(model: Column, title: Column, brand: Column, most: int = 18, least: int = 4) -> Column:
    """struct(key, name, brand) of the line that listings are shown under: the model up to its first parenthesis; a longer one without any is cut at the last mark
    within ``most`` characters, if that is beyond ``least``."""
    whole = F.coalesce(T.empty_to_null(model), title, F.lit(""))

    def named(t: Column) -> Column:
        head = F.substring(t, 1, most)
        last = lambda mark: F.when(F.contains(head, F.lit(mark)), most - F.instr(F.reverse(F.rpad(head, most, "\0")), mark)).otherwise(-1)
        at = F.greatest(*map(last, CUTS))
        return F.when(at > least, F.trim(F.substr(head, F.lit(1), at))).otherwise(F.trim(head))

    base = T.let(whole, lambda t: T.let(F.trim(F.split(t, r"[（(]", 2)[0]), lambda b: F.when((b == t) & (F.length(b) > most), named(b)).otherwise(b)))
    of = F.trim(F.coalesce(brand, F.lit("")))
    return F.struct(F.concat(F.lit("spu|"), of, F.lit("|"), F.regexp_replace(base, r"\s+", "")).alias("key"), F.coalesce(T.empty_to_null(base), whole).alias("name"), of.alias("brand"))


#: What a listing's filters ask of it.
_EQUAL = {"cpuBrand": "cpu_brand", "gpuType": "gpu_type", "brand": "brand"}
_LEAST = {"screenMin": "screen_size", "refreshMin": "refresh_rate", "memoryMin": "memory_gb", "storageMin": "storage_gb", "batteryMin": "battery_wh", "priceMin": "price"}
_ONLY = {"numpadOnly": "numeric_keypad", "backlightOnly": "keyboard_backlight"}


def listing_spec(filters: dict[str, Any]) -> dict[str, Any]:
    """The specification of a listing's filters by their names; those that are empty or off ask nothing."""
    on = {k: v for k, v in filters.items() if v not in (None, "", False)}
    out: dict[str, Any] = {}
    if str(on.get("search", "")).strip():
        out["search"] = (["title", "model", "cpu", "gpu", "brand"], str(on["search"]))
    out["equals"] = {c: on[k] for k, c in _EQUAL.items() if k in on}
    out["least"] = {c: on[k] for k, c in _LEAST.items() if k in on} | ({"source_count": 2} if "multiOnly" in on else {})
    out["most"] = {"price": on["priceMax"]} if "priceMax" in on else {}
    out["is_true"] = [c for k, c in _ONLY.items() if k in on]
    out["not_true"] = ["dedicated_gpu"] if "hideDedicated" in on else []
    return {k: v for k, v in out.items() if v}


def _counted(small: DataFrame) -> DataFrame:
    """A table of groups, written and counted, to be broadcast if it is small: joined by sorting, all rows of a group would be one task's."""
    laid = staged(small, "groups")
    return F.broadcast(laid) if laid.count() <= BOUND else laid


def numbered(df: DataFrame, groups: list[str], orders: list[str]) -> DataFrame:
    """``df`` with the place of each row in its group, from 1, in the order of ``orders``.

    Rows are dealt by ranges of group and order, ties of the first orders by the later ones, and numbered where they lie; to that is added
    how many of the group lie in the ranges before. So a group of any size is the work of as many tasks as it has ranges.
    """
    ranges = df.repartitionByRange(*groups, *orders).sortWithinPartitions(*groups, *orders)
    # The number of a row in its task, and the task's: bounds of ranges are drawn anew in each run, so they are written down once.
    laid = staged(ranges.withColumn("_id", F.monotonically_increasing_id()), "numbered").withColumns({"_task": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    parts = laid.groupBy(*groups, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*groups).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    side = parts.select(*(F.col(g).alias(f"_g_{g}") for g in groups), F.col("_task").alias("_t"), (before - F.col("_first") + 1).alias("_add"))
    same = F.col("_task") == F.col("_t")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return laid.join(_counted(side), same).withColumn("place", F.col("_at") + F.col("_add")).select(*df.columns, "place")


def grouped(df: DataFrame, group: str, rank: str, order: str) -> DataFrame:
    """Rows with their place in their group (unranked last) and the group's first appearance."""
    out = numbered(df.withColumn("_r", F.coalesce(F.nullif(F.col(rank), F.lit(0)), F.lit(9999))), [group], ["_r", order])
    first = df.groupBy(F.col(group).alias("_g")).agg(F.min(order).alias("group_ord"))
    return out.join(_counted(first), F.col(group).eqNullSafe(F.col("_g"))).select(*df.columns, F.col("place").cast("int").alias("place"), "group_ord")
