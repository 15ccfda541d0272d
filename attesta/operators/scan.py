"""Scans of ranked list pages and the detail pages behind them: which items, in which order, how far, and what is known of each.

Pages are rows, so that they can be fetched and read by any number of tasks; what a scan keeps of them is decided by their numbers afterwards. A scan that
is resumed has a cursor: the next page, the keys it is done with, and whether it came to the end.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import listings as L
from ..functions import text as T
from ..sources.payload import object_or_empty

#: Pages in a row that bring nothing new, after which a list is taken to repeat itself.
REPEATS = 3
DONE, PARTIAL = 0, 10
# Addresses of list pages; the third counts items, PAGE_ITEMS a page.
LIST_URLS = {
    "ZOL": "https://detail.zol.com.cn/notebook_index/subcate16_0_list_1_0_1_2_0_%d.html",
    "JD": "https://www.jd.com/hotitem/670a86a27721a2eeea8.html?extAttrValue=expand_name%%2C&electedExtAttrSet=&sort_type=sort_totalsales15_desc&page=%d",
    "PConline": "https://product.pconline.com.cn/notebook/%ss10.shtml",
}
PAGE_ITEMS = 25


class ScanError(RuntimeError):
    """A scan that found less than a scan must find."""


def item_key(product_id: Column, url: Column) -> Column:
    """What tells items apart: the product's number, else its address, else nothing."""
    return F.coalesce(T.empty_to_null(product_id.cast("string")), T.empty_to_null(url), F.lit(""))


def first_seen(cards: DataFrame, key: str, page: str, place: str) -> DataFrame:
    """The first card of each key by page and place; cards without a key are left out."""
    from .resolve import keep_first

    return keep_first(cards.where(F.col(key) != ""), [key], [page, place])


def scanned(pages: DataFrame, cards: DataFrame, key: str, most: int = 0, empty: str = "error", page: str = "page_no", place: str = "place") -> DataFrame:
    """The items of a one-shot scan, in list order. ``pages`` has the number of each page that was read, ``cards`` what they hold.

    A page without cards is an ``error``, or ends the scan (``prefix``: what came before counts, if there is any). ``most`` items are kept, by page and place.
    """
    counts = pages.select(page).distinct().join(cards.groupBy(page).agg(F.count(F.lit(1)).alias("n")), page, "left")
    first_empty = counts.where(F.coalesce("n", F.lit(0)) == 0).agg(F.min(page)).first()[0]
    if first_empty is not None:
        cards = cards.where(F.col(page) < first_empty)
        if empty == "error" or cards.isEmpty():
            raise ScanError(f"page {first_empty} has no cards")
    items = first_seen(cards, key, page, place).orderBy(page, place)
    return items.limit(most) if most else items


def new_by_page(cards: DataFrame, state: DataFrame | None, key: str, page: str, place: str) -> DataFrame:
    """(page, cards, added): how many cards each page has, and how many keys appear on it first."""
    fresh = first_seen(cards, key, page, place)
    if state is not None:
        fresh = fresh.join(state.select(key).distinct(), key, "left_anti")
    added = fresh.groupBy(page).agg(F.count(F.lit(1)).alias("added"))
    return cards.groupBy(page).agg(F.count(F.lit(1)).alias("cards")).join(added, page, "left").select(page, "cards", F.coalesce("added", F.lit(0)).alias("added"))


def last_page(counts: DataFrame, page: str = "page_no", repeats: int = REPEATS) -> int | None:
    """The page at which a scan ends: an empty one, or the last of ``repeats`` in a row without new keys; none if it goes on. ``counts``: page, cards, added."""
    empty = counts.where("cards = 0").agg(F.min(page)).first()[0]
    # The place in a run is told by the distance to the last page that brought something: pages are numbers without gaps.
    stale = counts.where("added = 0 AND cards > 0").select(F.col(page).alias("p"))
    run = stale
    for k in range(1, repeats):
        run = run.join(stale.select((F.col("p") + k).alias("p")), "p", "left_semi")
    ended = run.agg(F.min("p")).first()[0]
    return min((x for x in (empty, ended) if x is not None), default=None)


@dataclass
class Cursor:
    """Where a resumed scan stands."""

    current_page: int = 1
    scan_complete: bool = False
    processed_ids: list[str] = field(default_factory=list)
    total_items: int = 0


CURSOR = "current_page int, scan_complete boolean, processed_ids array<string>, total_items int"


def load_cursor(spark: SparkSession, path: str) -> Cursor:
    """The cursor that was saved; one that is missing or broken is a new one, and fields that are no such values are as in a new one."""
    try:
        rows = spark.read.text(path, wholetext=True).select(object_or_empty(F.col("value")).alias("v"))
        get = lambda n, kind: F.try_variant_get("v", f"$.{n}", kind).alias(n)
        r = rows.select(get("current_page", "int"), get("scan_complete", "boolean"), get("processed_ids", "array<string>"), get("total_items", "int")).first()
    except Exception as e:  # a path that is not there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        r = None
    return Cursor() if r is None else Cursor(r["current_page"] or 1, bool(r["scan_complete"]), list(r["processed_ids"] or []), r["total_items"] or 0)


def save_cursor(spark: SparkSession, cursor: Cursor, path: str) -> None:
    df = spark.createDataFrame([(cursor.current_page, cursor.scan_complete, cursor.processed_ids, cursor.total_items)], CURSOR)
    df.select(F.to_json(F.struct("*"))).coalesce(1).write.mode("overwrite").text(path)


def restarted(cursor: Cursor, restart: bool = True) -> Cursor:
    """The cursor to begin with: a complete scan starts over, where its source's list changes from day to day."""
    return Cursor() if cursor.scan_complete and restart else cursor


class Budget:
    """Seconds that a run may take; 0 is no limit."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic):
        self.clock = clock
        self.ends = clock() + float(seconds) if seconds and seconds > 0 else None

    def expired(self) -> bool:
        return self.ends is not None and self.clock() >= self.ends

    def remaining(self) -> float:
        return float("inf") if self.ends is None else max(0.0, self.ends - self.clock())


def advance(cursor: Cursor, items: DataFrame | None, cards: DataFrame, read: DataFrame, key: str, most: int = 0, page: str = "page_no", place: str = "place") -> tuple[Cursor, DataFrame]:
    """The cursor and the items after the pages of ``read`` (page_no) were read into ``cards``: items are appended by first appearance, up to ``most`` in all.

    The scan is complete if a page was empty, ``REPEATS`` in a row brought nothing new, or there are ``most`` items.
    """
    counts = read.select(page).distinct().join(new_by_page(cards, items, key, page, place), page, "left").fillna(0)
    end = last_page(counts, page)
    far = counts.agg(F.max(page)).first()[0]
    fresh = first_seen(cards if end is None else cards.where(F.col(page) <= end), key, page, place)
    had = 0
    if items is not None:
        had = items.count()
        fresh = fresh.join(items.select(key).distinct(), key, "left_anti")
    fresh = fresh.orderBy(page, place)
    fresh = fresh.limit(max(0, most - had)) if most else fresh
    out = fresh if items is None else items.unionByName(fresh, allowMissingColumns=True)
    n = had + fresh.count()
    complete = end is not None or bool(most and n >= most)
    last = far if end is None else end
    return Cursor(cursor.current_page if last is None else int(last) + 1, complete, list(cursor.processed_ids), n), out


def enriched_only(rows: DataFrame) -> DataFrame:
    """The rows that were fetched."""
    return rows.where(F.coalesce("fetched_at", F.lit("")) != "")


def run_status(cursor: Cursor, items: DataFrame, enriched: DataFrame, key: str) -> int:
    """0 if the scan came to the end and every item is enriched, else 10: the run goes on next time."""
    open_ = not items.select(key).join(enriched.select(key), key, "left_anti").isEmpty()
    return PARTIAL if open_ or not cursor.scan_complete else DONE


def processed(enriched: DataFrame, key: str) -> DataFrame:
    """(key) of what is done with: items whose details failed are tried again."""
    return enriched.where(F.coalesce("crawl_warning", F.lit("")) == "").select(key).distinct()


def list_url(source: str, page: Column) -> Column:
    """The address of a list page, counted from 1."""
    if source == "PConline":
        return F.format_string(LIST_URLS[source], F.when(page > 1, ((page - 1) * PAGE_ITEMS).cast("string")).otherwise(""))
    return F.format_string(LIST_URLS[source], page)


def product_id(url: Column) -> Column:
    return T.empty_to_null(F.regexp_extract(url, r"/notebook/index(\d+)\.shtml", 1)).cast("bigint")


def detail_url(id_: Column, base: str = "https://detail.zol.com.cn") -> Column:
    """A product's specification page, in the folder of its thousand, rounded up."""
    return F.when(id_.isNotNull(), F.format_string(f"{base}/%d/%d/param.shtml", F.floor((id_ + 999) / 1000).cast("bigint"), id_))


# The names that the sources' specification pages have for the same things.
_WEIGHT, _FORM = ("笔记本重量", "产品重量", "重量"), ("产品类型", "产品定位")
DETAILS = {
    "ZOL": {"cpu": ("CPU型号", "处理器型号"), "gpu": ("显卡芯片", "显卡型号"), "storage": ("硬盘容量", "存储容量"), "battery": ("电池容量", "电池类型"), "weight": _WEIGHT, "ports": ("数据接口", "视频接口", "音频接口", "其它接口"), "form": (*_FORM, "包装清单")},
    "JD": {"cpu": ("CPU型号", "处理器", "处理器型号"), "gpu": ("显卡型号", "显示芯片"), "storage": ("固态硬盘", "硬盘容量", "总容量"), "battery": ("电池容量", "电池能量"), "weight": ("产品净重", *_WEIGHT), "ports": ("接口", "USB", "雷电"), "form": (*_FORM, "商品类别", "类型")},
    "PConline": {"cpu": ("CPU型号", "处理器型号", "CPU"), "gpu": ("显卡芯片", "显卡型号"), "storage": ("硬盘容量", "存储容量"), "battery": ("电池容量", "电池类型"), "weight": _WEIGHT, "ports": ("接口",), "form": (*_FORM, "产品特点", "包装清单")},
}
KEYBOARD_WINDOW = r".{0,20}(?:数字小键盘|数字键区|背光键盘|键盘背光).{0,20}"


def detail_page(source: str, url: Column) -> Column:
    """The address of the page that has a listing's specifications; null where its own address tells none."""
    if source == "ZOL":
        return detail_url(product_id(url))
    return F.regexp_replace(url, r"(?<!_detail)\.html$", "_detail.html") if source == "PConline" else url


def with_details(items: DataFrame, pages: DataFrame, url: str = "spec_url", source: str = "ZOL") -> DataFrame:
    """``items`` with the specifications of their detail page and what kept them from having any. ``pages`` has url, specs (a map), error, and may have risk (a page that asks who is there) and page_text.

    An item whose page failed keeps what its title says, and a warning.
    """
    more = [c for c in ("risk", "page_text") if c in pages.columns]
    side = pages.select(F.col("url").alias(url), "specs", F.col("error").alias("_error"), F.lit(True).alias("_read"), *more).dropDuplicates([url])
    out = items.join(side, url, "left")
    warning = F.when(F.col(url).isNotNull() & (F.col("_read").isNull() | F.col("_error").isNotNull()), F.concat(F.lit("detail_failed:"), F.coalesce("_error", F.lit("missing"))))
    if "risk" in more:
        warning = warning.when(F.col("risk"), "detail_risk_verification")
    if source == "JD":
        warning = warning.when(F.coalesce(F.size("specs"), F.lit(0)) <= 0, "detail_specs_unavailable")
    return out.withColumn("crawl_warning", warning).drop("_error", "_read", "risk")


def assembled(items: DataFrame, source: str = "ZOL") -> DataFrame:
    """``items`` (title, specs, crawl_warning, and page_text of the second source) with all attributes: those of the specifications, or else of the title."""
    names, specs = DETAILS[source], F.col("specs")
    spec = lambda *n: L.from_spec(specs, *n)
    nonzero = lambda c: F.when(c != 0, c)
    within = lambda words, k: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(k, w))
    entries = lambda ok: F.map_entries(F.map_filter(specs, lambda k, _: ok(k)))
    joined = lambda ok, of: F.array_join(F.transform(entries(ok), of), "；")
    value, both = (lambda e: e["value"]), (lambda e: F.concat(e["key"], F.lit("：" if source == "PConline" else ": "), e["value"]))
    title = L.text_of(F.col("title"))
    if source == "ZOL":
        keys = spec("键盘描述", "键盘")
    elif source == "JD":  # some pages say it in their text alone
        seen = F.array_join(F.regexp_extract_all("page_text", F.lit(KEYBOARD_WINDOW), 0), " ") if "page_text" in items.columns else F.lit("")
        keys = F.coalesce(T.empty_to_null(joined(lambda k: F.contains(k, F.lit("键盘")), value)), seen, F.lit(""))
    else:
        keys = joined(lambda k: F.lit(True), both)
    df = items.withColumn("_t", L.title_fields(F.col("title"), loose=source == "JD", flags=source != "PConline")).withColumn("_cpu", F.coalesce(T.empty_to_null(spec(*names["cpu"])), title)).withColumn("_keys", keys)
    df = df.withColumn("_gpu", F.coalesce(T.empty_to_null(spec(*names["gpu"])), F.col("_t.gpu"))).withColumn("_gpu_type", spec("显卡类型"))
    flags, cpu = L.keyboard_flags(F.col("_keys")), L.cpu_fields(F.col("_cpu"))
    gpu = L.gpu_fields(F.col("_gpu_type"), F.coalesce(T.empty_to_null(F.col("_gpu")), title) if source == "JD" else F.col("_gpu"))
    is_port = lambda k: within(names["ports"], k)
    ports = F.transform(entries(is_port), both) if source == "JD" else F.filter(F.transform(F.split(joined(is_port, value), r"[；;]"), T.clean), lambda x: x != "")
    form = T.clean(joined(lambda k: k.isin(*names["form"]), value))
    form = F.coalesce(T.empty_to_null(form), T.clean(title)) if source == "JD" else form
    said = lambda flag: F.when(flag.isNotNull(), F.col("_keys")).otherwise("") if source == "PConline" else F.col("_keys")
    detail = F.struct(
        L.cpu_model(F.col("_cpu")).alias("cpu"), cpu["brand"].alias("cpu_brand"), cpu["family"].alias("cpu_family"), L.cpu_voltage(F.col("_cpu")).alias("cpu_voltage_type"),
        F.coalesce(flags["keypad"], F.col("_t.numeric_keypad")).alias("numeric_keypad"), F.coalesce(flags["backlight"], F.col("_t.keyboard_backlight")).alias("keyboard_backlight"),
        F.col("_gpu").alias("gpu"), gpu["type"].alias("gpu_type"), gpu["dedicated"].alias("dedicated_gpu"),
        F.coalesce(nonzero(T.first_number(spec("屏幕尺寸"))), F.col("_t.screen_size")).alias("screen_size"), T.empty_to_null(spec("屏幕分辨率", "分辨率")).alias("resolution"),
        nonzero(T.first_number(spec("屏幕刷新率", "刷新率"))).alias("refresh_rate"),
        F.coalesce(nonzero(T.capacity_gb(spec("内存容量"))).cast("int"), F.col("_t.memory_gb")).alias("memory_gb"), F.coalesce(nonzero(T.capacity_gb(spec(*names["storage"]))).cast("int"), F.col("_t.storage_gb")).alias("storage_gb"),
        T.amount_before(spec(*names["battery"]), "Wh|瓦时").alias("battery_wh"), F.coalesce(nonzero(T.first_number(spec(*names["weight"]))), F.col("_t.weight_kg")).alias("weight_kg"), ports.alias("ports"), form.alias("product_form"),
        F.create_map(F.lit("numeric_keypad"), said(flags["keypad"]), F.lit("keyboard_backlight"), said(flags["backlight"]), F.lit("cpu"), F.col("_cpu"), F.lit("gpu"), T.clean(F.concat_ws(" ", "_gpu_type", "_gpu")), F.lit("product_form"), form).alias("evidence"),
    )
    known = ["cpu", "cpu_brand", "cpu_family", "cpu_voltage_type", "numeric_keypad", "keyboard_backlight", "gpu", "gpu_type", "dedicated_gpu", "screen_size", "memory_gb", "storage_gb", "weight_kg"]
    more = ["resolution", "refresh_rate", "battery_wh", "ports", "product_form", "evidence"]
    df = df.withColumn("_d", F.when(F.col("specs").isNotNull() & F.col("crawl_warning").isNull(), detail))
    own = [c for c in items.columns if c not in [*known, *more, "page_text"]]
    return df.select(*own, *(F.when(F.col("_d").isNotNull(), F.col(f"_d.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in known), *(F.col(f"_d.{c}").alias(c) for c in more))
