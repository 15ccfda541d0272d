"""Facts out of product pages, and JSON out of free text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .listings import fact_flags, series, size_of_model
from .text import clean

# Endings of category pages.
CATEGORIES = ("laptops", "desktops", "monitors", "printers", "tablets", "accessories", "promotions", "scanners", "keyboards", "mice", "docks", "webcams", "speakers", "cases-sleeves", "batteries-chargers-adapters")
CELL = r"(?is)<dd[^>]*data-th=[\"']键盘[\"'][^>]*>(.*?)</dd>"
NEAR_WORD = r"键盘[^<]{0,10}<[^>]*>([^<]{2,80})<"
WINDOW = r"[^<>]{0,30}(?:键盘|键盘特性|keycap)[^<>]{0,50}"
WINDOWS, LINE, LONG_LINE, MODEL = 6, 200, 300, 80


def product_links(html: Column, pattern: str) -> Column:
    """The different links that the pattern's group finds, in order, whose last part has a digit and is no category page."""
    last = lambda x: F.element_at(F.split(x, "/"), -1)
    ok = lambda x: last(x).rlike("[0-9]") & ~last(x).rlike(rf"-(?:{'|'.join(CATEGORIES)})\.html$")
    return F.array_distinct(F.filter(F.regexp_extract_all(html, F.lit(pattern), 1), ok))


def keyboard_cells(html: Column) -> Column:
    """What the keyboard cells of a page say, or else what follows the word; joined."""
    cells = F.transform(F.regexp_extract_all(html, F.lit(CELL), 1), lambda x: clean(F.regexp_replace(x, "<[^>]+>", "")))
    near = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(html, F.lit(NEAR_WORD), 1), clean), lambda x: x != ""))
    return F.array_join(F.when(F.size(cells) > 0, cells).otherwise(near), "；")


def keyboard_windows(html: Column) -> Column:
    """The first different passages around the word, joined."""
    found = F.filter(F.transform(F.regexp_extract_all(html, F.lit(WINDOW), 0), clean), lambda x: x != "")
    return F.substring(F.array_join(F.slice(F.array_distinct(found), 1, WINDOWS), "；"), 1, LONG_LINE)


def facts(pages: DataFrame, url: str, html: str, line: Column, source: str, cut: str) -> DataFrame:
    """One fact a page that says anything on keypad or backlight; the model is the page's title up to the first match of ``cut``."""
    title = clean(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1))
    model = F.substring(clean(F.split(title, cut, 2)[0]), 1, MODEL)
    rows = pages.select(F.col(url).alias("page_url"), model.alias("model"), line.alias("_line"))
    rows = rows.select("page_url", "model", "_line", fact_flags(F.col("_line")).alias("f")).where("f.keypad IS NOT NULL OR f.backlight IS NOT NULL")
    return rows.select("model", series(F.col("model")).alias("series"), size_of_model(F.col("model")).alias("size_inch"), "page_url", F.substring("_line", 1, LONG_LINE if source.startswith("windows") else LINE).alias("keyboard_text"), F.lit(source).alias("source"), F.col("f.keypad").alias("numeric_keypad"), F.col("f.backlight").alias("keyboard_backlight"))


def unfenced(text: Column) -> Column:
    """A text without the code fence around it."""
    return F.regexp_replace(F.trim(text), r"(?s)^```[A-Za-z]*\s*\n?|\s*```$", "")


def balanced_object(text: Column) -> Column:
    """The first JSON object in a text, by its braces outside strings; null if there is none. Not a regular language, so it is an Arrow-batched function."""

    def first(t: str | None) -> str | None:
        start = (t or "").find("{")
        depth, quoted, skip = 0, False, False
        for i in range(start, len(t or "")) if start >= 0 else ():
            c = t[i]
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    return t[start : i + 1]
        return None

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(first)

    return run(text)


def token(text: Column, most: int = 160) -> Column:
    """A text as a file name's part: other characters than letters, digits, dots and hyphens become underscores; cut."""
    return F.substring(F.regexp_replace(text, r"[^A-Za-z0-9._\-]+", "_"), 1, most)


def clamped(requested: Column, elapsed: Column, window_left: Column, total: int = 21_600, buffer: int = 900, least: int = 300) -> Column:
    """The seconds a step may run: as asked, but within the job and the window; null (skip) if fewer than ``least`` are left."""
    safe = F.least(F.lit(total) - elapsed - buffer, window_left)
    return F.when(safe >= least, F.when((requested <= 0) | (safe < requested), safe).otherwise(requested))
