"""Document fingerprints: a canonical exact digest, wide hash grouping, byte comparison inside equal buckets.

A text is decomposed (Unicode NFKD), case-folded, and its white space folded. Two independently seeded
64-bit hashes of the result make a 128-bit fingerprint. Buckets with equal hashes are compared byte by byte;
should one hold different texts, the second and later texts in byte order get the suffix ``-1``, ``-2``, ...

Everything runs as native expressions: decompositions are looked up by code point in constant arrays.

Defined results: a null text is the empty text; the empty text and a text of white space alone have the
same fingerprint; repeated rows have equal fingerprints; an empty table gives an empty table; columns
of the input other than the key and text are not read. Rows with the same id are separate documents, and the
"next" document of an id is the one with the smallest text among those of the next larger id.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bounded, hex64, materialise, table

#: Code points without a decomposition that a table may have between two with one.
GAP = 600
HANGUL, L0, V0, T0, V_COUNT, T_COUNT = 0xAC00, 0x1100, 0x1161, 0x11A7, 21, 28
OTHER_SPACE = r"\t-\r\x1c-\x1f\x85   "


def _strings(values: list[str]) -> Column:
    """A constant array, folded by the optimizer into one literal."""
    return F.split(F.lit("\x00".join(values)), "\x00")


@lru_cache(1)
def _decompositions() -> tuple[tuple[int, int, list[str]], ...]:
    """Tables (first, last, values) that cover every code point with a decomposition, but for Hangul syllables, which follow a rule."""
    runs: list[list[int]] = []
    for c in range(0x80, 0x110000):
        if not (0xD800 <= c < 0xE000 or HANGUL <= c < HANGUL + 11172) and unicodedata.normalize("NFKD", chr(c)) != chr(c):
            if runs and c - runs[-1][1] <= GAP:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return tuple((lo, hi, [unicodedata.normalize("NFKD", chr(c)) for c in range(lo, hi + 1)]) for lo, hi in runs)


@lru_cache(1)
def _reordered() -> tuple[str, list[str], list[str]]:
    """Marks with a combining class: a character class for all, and the marks and classes as parallel lists."""
    marks = [(chr(c), unicodedata.combining(chr(c))) for lo, hi in ((0x300, 0xD7FF), (0xF900, 0xFFFF), (0x10000, 0x1FFFF)) for c in range(lo, hi + 1) if unicodedata.combining(chr(c))]
    return "".join(m for m, _ in marks), [m for m, _ in marks], [f"{k:03d}" for _, k in marks]


def _decomposed_char(c: Column) -> Column:
    code = F.ascii(c)
    s = code - HANGUL
    jamo = lambda first, n: _strings([chr(first + i) for i in range(n)])
    out = F.when(code.between(HANGUL, HANGUL + 11171), F.concat(
        F.element_at(jamo(L0, 19), F.floor(s / (V_COUNT * T_COUNT)).cast("int") + 1),
        F.element_at(jamo(V0, V_COUNT), F.floor((s % (V_COUNT * T_COUNT)) / T_COUNT).cast("int") + 1),
        F.element_at(_strings(["", *(chr(T0 + i) for i in range(1, T_COUNT))]), (s % T_COUNT) + 1),
    ))
    for lo, hi, values in _decompositions():
        out = out.when(code.between(lo, hi), F.element_at(_strings(values), code - lo + 1))
    return out.otherwise(c)


def decomposed(text: Column) -> Column:
    """NFKD. ASCII texts pass through; others are taken apart into ASCII runs and single characters."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x00-\x7F]+|(?s:.)"), 0)
    once = F.array(F.array_join(F.transform(parts, lambda p: F.when(F.ascii(p) < 128, p).otherwise(_decomposed_char(p))), ""))
    cls, marks, classes = _reordered()
    key = lambda ch: F.element_at(_strings(classes), F.array_position(_strings(marks), ch).cast("int"))
    ordered = lambda run: F.array_join(F.transform(F.array_sort(F.transform(F.split(run, ""), lambda ch, i: F.struct(key(ch).alias("k"), i.alias("i"), ch.alias("c")))), lambda x: x["c"]), "")
    runs = lambda t: F.regexp_extract_all(t, F.lit(f"(?s)[{cls}]+|[^{cls}]+"), 0)
    sorted_runs = lambda t: F.array_join(F.transform(runs(t), lambda r: F.when(r.rlike(f"^[{cls}]{{2,}}$"), ordered(r)).otherwise(r)), "")
    apart = F.element_at(F.transform(once, lambda t: F.when(t.rlike(r"\p{M}{2}"), sorted_runs(t)).otherwise(t)), 1)  # in an array, so that it is evaluated once
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(apart)


def canonical(text: Column) -> Column:
    """The text that is hashed and compared: decomposed, case-folded (over upper case, so that sharp s and ss agree), white space folded, trimmed."""
    t = F.upper(decomposed(F.coalesce(text, F.lit(""))))
    t = F.regexp_replace(t, f"[{OTHER_SPACE}][ {OTHER_SPACE}]*| [ {OTHER_SPACE}]+", " ")
    return F.trim(F.lower(t))


def wide(canon: Column) -> list[Column]:
    """Two hashes of 64 bits with different seeds."""
    return [F.xxhash64(canon).alias("h1"), F.xxhash64(F.lit("wide"), canon).alias("h2")]


def digest(h1: Column, h2: Column) -> Column:
    return F.concat(hex64(h1), hex64(h2))


def repeated_buckets(hashed: DataFrame) -> DataFrame:
    """The (h1, h2) that more than one row has; written, and of a checked size for the joins that follow."""
    counts = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("h1", "h2")
    return materialise(counts, "fingerprint-buckets")


def colliding(canon: DataFrame) -> DataFrame:
    """Rows (h1, h2, canon, ordinal) of the buckets in which the bytes differ; ordinal 0 is the smallest text.

    ``canon`` has h1, h2, canon. A bucket of equal texts, however many, leaves each task as one row.
    """
    differ = canon.groupBy("h1", "h2").agg(F.min("canon").alias("lo"), F.max("canon").alias("hi")).where("lo < hi").select("h1", "h2")
    differ = materialise(differ, "fingerprint-differ")  # as a rule none: then no text moves again
    texts = canon.join(bounded(differ), ["h1", "h2"]).distinct()
    return texts.withColumn("ordinal", F.row_number().over(W.partitionBy("h1", "h2").orderBy("canon")) - 1)


def fingerprints(df: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """``df`` with a fingerprint column: 32 hex digits, equal if and only if the canonical texts are."""
    names = {c: f"in_{c}" for c in df.columns}
    hashed = df.withColumnsRenamed(names).withColumn("canon", canonical(F.col(f"in_{text}")))
    hashed = hashed.select("*", *wide(F.col("canon")))
    keys = repeated_buckets(hashed.select("h1", "h2"))
    split = materialise(colliding(hashed.select("h1", "h2", "canon").join(bounded(keys), ["h1", "h2"])), "fingerprint-collisions")
    out = hashed.withColumn("ordinal", F.lit(0)) if split.isEmpty() else hashed.join(split, ["h1", "h2", "canon"], "left")
    return out.select(*(F.col(v).alias(k) for k, v in names.items() if k != to), suffixed(F.col("h1"), F.col("h2"), F.col("ordinal")).alias(to))


def suffixed(h1: Column, h2: Column, ordinal: Column) -> Column:
    return F.concat(digest(h1, h2), F.when(ordinal > 0, F.concat(F.lit("-"), ordinal.cast("string"))).otherwise(""))


#: Bits of the id that each level of the search for the next id takes off; together 64.
LEVELS = (10, 12, 14, 14, 14)


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) for each distinct id; after the last comes the first.

    The ids of a block of 1,024 are put in order together, then the first ids of blocks in blocks of blocks, and so on:
    no window has more than 16,384 rows, whatever the ids are.
    """

    def succ(level: DataFrame, widths: tuple[int, ...]) -> DataFrame:
        """level: distinct (v, lo); gives (v, nxt): the lo of the next larger v."""
        if len(widths) == 1:
            w = W.orderBy("v").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
            return level.select("v", F.coalesce(F.lead("lo").over(W.orderBy("v")), F.first("lo").over(w)).alias("nxt"))
        parts = level.withColumn("up", F.shiftright("v", widths[0]))
        above = succ(parts.groupBy("up").agg(F.min("lo").alias("lo")).select(F.col("up").alias("v"), "lo"), widths[1:])
        led = parts.withColumn("near", F.lead("lo").over(W.partitionBy("up").orderBy("v")))
        return led.join(above.select(F.col("v").alias("up"), F.col("nxt").alias("far")), "up").select("v", F.coalesce("near", "far").alias("nxt"))

    distinct = ids.select(F.col("id").alias("v")).where("v IS NOT NULL").distinct()
    return succ(distinct.withColumn("lo", F.col("v")), LEVELS).select(F.col("v").alias("id"), F.col("nxt").alias("next_id"))


def edited(docs: DataFrame, links: DataFrame) -> DataFrame:
    """(id, text, edited): each text's last quarter is replaced by the beginning of the next document.

    ``docs`` has (id, text), ``links`` (id, next_id, need), need being the most code points that a row of the id replaces.
    Of a document, only what its predecessor needs is sent on.
    """
    nxt = docs.select(F.col("id").alias("next_id"), "text").join(links, "next_id").select("id", F.expr("substring(text, 1, need)").alias("head"))
    nxt = nxt.groupBy("id").agg(F.min("head").alias("head"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    return docs.join(nxt, "id").select("id", "text", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.substring("head", F.lit(1), quarter)).alias("edited"))


def _unused_id(docs: DataFrame) -> int | None:
    """An id for rows that have none, if there are any: one more than the largest; or, where that is the last of all, the next below it that no row has."""
    last, none = docs.agg(F.max("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    if not none:
        return None
    if last is None or last < 2**63 - 1:
        return 0 if last is None else last + 1
    while not docs.where(F.col("doc_id") == last).isEmpty():
        last -= 1
    return last


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The digest columns of the query: each document's fingerprint beside those of its edited text and the next document.

    Documents without a doc_id come after all others (before those of the largest possible id, if there are such), and the first follows them. Of rows with one doc_id, or none, the smallest head of a text,
    and the smallest fingerprint, stand for the next document.
    """
    stand_in = _unused_id(docs)
    docs = docs.select(F.coalesce("doc_id", F.lit(stand_in)).alias("id") if stand_in is not None else F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    needs = materialise(docs.groupBy("id").agg(F.floor(F.max(F.length("text")) / 4).cast("int").alias("need")), "fingerprint-needs")  # each level of next_ids reads it anew
    links = materialise(next_ids(needs).join(needs, "id"), "fingerprint-links")
    pairs = edited(docs, links)
    both = pairs.select("id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), canonical(F.col("text")).alias("a"), canonical(F.col("edited")).alias("b"))
    done = materialise(both.select("id", "n_chars", "edited_sha256", *(h.alias(f"a_{n}") for h, n in zip(wide(F.col("a")), ("h1", "h2"))), *(h.alias(f"b_{n}") for h, n in zip(wide(F.col("b")), ("h1", "h2")))), "fingerprint-digests")
    rows = done.select("id", F.col("a_h1").alias("h1"), F.col("a_h2").alias("h2")).unionAll(done.select("id", "b_h1", "b_h2"))
    keys = repeated_buckets(rows.select("h1", "h2"))
    # Only documents with a repeated digest are read again to compare their bytes.
    again = materialise(rows.join(bounded(keys), ["h1", "h2"], "left_semi").select("id").distinct(), "fingerprint-again")
    wanted = links.join(bounded(again), "id", "left_semi")
    known = materialise(wanted.select("id").unionAll(wanted.select(F.col("next_id"))).distinct(), "fingerprint-known")
    pairs = edited(docs.join(bounded(known), "id", "left_semi"), wanted)
    canon = pairs.select(F.explode(F.array("text", "edited")).alias("text")).select(canonical(F.col("text")).alias("canon"))
    split = materialise(colliding(canon.select("canon", *wide(F.col("canon"))).join(bounded(keys), ["h1", "h2"], "left_semi")), "fingerprint-collisions")
    if split.isEmpty():
        done = done.withColumns({"a_ord": F.lit(0), "b_ord": F.lit(0)})
    else:
        texts = pairs.select("id", canonical(F.col("text")).alias("a"), canonical(F.col("edited")).alias("b"))
        texts = texts.select("id", *(h.alias(f"a_{n}") for h, n in zip(wide(F.col("a")), ("h1", "h2"))), *(h.alias(f"b_{n}") for h, n in zip(wide(F.col("b")), ("h1", "h2"))), "a", "b").distinct()
        for k in "ab":
            texts = texts.join(split.withColumnsRenamed({"h1": f"{k}_h1", "h2": f"{k}_h2", "canon": k, "ordinal": f"{k}_ord"}), [f"{k}_h1", f"{k}_h2", k], "left")
        keys4 = ["id", "a_h1", "a_h2", "b_h1", "b_h2"]
        done = done.join(texts.select(*keys4, "a_ord", "b_ord"), keys4, "left")
    done = done.select("id", "n_chars", "edited_sha256", suffixed(F.col("a_h1"), F.col("a_h2"), F.col("a_ord")).alias("fingerprint"), suffixed(F.col("b_h1"), F.col("b_h2"), F.col("b_ord")).alias("edited_fingerprint"))
    heads = done.groupBy("id").agg(F.min("fingerprint").alias("next_fingerprint")).withColumnRenamed("id", "next_id")
    out = done.join(links.select("id", "next_id"), "id").join(heads, "next_id")
    like = lambda a, b: F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0)
    return out.select((F.when(F.col("id") != stand_in, F.col("id")) if stand_in is not None else F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", like("fingerprint", "edited_fingerprint").alias("near_edited"), like("fingerprint", "next_fingerprint").alias("near_next"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op2_document_fingerprints": op2}
ORACLE_SQL: dict[str, str] = {}
