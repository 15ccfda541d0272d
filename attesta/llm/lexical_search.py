"""Ranked lexical search: each item's best documents, as a blocked sparse matrix product.

One scan turns each batch of documents into a block of the term-document matrix, restricted to the items' terms, and stored by term:
the terms that the block holds, how many of its documents hold each, those documents, and how often. The row lengths give the
document frequencies, with the documents' and terms' counts the weights and the documents' norms. A second job reads the blocks: a
block's rows become 64-bit impacts, and the rows of an item's terms, times their multiplicity and weight, are added into one
accumulator a document (Gustavson's row merging). The best of each item are taken by block, by task, and over all.

Items are the query side. They are worked on in blocks of at most ``ITEM_BYTES`` of text, chosen by hash, so that what a worker holds of
them (a table of terms, the multiplicities) has a bound; all documents are met by each block. Nothing grows with the corpus in the driver:
it gets three sums and the document frequencies of one block's terms.

Terms are maximal runs of ASCII letters, digits and of all characters beyond ASCII; only A to Z are lower-cased.

Defined results: a null text has no terms; documents and items without terms are not found and find nothing, and do not count for N.
Rows with one id are documents, or items, of their own. A document without doc_id is ranked after equals that have one. An empty table on either side
gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, small_batches, table

TOP = 10
#: Bytes of the texts of items in a block.
ITEM_BYTES = 16_000_000
#: Occurrences of items' terms, or documents, after which a block of documents ends (its last document ends it, whatever its length).
POSTINGS = 24_000
DOCUMENTS = 4096

#: Everything that is no term becomes a blank, capitals become small letters.
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


BLOCKS = "terms array<int>, held_by array<int>, docs binary, freqs binary, ids array<long>, lengths binary, n_docs long, n_terms long"


class Items:
    """A block of items: the numbers of their terms, and each item's terms with multiplicity."""

    def __init__(self, rows: list[tuple[int | None, bytes | None]]):
        self.ids = [i for i, _ in rows]
        self.number: dict[bytes, int] = {}
        self.rows = []
        for _, text in rows:
            of = Counter(terms(text or b""))
            self.rows.append([(self.number.setdefault(t, len(self.number)), n) for t, n in of.items()])


def _block(ids: list, lengths: list[int], at: list[np.ndarray], number: list[np.ndarray]) -> dict:
    """Documents as rows of the matrix by term. at, number: for each occurrence of an item's term the document's place and the term."""
    n = len(ids)
    key, count = np.unique(np.concatenate(number).astype(np.int64) * n + np.concatenate(at), return_counts=True)
    found, held_by = np.unique(key // n, return_counts=True)
    return {"terms": found, "held_by": held_by, "docs": (key % n).astype("<i4").tobytes(), "freqs": count.astype("<i8").tobytes(), "ids": ids, "lengths": np.array(lengths, dtype="<i8").tobytes(),
            "n_docs": sum(x > 0 for x in lengths), "n_terms": sum(lengths)}


def _as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({f.name: pa.array([r[f.name] for r in rows], f.type) for f in schema}, schema=schema)


SCHEMA = pa.schema([("terms", pa.list_(pa.int32())), ("held_by", pa.list_(pa.int32())), ("docs", pa.binary()), ("freqs", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("task", pa.int64())])


def term_blocks(docs: DataFrame, items) -> DataFrame:
    """Blocks of the term-document matrix over the terms of ``items``, a broadcast ``Items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = items.value.number.get
        ids, lengths, at, number, postings = [], [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(text or b"")
                known = np.array([k for k in map(get, words) if k is not None], dtype=np.int32)
                at.append(np.full(len(known), len(ids), dtype=np.int64))
                number.append(known)
                ids.append(doc)
                lengths.append(len(words))
                postings += len(known)
                if postings >= POSTINGS or len(ids) >= DOCUMENTS:
                    yield _as_batch([_block(ids, lengths, at, number)], SCHEMA)
                    ids, lengths, at, number, postings = [], [], [], [], 0
        if ids:
            yield _as_batch([_block(ids, lengths, at, number)], SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCKS)


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 75 + (75 * length * N) div L, in Python's integers where 64 bits might not do."""
    if len(lengths) and int(lengths.max()) * 75 * n_docs < 2**63:
        return 25 + (75 * lengths * n_docs) // n_terms
    return np.array([25 + 75 * n * n_docs // n_terms for n in lengths.tolist()], dtype=np.int64)


def _best(found: list[tuple], top: int) -> list[tuple]:
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]


def products(blocks: DataFrame, items, weights, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score, task): of each task, each item's best documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        w, rows = weights.value, items.value.rows
        place = np.full(len(w), -1, dtype=np.int64)
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for b in batch.to_pylist():
                m = norms(np.frombuffer(b["lengths"], "<i8"), n_docs, n_terms)
                docs, freqs = np.frombuffer(b["docs"], "<i4"), np.frombuffer(b["freqs"], "<i8")
                impacts = (1_000_000_000 * freqs) // (1000 * freqs + 8 * m[docs])
                found = np.array(b["terms"], dtype=np.int64)
                impacts *= np.repeat(w[found], b["held_by"])
                ends = np.concatenate([[0], np.cumsum(b["held_by"], dtype=np.int64)]).tolist()
                place[found] = np.arange(len(found))
                ids = b["ids"]
                for i, row in enumerate(rows):
                    total = np.zeros(len(ids), dtype=np.int64)
                    for t, n in row:
                        if (k := place[t]) >= 0:
                            r = slice(ends[k], ends[k + 1])
                            total[docs[r]] += n * impacts[r]  # a document is in a row once
                    some = np.flatnonzero(total)
                    if len(some) > top:  # with all that equal the last
                        some = some[total[some] >= np.partition(total[some], len(some) - top)[len(some) - top]]
                    if len(some):
                        best[i] = _best([*best.get(i, ()), *((int(total[k]), ids[k]) for k in some.tolist())], top)
                place[found] = -1
        task = TaskContext.get().partitionId()
        out = [(i, doc, score, task) for i, of in best.items() for score, doc in of]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(FOUND.types)], schema=FOUND)

    return blocks.select("terms", "held_by", "docs", "freqs", "ids", "lengths").mapInArrow(run, "item int, doc_id long, score long, task long")


def _reduced(found: DataFrame, top: int) -> DataFrame:
    """Each item's best: of a thousandth of the tasks each, then of all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    few = found.withColumn("r", F.row_number().over(Window.partitionBy("item", F.col("task") % 1000).orderBy(*order))).where(F.col("r") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def ranked(docs: DataFrame, queries: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``top`` documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    queries = queries.select("item_id", F.col("text").cast("string").alias("text"))
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, out = -(-max(1, size) // item_bytes), None
    for part in range(parts):
        own = queries.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)) == part) if parts > 1 else queries
        rows = [(r["item_id"], (r["text"] or "").encode()) for r in own.collect()]
        block = Items(rows)
        items = spark.sparkContext.broadcast(block)
        blocks = materialise(term_blocks(docs, items), "term-blocks")
        n_docs, n_terms = (x or 0 for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        held = blocks.select(F.explode(F.arrays_zip("terms", "held_by")).alias("t")).groupBy("t.terms").agg(F.sum("t.held_by").alias("df")).collect()
        w = np.zeros(len(block.number), dtype=np.int64)
        for r in held:
            w[r["terms"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        found = _reduced(products(blocks, items, spark.sparkContext.broadcast(w), n_docs, n_terms, top), top)
        names = spark.createDataFrame([(k, i) for k, i in enumerate(block.ids)], f"item int, item_id {queries.schema['item_id'].dataType.simpleString()}")
        here = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = here if out is None else out.unionByName(here)
    return out


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op13_lexical_search": op13}
ORACLE_SQL = {"op13_lexical_search": r"""
WITH terms AS (SELECT 0 AS kind, doc_id AS id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM documents
  UNION ALL SELECT 1, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
t AS (SELECT kind, id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS f FROM terms GROUP BY ALL),
lengths AS (SELECT id, sum(f)::BIGINT AS n FROM t WHERE kind = 0 GROUP BY id),
totals AS (SELECT count(*) AS N, sum(n)::BIGINT AS L FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(totals.N) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, totals WHERE kind = 0 GROUP BY term),
norms AS (SELECT id, 100 - 75 + (75 * lengths.n * totals.N) // totals.L AS m FROM lengths, totals),
scores AS (SELECT q.id AS item_id, d.id AS doc_id, sum(q.f * w * ((1000000000 * d.f) // (1000 * d.f + 8 * m)))::BIGINT AS score
  FROM t q JOIN t d ON q.term = d.term AND q.kind = 1 AND d.kind = 0 JOIN weights ON weights.term = q.term JOIN norms ON norms.id = d.id GROUP BY ALL),
ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranks WHERE rank <= 10
"""}
