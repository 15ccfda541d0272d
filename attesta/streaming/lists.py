"""Ranked list pages as a stream: ``spark.readStream.format("attesta_list_pages")``, and the rules by which a scan of them stops.

An offset says of each source how many of its pages were taken, so that the checkpoint is the cursor: a scan that stopped after some
pages goes on behind them. A partition is some pages of a source that follow each other; pages may lie one by one, or many in a file (a
block). What the pages hold never leaves the executors; the keys that a source has shown are state of the stream, and so is each source's
streak of pages that bring nothing new.

``scan`` runs one batch up to the pages asked for; ``goal`` says how far the next one goes: no further in sources that have ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING
from urllib.parse import quote
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.http import fetch

if TYPE_CHECKING:
    import pandas as pd

PAGES = "source string, page_no int, status int, body string"
#: What a scan writes: items (with their key), a row for each page that was judged (its number of new keys as place), the end of a source (its reason as key), pages that failed and that can be tried again.
EVENTS = "source string, page_no int, kind string, place int, key string"
#: Pages in a row without a new key after which a source has ended.
REPEATS = 3
#: Statuses of pages that are not there: beyond the last.
GONE = (404, 410)
#: So many pages of a list lie in a block where its address has ``{block}``: lines of a page's number, a tab and its body.
IN_BLOCK = 1000
#: Pages that lie one by one are read by about so many tasks at most.
TASKS = 2000
#: A source's keys are kept as so many sets, each read and written whole: a call for each key costs far more than the key.
SETS = 4096
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_address(address: str, timeout: float = 25) -> tuple[int | None, str | None]:
    """(status, text) of a page: over HTTP, or from a file, or the files of a folder, of any store that Arrow reads."""
    if address.startswith(("http://", "https://")):
        return fetch(address, timeout)[:2]
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(quote(address, safe=":/=%"))
    kind = store.get_file_info(path).type
    if kind == fs.FileType.NotFound:
        return 404, None
    names = [path] if kind == fs.FileType.File else sorted(x.path for x in store.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")))
    return 200, "".join(store.open_input_stream(n).read().decode() for n in names)


def _runs(first: int, last: int, size: int) -> Iterator[tuple[int, int]]:
    """The pages from ``first`` to ``last``, cut at multiples of ``size``."""
    while first <= last:
        end = min(last, first // size * size + size - 1)
        yield first, end
        first = end + 1


class _PageStream(DataSourceStreamReader):
    def __init__(self, options):
        self.addresses, self.upto = json.loads(options["addresses"]), json.loads(options["upto"])

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.addresses, 0)

    def latestOffset(self) -> dict:
        return {s: int(self.upto.get(s, 0)) for s in self.addresses}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        each = max(1, sum(max(0, end[s] - start.get(s, 0)) for s in end) // TASKS)
        return [InputPartition((s, *run)) for s in end for run in _runs(start.get(s, 0) + 1, end[s], IN_BLOCK if "{block}" in self.addresses[s] else each)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        source, first, last = partition.value
        address = self.addresses[source]
        if "{block}" not in address:
            for page in range(first, last + 1):
                yield (source, page, *read_address(address.format(page=page)))
            return
        status, text = read_address(address.format(block=first // IN_BLOCK))
        bodies = dict(line.split("\t", 1) for line in (text or "").split("\n") if line)
        for page in range(first, last + 1):
            body = bodies.get(str(page))
            yield (source, page, 404 if status == 200 and body is None else status, body)

    def commit(self, end: dict) -> None:
        """The checkpoint has it; sources keep nothing for their readers."""


class ListPages(DataSource):
    """Options: ``addresses``, a JSON object of each source's address with ``{page}`` or ``{block}``; ``upto``, one of the pages that each may be read to, counted from 1."""

    @classmethod
    def name(cls):
        return "attesta_list_pages"

    def schema(self):
        return PAGES

    def streamReader(self, schema):
        return _PageStream(self.options)


class StopRule(StatefulProcessor):
    """Judges the pages of a source in their order.

    Keys that the source has not shown are items. A page without keys, or that is not there, ends the source, and so do ``repeats`` pages in a row without a new key; what comes
    after is not looked at. A page that failed is neither: it waits, and is given out again when the retry window of ``wait`` milliseconds is over.
    """

    def __init__(self, repeats: int = REPEATS, wait: int = 60_000):
        self.repeats, self.wait = repeats, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "stale int, ended boolean")
        self.shown = handle.getMapState("sets", "set int", "keys array<string>")
        self.waiting = handle.getMapState("waiting", "page_no int", "status int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import pandas as pd

        source, out = key[0], []
        stale, ended = self.at.get() if self.at.exists() else (0, False)
        sets: dict[int, set[str]] = {}
        changed: set[int] = set()
        pages = sorted(((int(r.page_no), r.status, r.keys) for part in rows for r in part.itertuples()), key=lambda x: x[0])
        for page, status, keys in pages:
            if ended:
                break
            if status != 200 and status not in GONE:
                if not any(True for _ in self.waiting.keys()):
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
                self.waiting.updateValue((page,), (int(status),))
                out.append((source, page, "failed", None, str(status) if status else None))
                continue
            added = 0
            for place, k in enumerate(keys if keys is not None else ()):
                if not k:
                    continue
                if (n := crc32(k.encode("utf-8", "surrogatepass")) % SETS) not in sets:
                    sets[n] = set(self.shown.getValue((n,))[0]) if self.shown.containsKey((n,)) else set()
                if k not in sets[n]:
                    sets[n].add(k)
                    changed.add(n)
                    out.append((source, page, "item", place, k))
                    added += 1
            stale = 0 if added else stale + 1
            out.append((source, page, "page", added, None))
            reason = "empty" if keys is None or not len(keys) else "repeats" if stale >= self.repeats else None
            if reason:
                ended = True
                out.append((source, page, "end", None, reason))
        for n in changed:
            self.shown.updateValue((n,), (list(sets[n]),))
        self.at.update((stale, ended))
        yield pd.DataFrame(out, columns=["source", "page_no", "kind", "place", "key"]).astype({"page_no": "Int32", "place": "Int32"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        import pandas as pd

        pages = sorted(p[0] for p in self.waiting.keys())
        self.waiting.clear()
        yield pd.DataFrame([(key[0], p, "retry", None, None) for p in pages], columns=["source", "page_no", "kind", "place", "key"]).astype({"page_no": "Int32", "place": "Int32"})

    def close(self) -> None:
        pass


def judged(pages: DataFrame, repeats: int = REPEATS, wait: int = 60_000) -> DataFrame:
    """Events of a stream of (source, page_no, status, keys)."""
    rows = pages.select("source", "page_no", F.coalesce("status", F.lit(0)).alias("status"), "keys")
    return rows.groupBy("source").transformWithStateInPandas(StopRule(repeats, wait), EVENTS, "append", "ProcessingTime")


def json_keys(pages: DataFrame, member: str = "key") -> DataFrame:
    """The keys of pages that are JSON lists of objects, in their order."""
    cards = F.from_json("body", f"array<struct<`{member}`:string>>")
    return pages.select("source", "page_no", "status", F.transform(cards, lambda c: c[member]).alias("keys"))


def scan(spark: SparkSession, addresses: dict[str, str], upto: dict[str, int], sink: str, checkpoint: str, keys: Callable[[DataFrame], DataFrame] = json_keys, repeats: int = REPEATS, wait: int = 60_000) -> None:
    """Reads the pages up to ``upto`` that no scan with this checkpoint has read, and appends their events to ``sink``."""
    spark.dataSource.register(ListPages)
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    spark.conf.set(conf, ROCKS)
    try:
        pages = spark.readStream.format("attesta_list_pages").option("addresses", json.dumps(addresses)).option("upto", json.dumps(upto)).load()
        stream = judged(keys(pages), repeats, wait)
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(conf, before)


def goal(spark: SparkSession, addresses: dict[str, str], step: int, done: dict[str, int], sink: str | None = None) -> dict[str, int]:
    """The pages that the next scan goes to: ``step`` more than were ``done``, but no more in sources that have ended."""
    ended = {r["source"] for r in spark.read.parquet(sink).where("kind = 'end'").select("source").distinct().collect()} if sink else set()  # a row for each source
    return {s: done.get(s, 0) + (0 if s in ended else step) for s in addresses}


def pages_of(items: DataFrame, source: str, order: str, key: str, size: int, folder: str) -> dict[str, str]:
    """Writes a table as list pages of ``size`` items, as JSON, in blocks, and gives their addresses by source."""
    from pyspark.sql.window import Window as W

    numbered = items.select(F.col(source).cast("string").alias("source"), F.col(order).alias("o"), F.col(key).cast("string").alias("key")).withColumn("n", F.row_number().over(W.partitionBy("source").orderBy("o")) - 1)
    pages = numbered.groupBy("source", F.floor(F.col("n") / size + 1).cast("int").alias("page")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("n", "key"))), lambda x: F.struct(x["key"].alias("key")))).alias("value"))
    named = pages.select(F.md5("source").alias("list"), F.floor(F.col("page") / IN_BLOCK).alias("block"), F.concat(F.col("page").cast("string"), F.lit("\t"), "value").alias("value"))  # names of any letters
    named.repartition("list", "block").write.mode("overwrite").partitionBy("list", "block").text(folder)
    names = items.select(F.col(source).cast("string").alias("source")).where("source IS NOT NULL").distinct().withColumn("list", F.md5("source"))
    return {r["source"]: f"{folder}/list={r['list']}/block={{block}}" for r in names.collect()}  # a row for each source
