"""Stories that live in a stream's state.

Reports arrive keyed by pool and story. A story starts with its first report,
takes one block of each publisher family and at most ``MOST`` in all, and ends a
day after its start or six hours after it last took in something new; then it
is emitted, if reports of at least ``LEAST_SOURCES`` sources are left. Blocks are
put back under the rules whenever they are read, so a rule that was added after
a block was stored holds for that block too.

State: a value (start, last news) and a list of blocks by key. An event-time
timer stands at the moment the story would end and moves with every report, so
keys without further reports leave the state as the watermark passes it.
Reports of one batch are taken in order of time and number; how reports are
dealt into batches doesn't matter as long as the watermark keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from presslens.functions import words as W
from presslens.shared import fresh_path

HOUR = 3_600_000
LIFE_MS, STALE_MS = 24 * HOUR, 6 * HOUR
MOST = 7
LEAST_SOURCES = 2
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: What the operator takes; ``at`` is the time of the report.
REPORT = "pool string, story string, idx long, source string, family string, url string, title string, summary string, scope string, at timestamp"
STORY = "pool string, story string, created_at long, fresh_at long, n_blocks long, n_sources long, scope string, urls string"

_ETIQUETTE = re.compile(W.ETIQUETTE)
_CYRILLIC, _LATIN_WORD, _NEIGHBOURS = re.compile("[Ѐ-ӿ]"), re.compile("[A-Za-z]{4,}"), re.compile("[ўқғҳөүңӯҷӣ]")


def off_rules(pool: str, title: str | None, summary: str | None) -> bool:
    """Whether a block no longer stands: courtesies, and texts in an alphabet that the pool doesn't read."""
    if _ETIQUETTE.search((title or "").lower()):
        return True
    text = f"{title or ''} {summary or ''}"
    if len(text) < 40:
        return False
    cyrillic = len(_CYRILLIC.findall(text))
    if pool == "ru":
        return len(_NEIGHBOURS.findall(text)) >= 2 or (cyrillic < 10 and len(_LATIN_WORD.findall(text)) >= 8)
    return cyrillic >= 10


class Stories(StatefulProcessor):
    """One story at a time for each key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "created long, fresh long")
        self.blocks = handle.getListState("blocks", "source string, family string, url string, title string, summary string, scope string")

    def _read(self, pool: str) -> tuple[list[int] | None, list[tuple]]:
        life = self.life.get() if self.life.exists() else None
        kept = [b for b in self.blocks.get() if not off_rules(pool, b[3], b[4])] if life else []
        return list(life) if life else None, kept

    def _story(self, key: tuple, life: list[int], blocks: list[tuple]) -> list[tuple]:
        blocks = [b for b in blocks if not off_rules(key[0], b[3], b[4])]
        sources = {b[0] for b in blocks}
        if len(sources) < LEAST_SOURCES:
            return []
        scopes = [b[5] for b in blocks if b[5]]
        scope = max(dict.fromkeys(scopes), key=scopes.count, default="world")
        return [(*key, life[0], life[1], len(blocks), len(sources), scope, " ".join(b[2] for b in blocks))]

    def _ends(self, life: list[int]) -> int:
        return min(life[0] + LIFE_MS, life[1] + STALE_MS)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        life, blocks = self._read(key[0])
        before, out = self._ends(life) if life else None, []
        batch = pd.concat(rows)
        batch["ms"] = batch["at"].astype("datetime64[ms]").astype("int64")
        for r in batch.sort_values(["ms", "idx"], kind="stable").itertuples():
            if life and r.ms >= self._ends(life):
                out += self._story(key, life, blocks)
                life, blocks = None, []
            life = life or [r.ms, r.ms]
            blocks = [b for b in blocks if not off_rules(key[0], b[3], b[4])]
            if r.family not in {b[1] for b in blocks}:
                life[1] = r.ms
                blocks = [*blocks, (r.source, r.family, r.url, r.title, r.summary, r.scope)][:MOST]
        self.life.update(tuple(life))
        if blocks:
            self.blocks.put(blocks)
        else:
            self.blocks.clear()
        if before != self._ends(life):
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(self._ends(life))
        yield self._frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        life, blocks = self._read(key[0])
        if life and expiredTimerInfo.getExpiryTimeInMs() >= self._ends(life):
            self.life.clear()
            self.blocks.clear()
            yield self._frame(self._story(key, life, blocks))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[f.split()[0] for f in STORY.split(", ")])

    def close(self) -> None:
        pass


def ended_stories(reports: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The stories of a stream of reports, each when it ends."""
    timed = reports.withWatermark("at", delay)
    return timed.groupBy("pool", "story").transformWithStateInPandas(statefulProcessor=Stories(), outputStructType=T._parse_datatype_string(STORY), outputMode="Append", timeMode="EventTime")


def replay(reports: DataFrame, batches: int = 3, delay: str = "1 hour") -> DataFrame:
    """Run a table of reports through the stream in ``batches`` stretches of time, one run after the other.

    Every run starts from the progress and state that the last one left in the
    shared folder.
    """
    spark = reports.sparkSession
    path = fresh_path(spark, "stories")
    span = reports.agg(F.min(F.unix_millis("at")).alias("lo"), F.max(F.unix_millis("at")).alias("hi")).first()
    if span["lo"] is None:
        return spark.createDataFrame([], STORY)
    part = F.least(F.floor((F.unix_millis("at") - span["lo"]) * batches / F.lit(span["hi"] - span["lo"] + 1)), F.lit(batches - 1))
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        for k in range(batches):
            reports.filter(part == k).write.mode("append").parquet(f"{path}/reports")
            arriving = spark.readStream.schema(reports.schema).parquet(f"{path}/reports")
            run = ended_stories(arriving, delay).writeStream.outputMode("append").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start(f"{path}/table", format="parquet")
            run.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    return spark.read.schema(STORY).parquet(f"{path}/table")
