"""Tables of many small writes: rows lie in folders by part, and a log says which folders are current.

``data/<part>/write=<name>/`` holds what one write gave to a part (a day, a bucket), so whoever needs some parts lists only
their folders. A write becomes visible, all parts at once, by its row in the log, which is one small file; until then,
and for a write that failed, nobody sees it. Nothing that was ever visible is changed or removed, so readers never miss a
file.

The log has generations. ``log/gen=<g>/base`` says what was current when generation ``g`` began, and ``log/gen=<g>/writes`` has a
row for each write since. After ``fold_every`` writes the writer folds: it makes one folder of the current ones of each part that
has several, keeping the row that wins of each key, and begins the next generation with that. So a reader lists the
folders of a part and at most twice ``fold_every`` log rows, however long the table has been written.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmart.operators.dims import keep_latest, keep_latest_of_few
from rillmart.schemas import struct

STAMPS = {"_version": "bigint", "_source": "string", "_row": "bigint"}
_LOG = "kind STRING, write STRING, version BIGINT, source STRING, at BIGINT, parts ARRAY<STRING>"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of null
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"  # fixed value: characters that a partition folder has as % and two hex digits


def part_folder(names: Sequence[str], values: Sequence[object]) -> str:
    """The path of a part below ``data``, as Spark writes it."""

    def text(value: object) -> str:
        if value is None or value == "":
            return _NO_VALUE
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in str(value))

    return "/".join(f"{n}={text(v)}" for n, v in zip(names, values, strict=True))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Staged(NamedTuple):
    """A write whose rows lie in their folders, but which is not in the log yet: nobody sees it."""

    name: str
    parts: list[str]


class LogTable:
    """Rows by part and key, of which the one with the highest ``order`` counts.

    ``parts`` and ``keys`` are columns of ``schema``; ``order`` may name the stamps of a write as well: its version, its source, and
    the row's place in it. The same version of a source written again replaces what it wrote before, until a fold has taken
    that in; from then on its rows are copies of stored ones. With ``in_order`` each source writes rising versions, and what
    a fold has taken in is not written again. Several writers may append; a fold by two of them at once wastes one of the two.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, parts: list[str], keys: list[str],
        order: list[str] | None = None, fold_every: int = 100, in_order: bool = False,
    ):
        if fold_every < 1:
            raise ValueError("fold_every must be at least 1")
        self.spark, self.path, self.schema, self.parts, self.keys = spark, path.rstrip("/"), schema, parts, keys
        self.order, self.fold_every, self.in_order = order or list(STAMPS), fold_every, in_order
        self._gen, self._since = 0, None

    # ---- the log ----

    def _begun(self, gen: int) -> bool:
        return gen == 0 or exists(self.spark, f"{self.path}/log/gen={gen}/base/_SUCCESS")

    def generation(self) -> int:
        """The newest generation, found by steps that double and then halve: no folder is listed."""
        low, step = self._gen, 1
        while self._begun(low + step):
            low, step = low + step, step * 2
        while step > 1:
            step //= 2
            if self._begun(low + step):
                low += step
        if low != self._gen:
            self._gen, self._since = low, None
        return low

    def _rows(self, gen: int) -> list:
        """The log rows of a generation and the one before it that tell what is current: as many as parts and twice ``fold_every``."""
        paths = [f"{self.path}/log/gen={gen}/base", f"{self.path}/log/gen={gen}/writes", f"{self.path}/log/gen={gen - 1}/writes"]
        found = []
        for path, kind in zip(paths, ("base", "new", "late"), strict=True):
            if exists(self.spark, path):
                log = self.spark.read.schema(_LOG).option("recursiveFileLookup", "true").json(path)
                found += [r.asDict() | {"from": kind} for r in log.collect()]
        taken = {r["write"] for r in found if r["kind"] == "taken"}
        return [r for r in found if r["from"] != "late" or r["write"] not in taken]

    def current(self, only: Iterable[str] | None = None) -> dict[str, list[str]]:
        """The current writes of each part, or of some parts."""
        return self._current(self._rows(self.generation()), None if only is None else set(only))

    @staticmethod
    def _current(rows: list[dict], only: set[str] | None = None) -> dict[str, list[str]]:
        best: dict[tuple, tuple] = {}
        for r in rows:
            if r["kind"] not in ("write", "fold"):
                continue
            for part in r["parts"]:
                if only is None or part in only:
                    # of a write that was made again the later one counts
                    one = (part, r["version"], r["source"]) if r["kind"] == "write" else (part, r["write"])
                    best[one] = max(best.get(one, (0, "")), (r["at"], r["write"]))
        out: dict[str, list[str]] = {}
        for (part, *_), (_, name) in best.items():
            out.setdefault(part, []).append(name)
        return {part: sorted(set(names)) for part, names in out.items()}

    def _commit(self, write: str, version: int, source: str, parts: list[str]) -> None:
        row = [("write", write, version, source, time.time_ns() // 1_000_000, parts)]
        while True:
            gen = self.generation()
            log = self.spark.createDataFrame(row, _LOG).coalesce(1)
            log.write.mode("overwrite").json(f"{self.path}/log/gen={gen}/writes/{write}")
            # a reader looks into two generations; were two folds made meanwhile, the row would be lost
            if self.generation() <= gen + 1:
                return

    # ---- writing ----

    def stage(self, df: DataFrame, version: int, source: str = "batch", rebalance: bool = True) -> Staged:
        """The rows of one write in their folders, for ``append`` to make visible. Rebalancing by part keeps files large, and splits
        a part that is large.

        Without ``rebalance`` the rows are not shuffled: each task writes a file for each part that it has rows of, which suits
        tables so large that these files are.
        """
        name = f"{version}-{source}-{uuid.uuid4().hex[:12]}"
        rows = df.select(*self.schema.fieldNames()).withColumns(
            {"_version": F.lit(version).cast("bigint"), "_source": F.lit(source), "_row": F.monotonically_increasing_id()}
        )
        return Staged(name, self._put(rows, name, rebalance))

    def append(self, df: DataFrame | Staged, version: int, source: str = "batch", rebalance: bool = True) -> None:
        """One write, of rows or of what ``stage`` has made of them."""
        if self.in_order and version <= self._taken(source):
            return
        name, parts = df if isinstance(df, Staged) else self.stage(df, version, source, rebalance)
        if parts:
            self._commit(name, version, source, parts)
            if self._since is None:
                self._since = sum(r["from"] != "base" for r in self._rows(self._gen))
            else:
                self._since += 1
            if self._since >= self.fold_every:
                self.fold()

    def _put(self, rows: DataFrame, name: str, rebalance: bool = True) -> list[str]:
        """Write rows into folders of a new name; returns the parts they are in."""
        seen = Observation()
        if rebalance:
            rows = rows.hint("rebalance", *[F.col(c) for c in self.parts])
        marked = rows.withColumn("write", F.lit(name))
        values = F.collect_set(F.to_json(F.array(*[F.col(c).cast("string") for c in self.parts])))
        marked = marked.observe(seen, values.alias("parts"))
        # a dynamic overwrite has a staging folder of its own, so that writers do not clear each other's
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        writer.partitionBy(*self.parts, "write").parquet(f"{self.path}/data")
        return sorted(part_folder(self.parts, json.loads(v)) for v in seen.get["parts"])

    def _taken(self, source: str) -> int:
        """The highest version of a source that folds have taken in."""
        gen = self.generation()
        if gen == 0:
            return -1
        base = self.spark.read.schema(_LOG).json(f"{self.path}/log/gen={gen}/base")
        found = base.where((F.col("kind") == "upto") & (F.col("source") == source)).agg(F.max("version")).first()[0]
        return -1 if found is None else found

    def fold(self, only: Iterable[str] | None = None) -> None:
        """Make one folder of the current ones of each part that has several, or of ``only`` these parts; readers go on undisturbed."""
        gen = self.generation()
        log = self._rows(gen)
        current = self._current(log)
        wanted = set(current if only is None else only)
        several = sorted(p for p, names in current.items() if p in wanted and len(names) > 1)
        name = f"fold-{uuid.uuid4().hex[:12]}"
        now = time.time_ns() // 1_000_000
        if several:
            rows = self._folders([f"{p}/write={w}" for p in several for w in current[p]])
            self._put(self.latest(rows), name)
        keep = {p: set(names) for p, names in current.items() if p not in set(several)}
        base = [("fold", name, None, None, now, several)] if several else []
        upto: dict[str, int] = {}
        for r in log:
            if r["kind"] == "upto":
                upto[r["source"]] = max(upto.get(r["source"], -1), r["version"])
            elif r["kind"] in ("write", "fold"):
                left = [p for p in r["parts"] if r["write"] in keep.get(p, ())]
                if left:
                    base.append((r["kind"], r["write"], r["version"], r["source"], r["at"], left))
                if r["kind"] == "write":
                    upto[r["source"]] = max(upto.get(r["source"], -1), r["version"])
                    if r["from"] != "base":
                        base.append(("taken", r["write"], None, None, now, []))
        base += [("upto", None, v, s, now, []) for s, v in upto.items()]
        try:
            self.spark.createDataFrame(base, _LOG).coalesce(1).write.json(f"{self.path}/log/gen={gen + 1}/base")
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise  # else another writer has folded; what it left out is still current

    # ---- reading ----

    def _folders(self, folders: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *struct(**STAMPS).fields])
        names = schema.fieldNames()
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{f}" for f in folders]).select(*names)

    def writes(self, only: Iterable[Sequence[object]] | None = None) -> DataFrame:
        """The rows of all current writes, of all parts or of those with these values; no rows before the first."""
        if only is None:
            return self._folders([f"{p}/write={w}" for p, names in sorted(self.current().items()) for w in names])
        values = [tuple(v) for v in only]
        current = self.current(part_folder(self.parts, v) for v in values)
        return self._folders([f"{p}/write={w}" for p, names in sorted(current.items()) for w in names])

    def staged(self, write: Staged) -> DataFrame:
        """The rows of a write that is not visible yet, with their stamps."""
        return self._folders([f"{p}/write={write.name}" for p in write.parts])

    def beside(self, write: Staged) -> DataFrame:
        """The rows of all current writes in the parts of a write that is not visible yet."""
        return self._folders([f"{p}/write={w}" for p, names in sorted(self.current(write.parts).items()) for w in names])

    def latest(self, rows: DataFrame) -> DataFrame:
        return keep_latest(rows, [*self.parts, *self.keys], self.order)

    def latest_of_few(self, rows: DataFrame) -> DataFrame:
        """``latest`` of rows of which few share a key; one job runs at once, and only rows with rivals are shuffled."""
        return keep_latest_of_few(rows, [*self.parts, *self.keys], self.order)

    def latest_where(self, rows: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
        """Some columns of the latest rows that fulfil a condition.

        All rows are ranked, as a later row that does not fulfil it hides an earlier one that does; but of rows that do not, only
        what the ranking needs is shuffled.
        """
        ranked = [*self.parts, *self.keys, *self.order]
        found = F.when(condition, F.struct(*columns)).alias("_found")
        latest = self.latest(rows.select(*dict.fromkeys(ranked), found))
        return latest.where(F.col("_found").isNotNull()).select("_found.*")
