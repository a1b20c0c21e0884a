"""Tables that change by new folders and a small list of what counts.

Nothing is ever written over: data go to a folder of their own, and a list, written last and put in place by one
rename, says which folders are the table. A job that dies half-way leaves the list, and so the table, as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ON = "_on"  # partition folder column; the date itself stays in the files
_NULL = "none"


class Lists:
    """Numbered JSON documents in a folder; the newest one is in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder = self._path(f"{self.path}/_lists")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def read(self, number: int) -> dict:
        source = self._fs.open(self._path(f"{self.path}/_lists/{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def write(self, number: int, content: dict) -> None:
        """The list of a number, at once; a list of that number is replaced."""
        aside = self._path(f"{self.path}/_lists/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        place = self._path(f"{self.path}/_lists/{number}.json")
        if self._fs.exists(place):
            self._fs.delete(place, False)
        if not self._fs.rename(aside, place):
            raise OSError(f"cannot put {place} in place")

    def drop(self, number: int) -> None:
        self._fs.delete(self._path(f"{self.path}/_lists/{number}.json"), False)

    def delete(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{folder}"), True)

    def folders(self, folder: str) -> list[str]:
        top = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(top) if s.isDirectory()] if self._fs.exists(top) else []


class PublishedTable:
    """A table that is replaced as a whole by pointing to another folder."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.lists, self.keep = spark, Lists(spark, path), keep

    def read(self) -> DataFrame | None:
        """The table; none where nothing is published yet."""
        numbers = self.lists.numbers()
        if not numbers:
            return None
        entry = self.lists.read(numbers[-1])
        schema = T.StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.lists.path}/{entry['folder']}")

    def rows(self) -> int:
        numbers = self.lists.numbers()
        return self.lists.read(numbers[-1])["rows"] if numbers else 0

    def replace(self, df: DataFrame, least: int = 0) -> bool:
        """Write the rows once and point to them, where there are ``least`` or more of them."""
        folder = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.lists.path}/{folder}")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.lists.path}/{folder}").count()  # footers only
        if rows < least:
            self.lists.delete(folder)
            return False
        numbers = self.lists.numbers()
        following = (numbers[-1] if numbers else 0) + 1
        self.lists.write(following, {"folder": folder, "rows": rows, "schema": df.schema.jsonValue()})
        for number in [*numbers, following][: -self.keep]:
            self.lists.delete(self.lists.read(number)["folder"])
            self.lists.drop(number)
        return True


@dataclass(frozen=True)
class Part:
    """A date partition: its folder and, where it was taken, its content's digest."""

    folder: str
    digest: tuple[int, ...] | None = None


class DatedTable:
    """A table whose date partitions have versions of their own.

    A list maps every date to a folder. Writing makes folders for the dates at hand only and a list that takes them in;
    other dates are neither read nor written. Numbers are those of batches: a batch that runs again starts from the
    list before it and puts its own list anew, so it counts once. The list has one line a date.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str, keep: int = 3):
        if by not in schema.fieldNames():
            raise ValueError(f"no column {by!r} to partition by")
        self.spark, self.schema, self.by, self.keep = spark, schema, by, keep
        self.lists = Lists(spark, path)

    def parts(self, before: int | None = None) -> dict[str, Part]:
        """Date to folder, of the newest list (below a number)."""
        numbers = [n for n in self.lists.numbers() if before is None or n < before]
        if not numbers:
            return {}
        listed = self.lists.read(numbers[-1])["parts"]
        return {d: Part(p["folder"], tuple(p["digest"]) if p.get("digest") else None) for d, p in listed.items()}

    def next_number(self) -> int:
        numbers = self.lists.numbers()
        return numbers[-1] + 1 if numbers else 0

    def read(self, before: int | None = None, dates: Sequence[str] | None = None) -> DataFrame:
        """The table, or only some dates of it (their text forms): other folders are not opened."""
        parts = self.parts(before)
        wanted = parts if dates is None else {d: parts[d] for d in dates if d in parts}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.lists.path}/{p.folder}" for p in wanted.values()])

    def latest(self) -> DataFrame:
        return self.read()

    def on(self) -> Column:
        """A row's date as the list has it."""
        return F.coalesce(F.col(self.by).cast("string"), F.lit(_NULL))

    def dates(self, df: DataFrame) -> list[str]:
        """The dates of some rows: at most one value for each date there is."""
        return sorted(r[0] for r in df.select(self.on().alias("d")).distinct().collect())

    def digests(self, df: DataFrame) -> dict[str, tuple[int, ...]]:
        """Per date: number of rows and order-free sums of two row hashes."""
        columns = [F.col(f"`{c}`") for c in self.schema.fieldNames()]
        hashes = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
        rows = df.groupBy(self.on().alias("d")).agg(F.count("*").alias("n"), hashes[0].alias("x"), hashes[1].alias("y"))
        return {r["d"]: (r["n"], int(r["x"]), int(r["y"])) for r in rows.collect()}

    def write(
        self, df: DataFrame, number: int, drop: Sequence[str] = (), digests: dict[str, tuple[int, ...]] | None = None
    ) -> list[str]:
        """New versions of the dates that ``df`` has rows of; ``drop`` names dates that go. Returns the dates written."""
        folder = f"b-{number}-{uuid.uuid4().hex[:12]}"
        laid_out = df.select(*[F.col(f"`{c}`") for c in self.schema.fieldNames()], self.on().alias(_ON))
        laid_out = laid_out.hint("rebalance", F.col(_ON))
        laid_out.write.partitionBy(_ON).parquet(f"{self.lists.path}/{folder}")
        written = {}
        for name in self.lists.folders(folder):
            if name.startswith(f"{_ON}="):
                date = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name[4:])
                written[date] = Part(f"{folder}/{name}", (digests or {}).get(date))
        parts = {d: p for d, p in self.parts(number).items() if d not in drop} | written
        listed = {d: {"folder": p.folder, "digest": p.digest} for d, p in parts.items()}
        self.lists.write(number, {"parts": listed})
        self._forget()
        return sorted(written)

    def _forget(self) -> None:
        """Lists beyond the newest few go, with the folders that only they name."""
        numbers = self.lists.numbers()
        stale = numbers[: -self.keep]
        if not stale:
            return
        held = {p["folder"] for n in numbers[-self.keep :] for p in self.lists.read(n)["parts"].values()}
        for n in stale:
            for part in self.lists.read(n)["parts"].values():
                if part["folder"] not in held:
                    self.lists.delete(part["folder"])
            self.lists.drop(n)

    def replace_recent(self, requeried: DataFrame, days_back: int = 1) -> list[str]:
        """Re-queried rows for the days from ``days_back`` before the newest stored one on; equal days are skipped.

        Days whose content has the digest of the list are not written, days without rows any more go, older days are
        not opened. Returns the dates written.
        """
        parts = self.parts()
        newest = max((d for d in parts if d != _NULL), default=None)
        if newest is not None:
            cut = F.date_sub(F.lit(newest).cast("date"), days_back)
            requeried = requeried.filter(F.col(self.by).cast("date") >= cut)
            first = str(self.spark.range(1).select(cut.cast("string")).first()[0])
        found = self.digests(requeried)
        recent = {d: p for d, p in parts.items() if newest is not None and d != _NULL and d >= first}
        changed = [d for d, digest in found.items() if d not in recent or recent[d].digest != digest]
        gone = [d for d in recent if d not in found]
        if not changed and not gone:
            return []
        return self.write(requeried.filter(self.on().isin(changed)), self.next_number(), gone, found)


class AppendTable:
    """Rows in one folder for each batch; a batch that runs again replaces its own folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.schema, self.lists = spark, schema, Lists(spark, path)

    def _read(self, numbers: Sequence[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], self.schema)
        folders = [self.lists.read(n)["folder"] for n in numbers]
        return self.spark.read.schema(self.schema).parquet(*[f"{self.lists.path}/{f}" for f in folders])

    def before(self, batch: int) -> DataFrame:
        return self._read([n for n in self.lists.numbers() if n < batch])

    def latest(self) -> DataFrame:
        return self._read(self.lists.numbers())

    def append(self, df: DataFrame, batch: int) -> None:
        folder = f"b-{batch}-{uuid.uuid4().hex[:12]}"
        df.select(*[F.col(f"`{c}`") for c in self.schema.fieldNames()]).write.parquet(f"{self.lists.path}/{folder}")
        self.lists.write(batch, {"folder": folder})
