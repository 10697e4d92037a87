"""A keyed table that streams write to: one snapshot, a few deltas, and pointers that say which of them count.

Every commit writes a delta of its own (newest row per key) and then one pointer file that names the snapshot, the deltas and the last batch
committed; a pointer is created under the next number and never overwritten, so of two writers one fails, and a reader, who takes the highest
pointer, sees all of a commit or nothing. A batch number that is already committed is ignored. From ``most_deltas`` deltas on a commit also
folds them into a new snapshot. Folders that neither the current nor the previous pointer names are deleted, so a reader may finish.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from callweave.operators.relational import pick_per_key


@dataclass
class KeyedTable:
    spark: SparkSession
    path: str
    keys: list[str]
    version: Column
    most_deltas: int = 8
    _fs: object = field(default=None, repr=False)

    def _folder(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def fs(self):
        if self._fs is None:
            self._fs = self._folder("x").getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return self._fs

    def _numbers(self) -> list[int]:
        where = self._folder("_pointers")
        if not self.fs.exists(where):
            return []
        return sorted(int(f.getPath().getName()) for f in self.fs.listStatus(where) if f.getPath().getName().isdigit())

    def _read_pointer(self, number: int) -> dict:
        stream = self.fs.open(self._folder(f"_pointers/{number:012d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _write_pointer(self, number: int, pointer: dict) -> None:
        # The content is complete before it has the name that counts; an existing name is not replaced.
        draft, final = self._folder(f"_pointers/draft-{uuid.uuid4().hex}"), self._folder(f"_pointers/{number:012d}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(pointer).encode()))
        stream.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            raise RuntimeError(f"another writer committed pointer {number} of {self.path}")

    def pointer(self) -> dict:
        """The current state: snapshot (or null), deltas, last batch."""
        numbers = self._numbers()
        return self._read_pointer(numbers[-1]) if numbers else {"snapshot": None, "deltas": [], "batch": -1}

    def _rows(self, pointer: dict) -> DataFrame | None:
        parts = [p for p in (pointer["snapshot"], *pointer["deltas"]) if p]
        if not parts:
            return None
        rows = self.spark.read.parquet(*(f"{self.path}/{p}" for p in parts))
        return pick_per_key(rows, self.keys, self.version, lowest=False)

    def read(self) -> DataFrame:
        """Newest row of every key as of the current pointer."""
        rows = self._rows(self.pointer())
        if rows is None:
            raise FileNotFoundError(f"nothing is committed to {self.path}")
        return rows

    def commit(self, batch: DataFrame, number: int) -> None:
        """Adds a batch's newest rows; a number at or below the last one committed changes nothing."""
        now = self.pointer()
        if number <= now["batch"]:
            return
        delta = f"delta-{number:012d}-{uuid.uuid4().hex[:8]}"
        pick_per_key(batch, self.keys, self.version, lowest=False).write.parquet(f"{self.path}/{delta}")
        new = {"snapshot": now["snapshot"], "deltas": [*now["deltas"], delta], "batch": number}
        if len(new["deltas"]) >= self.most_deltas:
            new = self._folded(new)
        self._write_pointer((self._numbers() or [-1])[-1] + 1, new)
        self._sweep()

    def _folded(self, pointer: dict) -> dict:
        snapshot = f"snapshot-{pointer['batch']:012d}-{uuid.uuid4().hex[:8]}"
        self._rows(pointer).write.parquet(f"{self.path}/{snapshot}")
        return {"snapshot": snapshot, "deltas": [], "batch": pointer["batch"]}

    def compact(self) -> None:
        """Folds all deltas into a new snapshot; what readers see stays the same."""
        now = self.pointer()
        if now["deltas"]:
            self._write_pointer(self._numbers()[-1] + 1, self._folded(now))
            self._sweep()

    def _sweep(self) -> None:
        numbers = self._numbers()
        named = set()
        for n in numbers[-2:]:
            p = self._read_pointer(n)
            named |= {p["snapshot"], *p["deltas"]}
        for n in numbers[:-2]:
            self.fs.delete(self._folder(f"_pointers/{n:012d}"), False)
        for f in self.fs.listStatus(self._folder("")):
            name = f.getPath().getName()
            if name.startswith(("delta-", "snapshot-")) and name not in named:
                self.fs.delete(f.getPath(), True)
