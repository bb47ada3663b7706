"""Outputs of one unit of work that become visible together, and once.

A unit (a micro-batch of one table, an appended gold model of one run) writes
each of its outputs to a folder that readers skip (``<target>/_staged/<key>``).
``commit`` names every file in a manifest, replaced in one step: that is the
commit. Then the files are moved to their places under names that begin with
the key. A unit that is delivered again finds its manifest: if files are still
to move they are moved, nothing is written twice. Without a manifest nothing of
the unit has been visible; what a failed attempt staged is removed.

Readers of plain Parquet folders need no change. A unit's files are as many as
its tasks wrote; their names pass through the driver, their rows do not. One
writer per ledger is assumed (a stream with its checkpoint, or one pipeline
run); ledgers of different streams must differ, as batch numbers start anew.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession

from .tables import _fs, path_exists, read_text, remove, write_text

#: Manifests of units that far behind the newest are removed.
KEEP_UNITS = 200
#: Files moved at a time.
MOVES = 16


class Unit:
    def __init__(self, spark: SparkSession, ledger: str, key: str):
        self.spark, self.key = spark, key
        self.ledger = ledger.rstrip("/")
        self.manifest = f"{self.ledger}/{key}.json"
        self.targets: list[str] = []

    def committed(self) -> dict | None:
        """What the unit recorded if it was committed before; moves that were
        left are finished."""
        if not path_exists(self.spark, self.manifest):
            return None
        found = json.loads(read_text(self.spark, self.manifest))
        if found["moves"]:
            self._move(found)
        return found["info"]

    def stage(self, target: str) -> str:
        """A fresh folder for the unit's rows of ``target``."""
        target = target.rstrip("/")
        path = f"{target}/_staged/{self.key}"
        remove(self.spark, path)
        self.targets.append(target)
        return path

    def discard(self) -> None:
        """Remove what was staged so far."""
        for target in self.targets:
            remove(self.spark, f"{target}/_staged/{self.key}")
        self.targets.clear()

    def commit(self, **info) -> None:
        moves = []
        for target in self.targets:
            root = f"{target}/_staged/{self.key}"
            for name in _files(self.spark, root):
                folder, _, file = name.rpartition("/")
                moves.append([f"{root}/{name}", "/".join(x for x in (target, folder, f"{self.key}-{file}") if x)])
        found = {"info": info, "moves": moves, "targets": self.targets}
        write_text(self.spark, self.manifest, json.dumps(found))
        self._move(found)

    def _move(self, found: dict) -> None:
        def one(move: list[str]) -> None:
            fs, src = _fs(self.spark, move[0])
            _, dst = _fs(self.spark, move[1])
            if fs.rename(src, dst):
                return
            if fs.exists(src):  # the folder was missing, or the move failed
                fs.mkdirs(dst.getParent())
                if not fs.rename(src, dst):
                    raise RuntimeError(f"could not move {move[0]} to {move[1]}")

        if found["moves"]:
            for folder in {place.rpartition("/")[0] for _, place in found["moves"]}:
                fs, p = _fs(self.spark, folder)
                fs.mkdirs(p)
            with ThreadPoolExecutor(MOVES) as pool:
                list(pool.map(one, found["moves"]))
        for target in found["targets"]:
            remove(self.spark, f"{target}/_staged/{self.key}")
        write_text(self.spark, self.manifest, json.dumps(found | {"moves": []}))


def _files(spark: SparkSession, root: str) -> list[str]:
    """Data files below ``root``, as relative paths (listed in parallel by
    Spark's own reader)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    base = p.toUri().getPath().rstrip("/") + "/"
    found = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(root).inputFiles()
    return sorted(unquote(urlsplit(f).path).partition(base)[2] for f in found)


def prune(spark: SparkSession, ledger: str, prefix: str, number: int, keep: int = KEEP_UNITS) -> None:
    """Remove the manifest of unit ``<prefix><number - keep>``: only the newest
    batch of a stream can be delivered again."""
    if number >= keep:
        remove(spark, f"{ledger.rstrip('/')}/{prefix}{number - keep}.json")
