"""A set of artefacts (tables, models) that changes as a whole.

A build writes into a fresh folder ``runs/<run>``.  When all parts are there, a small
manifest ``manifests/<number>.json`` names them; it is written last, in one piece,
under the next free number.  Readers follow the newest manifest that can be read, so
they see the old set until the new one is complete, and a build that dies half-way
changes nothing.  Nothing is renamed or overwritten, so this holds on object stores
too; of two builds that publish at once, each gets a number of its own.

A manifest may carry parts of an older run along (``base``): the evaluation's tables
join the models they were made from.  The newest ``KEEP`` manifests stay, and the runs
they name; older ones are removed after a publication.
"""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from cartwise.session import delete_path

log = logging.getLogger(__name__)

KEEP = 2


@dataclass
class Manifest:
    number: int
    parts: dict[str, str] = field(default_factory=dict)  # name -> path below the root

    def text(self) -> str:
        return json.dumps({"number": self.number, "parts": self.parts}, sort_keys=True)


class ArtefactStore:
    """Artefact sets below ``root``, in whatever file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    # ---- files, through the file system that Spark uses -------------------------
    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _read(self, path: str) -> str:
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one already."""
        p, fs = self._fs(path)
        try:
            stream = fs.create(p, False)
        except Py4JJavaError as exc:
            if fs.exists(p):
                return False
            raise exc
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    # ---- manifests -----------------------------------------------------------------
    def _numbers(self) -> list[int]:
        """Numbers of the manifests, newest first."""
        names = self._names(f"{self.root}/manifests")
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _manifest(self, number: int) -> Manifest | None:
        try:
            found = json.loads(self._read(f"{self.root}/manifests/{number:08d}.json"))
            return Manifest(number, dict(found["parts"]))
        except (ValueError, KeyError, TypeError, Py4JJavaError) as exc:
            log.warning("manifest %d of %s cannot be read: %s", number, self.root, exc)
            return None

    def manifests(self) -> list[Manifest]:
        """Readable manifests, newest first."""
        return [m for m in map(self._manifest, self._numbers()) if m is not None]

    def current(self) -> Manifest | None:
        return next((m for m in map(self._manifest, self._numbers()) if m is not None), None)

    def path(self, manifest: Manifest, name: str) -> str | None:
        """Where a part of a published set is."""
        part = manifest.parts.get(name)
        return None if part is None else f"{self.root}/{part}"

    def begin(self) -> Run:
        return Run(self, uuid.uuid4().hex)

    def publish(self, parts: dict[str, str], base: Manifest | None = None) -> Manifest:
        parts = {**(base.parts if base else {}), **parts}
        number = next(iter(self._numbers()), 0) + 1
        while not self._create(f"{self.root}/manifests/{number:08d}.json", Manifest(number, parts).text()):
            number += 1
        self._prune()
        return Manifest(number, parts)

    def _prune(self) -> None:
        every = self.manifests()
        kept, old = every[:KEEP], every[KEEP:]
        used = {p.split("/")[1] for m in kept for p in m.parts.values()}
        for m in old:
            for run in {p.split("/")[1] for p in m.parts.values()} - used:
                delete_path(self.spark, f"{self.root}/runs/{run}")
            delete_path(self.spark, f"{self.root}/manifests/{m.number:08d}.json")


class Run:
    """A fresh folder; ``with`` removes it again if the block fails before it is
    published."""

    def __init__(self, store: ArtefactStore, name: str):
        self.store, self.name, self.parts = store, name, {}

    def part(self, name: str) -> str:
        """The path to write part ``name`` to."""
        self.parts[name] = f"runs/{self.name}/{name}"
        return f"{self.store.root}/{self.parts[name]}"

    def publish(self, base: Manifest | None = None) -> Manifest:
        return self.store.publish(self.parts, base)

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            delete_path(self.store.spark, f"{self.store.root}/runs/{self.name}")
