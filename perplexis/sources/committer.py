"""Files put in place under names of their own, so that an interrupted run can be finished.

Spark writes folders of parts. Here every part becomes one file under a name that
the job chose: parts are written to a staging folder, the list of moves is
written to a journal in one step, then the moves are made. A journal that is found
at the next start is carried out first: a part that is still staged wasn't
moved. All of it goes through Spark's Hadoop file systems, like its own writes.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

# Names from an underscore on are no input to any scan.
WORK_FOLDER = "_scoring"


class Store:
    """File operations on any path that Spark can read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def is_folder(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place) and system.getFileStatus(place).isDirectory()

    def names(self, folder: str) -> list[str]:
        """What lies directly in a folder; nothing if there is none."""
        system, place = self._at(folder)
        return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def move(self, source: str, target: str) -> None:
        """Puts a file where another may be."""
        system, place = self._at(target)
        _, given = self._at(source)
        system.mkdirs(place.getParent())
        if system.exists(place):
            system.delete(place, True)
        if not system.rename(given, place):
            raise OSError(f"{source} can't be moved to {target}.")

    def write(self, path: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        system, place = self._at(draft)
        system.mkdirs(place.getParent())
        out = system.create(place, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(draft, path)

    def read(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def work_folder(folder: str) -> str:
    return posixpath.join(folder.rstrip("/"), WORK_FOLDER)


def staging_path(folder: str) -> str:
    return f"{work_folder(folder)}/staging-{uuid.uuid4().hex}"


def commit(store: Store, folder: str, staging: str, moves: Iterable[tuple[str, str]]) -> None:
    """Makes the moves (from within ``staging``) behind a journal in ``folder``."""
    journal = f"{work_folder(folder)}/journal/{uuid.uuid4().hex}.json"
    store.write(journal, json.dumps({"staging": staging, "moves": list(moves)}))
    _carry_out(store, journal)


def recover(store: Store, folder: str) -> int:
    """Finishes the commits that were interrupted in ``folder``, and returns how many there were.

    What was staged without a journal never counted, and goes.
    """
    work = work_folder(folder)
    journals = [n for n in store.names(f"{work}/journal") if n.endswith(".json")]
    for name in journals:
        _carry_out(store, f"{work}/journal/{name}")
    for name in store.names(work):
        if name.startswith("staging-"):
            store.delete(f"{work}/{name}")
    return len(journals)


def _carry_out(store: Store, journal: str) -> None:
    plan = json.loads(store.read(journal))
    for source, target in plan["moves"]:
        if store.exists(source):
            store.move(source, target)
    store.delete(plan["staging"])
    store.delete(journal)
