"""All files of a job appear, or none.

A sink's tasks write below ``<out>/_temporary/<job>`` and its commit lists the finished files there.  The driver
then publishes them through Spark's file system classes:

1. a journal (what moves where, which earlier files go) is written beside the files and renamed to
   ``<out>/_publish-<job>.json``.  Until that one rename the earlier output stands untouched;
2. the journal is carried out: files are moved to their names, files of the earlier output dropped;
3. the journal and the job's temporary folder are removed.

A driver that dies in step 2 leaves the journal.  Every step of it can be repeated, so the next writer or reader of
the folder (``recover``) carries it out to the end; a reader of its own kind sees by a ``_publish-*`` file that
the folder is between two outputs.
"""

from __future__ import annotations

import json
import posixpath
from concurrent.futures import ThreadPoolExecutor

THREADS = 16
JOURNAL = "_publish-"


class Folder:
    """A folder in any file system Spark can reach; paths are relative to it."""

    def __init__(self, spark, path: str):
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self._text = sc._jvm.org.apache.commons.io.IOUtils
        self.root = path.rstrip("/")
        self.fs = self._path(self.root).getFileSystem(sc._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(posixpath.join(self.root, name) if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def names(self, name: str) -> list[str]:
        """Names of a folder's entries; none if it does not exist."""
        if not self.exists(name) or self.fs.getFileStatus(self.at(name)).isFile():
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))]

    def read(self, name: str) -> dict:
        stream = self.fs.open(self.at(name))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, doc: dict) -> None:
        stream = self.fs.create(self.at(name), True)
        try:
            stream.write(bytearray(json.dumps(doc).encode()))
        finally:
            stream.close()

    def make(self, name: str) -> None:
        self.fs.mkdirs(self.at(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def move(self, old: str, new: str) -> None:
        """Put ``old`` in the place of ``new``; nothing to do if an earlier attempt has."""
        if not self.exists(old):
            return
        self.delete(new)
        if not self.fs.rename(self.at(old), self.at(new)) and self.exists(old):
            raise OSError(f"cannot move {old} to {new} in {self.root}")


def temporary(job: str) -> str:
    return posixpath.join("_temporary", job)


def publish(spark, path: str, job: str, moves: list[tuple[str, str]], drops: list[str]) -> None:
    """Carry out ``moves`` (old, new) and ``drops``, all relative to ``path``, as one step."""
    folder = Folder(spark, path)
    draft = posixpath.join(temporary(job), "journal.json")
    folder.make(temporary(job))
    folder.write(draft, {"job": job, "moves": moves, "drops": drops})
    journal = f"{JOURNAL}{job}.json"
    folder.move(draft, journal)
    _carry_out(folder, journal)


def recover(spark, path: str) -> None:
    """Finish what a driver that died while publishing into ``path`` has left."""
    folder = Folder(spark, path)
    for name in folder.names(""):
        if name.startswith(JOURNAL):
            _carry_out(folder, name)


def _carry_out(folder: Folder, journal: str) -> None:
    plan = folder.read(journal)
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(folder.make, sorted({posixpath.dirname(new) for _, new in plan["moves"]} - {""})))
        list(pool.map(lambda m: folder.move(*m), plan["moves"]))
        list(pool.map(folder.delete, plan["drops"]))
    folder.delete(journal)
    discard(folder, plan["job"])


def discard(folder: Folder, job: str) -> None:
    """Remove a job's temporary files."""
    folder.delete(temporary(job))
    if folder.exists("_temporary") and not folder.names("_temporary"):
        folder.delete("_temporary")


def publish_files(spark, path: str, job: str, overwrite: bool, fmt: str) -> None:
    """Publish what the bin-files sink has listed.

    With ``overwrite`` the earlier output of each written input file in this format, in either layout, goes; other formats
    and other input files are left alone.
    """
    folder = Folder(spark, path)
    listed = folder.read(posixpath.join(temporary(job), "manifest.json"))["files"]
    finals = {final for _, _, final in listed}
    if len(finals) != len(listed):
        # two tasks wrote the same (file, bucket): the input was not
        # clustered the way the layout needs; never drop either silently
        discard(folder, job)
        raise RuntimeError("several tasks wrote the same output file; cluster the bins by "
                           "(file_stem, bin // bins_per_part) or use clustered=False")

    def earlier(stem: str) -> list[str]:
        found = []
        for base, end in (("", f".{fmt}"), ("_index", f".{fmt}.index")):
            inside = posixpath.join(base, stem)
            found += [posixpath.join(inside, n) for n in folder.names(inside) if n.endswith(end)]
            if folder.exists(inside + end) and folder.fs.getFileStatus(folder.at(inside + end)).isFile():
                found.append(inside + end)
        return [f for f in found if f not in finals]

    drops: list[str] = []
    if overwrite:
        with ThreadPoolExecutor(THREADS) as pool:
            for found in pool.map(earlier, sorted({stem for _, stem, _ in listed})):
                drops += found
    publish(spark, path, job, [(tmp, final) for tmp, _, final in listed], drops)


def publish_partitions(spark, path: str, job: str, drops: list[str]) -> None:
    """Publish the ``file_stem=`` folders of a Parquet table written to the job's temporary folder."""
    folder = Folder(spark, path)
    made = [n for n in folder.names(temporary(job)) if n.startswith("file_stem=")]
    publish(spark, path, job, [(posixpath.join(temporary(job), n), n) for n in made], [d for d in drops if d not in made])
