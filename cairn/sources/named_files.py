"""A Spark sink for files with names of their own, which commits: a set of folders is replaced at once, or files are added and
taken away again where the job fails."""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


class Files(DataSource):
    """``df.write.format("named_files").save(folder)`` writes ``content`` to ``folder/path`` for each row, on any file system that
    executors reach: local paths they all mount, or a URI.  Option ``replaced`` names folders below, with commas between, that
    the files take the place of as a whole."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        replaced = self.options.get("replaced")
        return Writer(self.options["path"], replaced.split(",") if replaced else None)


def _at(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def _there(files, path: str) -> bool:
    return files.get_file_info(path).type.name != "NotFound"


def _names(files, folder: str) -> list[str]:
    from pyarrow import fs

    return [i.base_name for i in files.get_file_info(fs.FileSelector(folder))]


def _move(files, old: str, new: str) -> None:
    files.create_dir(posixpath.dirname(new), recursive=True)
    files.move(old, new)


def _read(files, path: str):
    with files.open_input_stream(path) as held:
        return json.loads(held.read())


def _write(files, path: str, value) -> None:
    with files.open_output_stream(path) as out:
        out.write(json.dumps(value).encode())


class Writer(DataSourceWriter):
    """Files wait in ``.new-<job>`` until their task, or for replaced folders the whole job, is done.

    Replacing is decided by one file, ``.commit-<job>``: before it is there the old folders are whole, and once it is there
    ``finish`` puts the new ones in their place, if need be again after a crash.  Without replaced folders each task moves its
    files when it has written all, and lists them first, so that a job that fails takes away what its tasks have moved."""

    def __init__(self, root: str, replaced: list[str] | None, job: str | None = None):
        self.root, self.replaced, self.job = root, replaced, job or uuid.uuid4().hex

    def write(self, rows) -> WriterCommitMessage:
        from pyspark import TaskContext

        files, base = _at(self.root)
        waiting, task, paths = f"{base}/.new-{self.job}", TaskContext.get().taskAttemptId(), []
        own = f"{waiting}/.task-{task}"
        files.create_dir(own, recursive=True)
        for r in rows:
            with files.open_output_stream(f"{own}/{len(paths)}") as out:
                out.write(bytes(r["content"] or b""))
            paths.append(r["path"])
        if self.replaced is None:
            _write(files, f"{waiting}/.made-{task}", paths)
        made = set()
        for i, path in enumerate(paths):
            to = posixpath.join(base if self.replaced is None else waiting, path)
            if posixpath.dirname(to) not in made:
                files.create_dir(posixpath.dirname(to), recursive=True)
                made.add(posixpath.dirname(to))
            files.move(f"{own}/{i}", to)  # a task that runs again writes the same file
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        files, base = _at(self.root)
        if self.replaced is not None:
            files.create_dir(base, recursive=True)
            _write(files, f"{base}/.record-{self.job}", {f: _there(files, f"{base}/.new-{self.job}/{f}") for f in self.replaced})
            files.move(f"{base}/.record-{self.job}", f"{base}/.commit-{self.job}")
            finish(files, base, self.job)
        elif _there(files, f"{base}/.new-{self.job}"):
            files.delete_dir(f"{base}/.new-{self.job}")

    def abort(self, messages) -> None:
        files, base = _at(self.root)
        waiting = f"{base}/.new-{self.job}"
        if not _there(files, waiting):
            return
        for name in _names(files, waiting):  # a list for each task
            if name.startswith(".made-"):
                for path in _read(files, f"{waiting}/{name}"):
                    if _there(files, posixpath.join(base, path)):
                        files.delete_file(posixpath.join(base, path))
        files.delete_dir(waiting)


def finish(files, base: str, job: str) -> None:
    """Put the folders of a committed job in their place; as often as needed, each step only where it isn't done."""
    new, old, commit = (f"{base}/.{k}-{job}" for k in ("new", "old", "commit"))
    for folder, has_new in _read(files, commit).items():
        if has_new and not _there(files, f"{new}/{folder}"):
            continue  # moved already
        if _there(files, f"{base}/{folder}"):
            _move(files, f"{base}/{folder}", f"{old}/{folder}")
        if has_new:
            _move(files, f"{new}/{folder}", f"{base}/{folder}")
    for left in (old, new):
        if _there(files, left):
            files.delete_dir(left)
    files.delete_file(commit)


def recover(root: str) -> None:
    """Finish what a broken job has committed to ``root``, and take away what others have left there; for one writer at a time."""
    files, base = _at(root)
    names = _names(files, base) if _there(files, base) else []
    for n in names:
        if n.startswith(".commit-"):
            finish(files, base, n.removeprefix(".commit-"))
    for n in names:
        if n.startswith(".record-"):
            files.delete_file(f"{base}/{n}")
        if n.startswith(".new-"):
            Writer(root, None, n.removeprefix(".new-")).abort([])


def write_files(rows: DataFrame, folder: str, replaced: list[str] | None = None) -> None:
    """Write ``content`` of each row to ``path`` below ``folder``; two rows of one path are an error, before anything is written.

    With ``replaced`` these folders below get the new files and nothing else, all of them at once when every file is written; a
    job that fails leaves them as they were.  Without it files are added, and those of a job that fails are removed."""
    twice = [r["path"] for r in rows.groupBy("path").count().where("count > 1").limit(3).collect()]
    if twice:
        raise ValueError(f"several files of one path: {twice}")
    recover(folder)
    rows.sparkSession.dataSource.register(Files)
    out = rows.select("path", F.col("content").cast("binary").alias("content")).write.format("named_files")
    (out.option("replaced", ",".join(replaced)) if replaced else out).mode("append").save(folder)
