"""Document sinks K1 and K2 as a Spark data source.

``df.write.format(FORMAT)`` and ``df.writeStream.format(FORMAT)`` write either
strategy below ``path``:

* ``folder_per_domain`` rows ``(rel, content, url, size)``: one file a row; the
  last row of a ``rel`` wins (batches, then tasks, then rows, in their order);
* ``file_per_domain`` rows ``(domain, offset, block, url, size)``: every block
  is written at its byte offset of ``<domain>.md``, so any number of tasks fill
  one document side by side (folders only, see :func:`can_place`);
* ``file_per_domain`` rows ``(domain, url, content, size)``: pages follow each
  other in the order of arrival; a micro-batch adds to ``<domain>.md``.

A batch job replaces the documents it names; mode ``overwrite`` removes all others.

Tasks write below ``_staging/<run>`` and send one small message each: the name
of the manifest they wrote there.  A commit is first a journal in ``_commits``
that names these manifests, then the moves, then a ``.done`` mark.  What has no
journal was never there; a journal without its mark is carried on by the next
commit of the same id or by :func:`recover`, and moves that were made are
passed over.  A batch id that is marked done is not written again, so a
replayed micro-batch changes nothing (one streaming query a folder, as with
Spark's file sink).  An aborted job removes its staging folder.

The moves run in the commit, ``MOVERS`` at a time, one for a document: text
passes through it only for appended pages of one micro-batch.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from docweave.constants import DOMAIN_PAGE_HEADER, DOMAIN_PAGE_SEPARATOR, MARKDOWN_EXTENSION, PERSISTENCE_STRATEGIES

FORMAT = "docweave_documents"
MOVERS = 16
COPY_BYTES = 1 << 20

#: Kinds of rows a sink takes, by their columns.
FILES, PLACED, APPENDED = "files", "placed", "appended"
_COLUMNS = {
    ("folder_per_domain", FILES): {"rel", "content", "url", "size"},
    ("file_per_domain", PLACED): {"domain", "offset", "block", "url", "size"},
    ("file_per_domain", APPENDED): {"domain", "url", "content", "size"},
}
#: One row a document and task: where its bytes are staged, and what they hold.
MANIFEST = pa.schema([("rel", pa.string()), ("staged", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                      ("url", pa.string()), ("pages", pa.int64()), ("size", pa.int64())])


def check_strategy(name: str) -> str:
    """K5: only the two sink names are accepted (checked before any job)."""
    if name not in PERSISTENCE_STRATEGIES:
        raise ValueError(f"Unsupported persistence strategy: {name}")
    return name


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and base path of a URI (``hdfs://``, ``s3://``, ``file:/``,
    ...) or of a plain folder, which has to be mounted on every machine."""
    if re.match(r"file:/+", path):
        path = "/" + re.sub(r"^file:/+", "", path)
    if "://" in path:
        fs, base = pafs.FileSystem.from_uri(path)
        return fs, base.rstrip("/")
    return pafs.LocalFileSystem(), path.rstrip("/")


def can_place(path: str) -> bool:
    """Does the store write at offsets of one file?  Folders do, object stores and HDFS don't."""
    return isinstance(store(path)[0], pafs.LocalFileSystem)


@dataclass
class TaskWritten(WriterCommitMessage):
    """A task's manifest, by its name in the staging folder of the run (a commit
    of a stream is called in another process than the tasks, on another writer)."""

    run: str
    manifest: str


class Layout:
    """The folders of a sink and the steps of a commit."""

    def __init__(self, path: str):
        self.path = path
        self.fs, self.base = store(path)

    def at(self, *names: str) -> str:
        return posixpath.join(self.base, *names)

    def staging(self, run: str, *names: str) -> str:
        return self.at("_staging", run, *names)

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(path).type != pafs.FileType.NotFound

    def size(self, path: str) -> int:
        info = self.fs.get_file_info(path)
        return info.size if info.type == pafs.FileType.File else 0

    def put(self, path: str, text: str) -> None:
        """A small file that appears whole or not at all."""
        self.fs.create_dir(posixpath.dirname(path), recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(part) as out:
            out.write(text.encode("utf-8"))
        self.fs.move(part, path)

    def get(self, path: str) -> str:
        with self.fs.open_input_stream(path) as f:
            return f.read().decode("utf-8")

    def manifest_rows(self, path: str) -> Iterator[list[dict]]:
        with self.fs.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches():
                yield batch.to_pylist()

    def drop(self, run: str) -> None:
        if self.exists(self.staging(run)):
            self.fs.delete_dir(self.staging(run))

    # ------------------------------------------------------------ commit

    def commit(self, plan: dict, manifests: list[str]) -> None:
        """Journal, moves, mark.  An id that has a journal is carried on with what that names."""
        journal, done, run = self.at("_commits", f"{plan['id']}.json"), self.at("_commits", f"{plan['id']}.done"), plan["run"]
        if not self.exists(journal):
            plan = plan | {"manifests": sorted(manifests)}
            if plan["kind"] == APPENDED:
                plan["bases"] = self.bases(run, manifests, plan["replace"])
            self.put(journal, json.dumps(plan))
        plan = json.loads(self.get(journal))
        if not self.exists(done):
            self.publish(plan)
            self.put(done, "")
        self.drop(plan["run"])
        self.drop(run)

    def bases(self, run: str, manifests: list[str], replace: bool) -> dict[str, int]:
        """Bytes of every touched domain document that stay before the new ones."""
        names = {r["rel"] for m in manifests for rows in self.manifest_rows(self.staging(run, "manifests", m)) for r in rows}
        return {n: 0 if replace else self.size(self.at(n)) for n in names}

    def publish(self, plan: dict) -> None:
        run, kept = plan["run"], self.at("_manifest", plan["id"])
        cleared = self.staging(run, "cleared")
        if plan["overwrite"] and not self.exists(cleared):
            self.clear()
            self.put(cleared, "")
        with ThreadPoolExecutor(MOVERS) as pool:
            if plan["kind"] == APPENDED:
                self.append(plan, pool)
            else:
                for name in plan["manifests"]:
                    for rows in self.manifest_rows(self.staging(run, "manifests", name)):
                        lanes: list[list[dict]] = [[] for _ in range(MOVERS)]
                        for r in rows:
                            lanes[hash(r["rel"]) % MOVERS].append(r)  # rows of one document stay in order
                        list(pool.map(lambda lane: [self.move(run, r) for r in lane], lanes))
        self.fs.create_dir(kept, recursive=True)
        for name in plan["manifests"]:
            self.fs.copy_file(self.staging(run, "manifests", name), posixpath.join(kept, name))

    def move(self, run: str, row: dict) -> None:
        staged, final = self.staging(run, "files", row["staged"]), self.at(row["rel"])
        if self.exists(staged):  # else an earlier try of this commit moved it
            self.fs.create_dir(posixpath.dirname(final), recursive=True)
            self.fs.move(staged, final)

    def append(self, plan: dict, pool: ThreadPoolExecutor) -> None:
        run, bases = plan["run"], plan["bases"]
        for lane in range(0, len(bases), 1024):  # documents of one pass over the manifests
            names = sorted(bases)[lane:lane + 1024]
            parts: dict[str, list[dict]] = {n: [] for n in names}
            for m in plan["manifests"]:
                for rows in self.manifest_rows(self.staging(run, "manifests", m)):
                    for r in rows:
                        if r["rel"] in parts:
                            parts[r["rel"]].append(r)
            list(pool.map(lambda n: self.append_parts(run, n, bases[n], parts[n]), names))

    def append_parts(self, run: str, rel: str, base: int, parts: list[dict]) -> None:
        final = self.at(rel)
        if self.size(final) > base > 0:  # a try that was cut off: back to the bytes before it
            with self.fs.open_input_stream(final) as old, self.fs.open_output_stream(f"{final}.tmp") as out:
                self.copy(old, out, base)
            self.fs.move(f"{final}.tmp", final)
        self.fs.create_dir(posixpath.dirname(final), recursive=True)
        with (self.fs.open_append_stream(final) if base else self.fs.open_output_stream(final)) as out:
            for i, p in enumerate(parts):
                if base or i:
                    out.write(DOMAIN_PAGE_SEPARATOR.encode())
                with self.fs.open_input_file(self.staging(run, "files", p["staged"])) as f:
                    f.seek(p["start"])
                    self.copy(f, out, p["length"])

    @staticmethod
    def copy(source, target, length: int) -> None:
        while length and (data := source.read(min(COPY_BYTES, length))):
            target.write(data)
            length -= len(data)

    def clear(self) -> None:
        """All documents go; journals and manifests stay as history."""
        for info in self.fs.get_file_info(pafs.FileSelector(self.base, allow_not_found=True)):
            if not info.base_name.startswith("_"):
                (self.fs.delete_dir if info.type == pafs.FileType.Directory else self.fs.delete_file)(info.path)


class _Writer:
    """What the batch and the stream writer share; sent to the tasks."""

    def __init__(self, options, schema, overwrite: bool):
        self.path, strategy = options["path"], check_strategy(options.get("strategy", ""))
        have = set(schema.names)
        kinds = [k for (s, k), need in _COLUMNS.items() if s == strategy and need <= have]
        if not kinds:
            wanted = " or ".join(str(sorted(c)) for (s, _), c in _COLUMNS.items() if s == strategy)
            raise ValueError(f"{strategy} takes rows with {wanted}, not {sorted(have)}")
        self.kind, self.overwrite, self.run = kinds[0], overwrite, options.get("run", uuid.uuid4().hex)
        if self.kind == PLACED and not can_place(self.path):
            raise ValueError(f"this store can't write at offsets: {self.path}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskWritten:
        layout, context = Layout(self.path), TaskContext.get()
        name = f"{context.partitionId() if context else 0:09d}-{uuid.uuid4().hex}"  # a second attempt has its own names
        for folder in ("files", "manifests"):
            layout.fs.create_dir(layout.staging(self.run, folder), recursive=True)
        rows = {FILES: self.files, PLACED: self.placed, APPENDED: self.appended}[self.kind](layout, name, iterator)
        manifest = f"{name}.parquet"
        with layout.fs.open_output_stream(layout.staging(self.run, "manifests", manifest)) as out, pq.ParquetWriter(out, MANIFEST) as table:
            for chunk in rows:
                table.write_table(pa.Table.from_pylist(chunk, schema=MANIFEST))
        return TaskWritten(self.run, manifest)

    def files(self, layout: Layout, name: str, batches) -> Iterator[list[dict]]:
        n = 0
        folder = layout.staging(self.run, "files", name)
        layout.fs.create_dir(folder, recursive=True)
        for batch in batches:
            done = []
            for r in batch.select(["rel", "content", "url", "size"]).to_pylist():
                data = r["content"].encode("utf-8")
                with layout.fs.open_output_stream(f"{folder}/{n}") as out:
                    out.write(data)
                done.append({"rel": r["rel"], "staged": f"{name}/{n}", "start": 0, "length": len(data), "url": r["url"], "pages": 1, "size": r["size"]})
                n += 1
            yield done

    def placed(self, layout: Layout, name: str, batches) -> Iterator[list[dict]]:
        now, file = None, -1
        try:
            for batch in batches:
                done: dict[str, dict] = {}
                for r in batch.select(["domain", "offset", "block", "url", "size"]).to_pylist():
                    rel = r["domain"] + MARKDOWN_EXTENSION
                    if rel != now:
                        if now is not None:
                            os.close(file)
                        now, file = rel, os.open(layout.staging(self.run, "files", rel), os.O_WRONLY | os.O_CREAT, 0o644)
                    data, at = r["block"].encode("utf-8"), r["offset"]
                    own = done.setdefault(rel, {"rel": rel, "staged": rel, "start": at, "length": 0, "url": r["url"], "pages": 0, "size": 0})
                    own["length"] += len(data)
                    own["pages"] += 1
                    own["size"] += r["size"]
                    while data:
                        n = os.pwrite(file, data, at)
                        data, at = data[n:], at + n
                yield list(done.values())
        finally:
            if now is not None:
                os.close(file)

    def appended(self, layout: Layout, name: str, batches) -> Iterator[list[dict]]:
        start = 0
        with layout.fs.open_output_stream(layout.staging(self.run, "files", name)) as out:
            for batch in batches:
                pages: dict[str, list[dict]] = {}
                for r in batch.select(["domain", "url", "content", "size"]).to_pylist():
                    pages.setdefault(r["domain"], []).append(r)
                done = []
                for domain, own in pages.items():
                    data = DOMAIN_PAGE_SEPARATOR.join(DOMAIN_PAGE_HEADER.format(url=r["url"]) + r["content"] for r in own).encode("utf-8")
                    out.write(data)
                    done.append({"rel": domain + MARKDOWN_EXTENSION, "staged": name, "start": start, "length": len(data),
                                 "url": own[0]["url"], "pages": len(own), "size": sum(r["size"] for r in own)})
                    start += len(data)
                yield done

    def finish(self, commit_id: str, messages, replace: bool) -> None:
        written = [m for m in messages if m]
        run = written[0].run if written else self.run
        plan = {"id": commit_id, "run": run, "kind": self.kind, "overwrite": self.overwrite, "replace": replace}
        Layout(self.path).commit(plan, [m.manifest for m in written])

    def give_up(self, messages) -> None:
        for run in {self.run, *(m.run for m in messages if m)}:
            Layout(self.path).drop(run)


class DocumentWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.finish(f"{time.time_ns():020d}-{self.run}", messages, replace=True)

    def abort(self, messages) -> None:
        self.give_up(messages)


class DocumentStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.finish(f"batch-{batchId:012d}", messages, replace=False)

    def abort(self, messages, batchId: int) -> None:
        self.give_up(messages)


class DocumentSource(DataSource):
    """``spark.dataSource.register(DocumentSource)`` makes :data:`FORMAT` known to a session."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options, schema, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> DocumentStreamWriter:
        return DocumentStreamWriter(self.options, schema, overwrite)


def recover(path: str) -> int:
    """Carry on commits that were cut off after their journal; returns how many."""
    layout, n = Layout(path), 0
    for info in sorted(layout.fs.get_file_info(pafs.FileSelector(layout.at("_commits"), allow_not_found=True)), key=lambda i: i.path):
        if info.path.endswith(".json") and not layout.exists(f"{info.path[:-5]}.done"):
            plan = json.loads(layout.get(info.path))
            layout.commit(plan, plan["manifests"])
            n += 1
    return n


def manifest(spark: SparkSession, path: str, run: str = "") -> DataFrame:
    """``(commit, rel, url, pages, size)`` of the done commits of a sink, or of one
    run; the names of the commits come to the driver, their rows do not."""
    layout = Layout(path)
    infos = layout.fs.get_file_info(pafs.FileSelector(layout.at("_commits"), allow_not_found=True))
    done = sorted(posixpath.basename(i.path)[:-5] for i in infos if i.path.endswith(f"{run}.done"))
    schema = "rel string, staged string, start long, length long, url string, pages long, size long"
    folders = [f"{path.rstrip('/')}/_manifest/{c}" for c in done]
    if not folders:
        return spark.createDataFrame([], "commit string, rel string, url string, pages long, size long")
    commit = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.schema(schema).parquet(*folders).select(commit.alias("commit"), "rel", "url", "pages", "size")


def written(spark: SparkSession, path: str) -> DataFrame:
    """``(rel, content)``: the documents of a sink, read back."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=f"*{MARKDOWN_EXTENSION}").load(path)
    rel = F.substring_index("path", f"{posixpath.basename(path.rstrip('/'))}/", -1)
    return files.select(rel.alias("rel"), F.decode("content", "UTF-8").alias("content"))
