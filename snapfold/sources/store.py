"""An append-only store of revisions, as a sink.

    <root>/<source>/<start_date>_<end_date>/<sha256>[_<occurrence>]/response.json and manifest.json

A body that equals the newest stored one of its export (source, dates, url) is reused: nothing is written. Any other is a new
revision, a return to an older body too. Tasks compare and stage, the driver only renames what was staged once every task has
ended well; a manifest is moved last, so a folder without one is known to be incomplete. A job that fails leaves nothing that a reader
sees; what tasks stage that are stopped after their job was given up goes with a later write, once it is ``STALE``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..session import importable
from .inflate import located

EXPORT = ["source", "start_date", "end_date", "url"]
SCHEMA = "source string, start_date string, end_date string, url string, fetched_at string, body string"
BODY, MANIFEST = "response.json", "manifest.json"
STALE = timedelta(days=1)


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: (staged folder, folder of the export, digest), in order, and how many bodies it found stored already."""

    folders: list[tuple[str, str, str]] = field(default_factory=list)
    reused: int = 0


class RevisionStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "revisions"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("the store of revisions is append-only")
        if missing := set(EXPORT + ["fetched_at", "body"]) - set(schema.names):
            raise ValueError(f"a revision needs {sorted(missing)}")
        return RevisionWriter(self.options["path"])


class RevisionWriter(DataSourceWriter):
    def __init__(self, root: str) -> None:
        self.root, self.job = root, uuid.uuid4().hex

    def _place(self) -> tuple[fs.FileSystem, str, str]:
        """The store, the root in it, and where this job stages."""
        store, root, _ = located(self.root)
        root = root.rstrip("/")
        return store, root, f"{root}/_staging/{self.job}"

    def write(self, rows: Iterator[Row]) -> Staged:
        store, root, staging = self._place()
        out, attempt = Staged(), uuid.uuid4().hex
        now, newest = None, None
        for row in rows:
            r = row.asDict()
            body = (r.pop("body") or "").encode()
            export = tuple(r[c] for c in EXPORT)
            if any(x is None or "/" in x for x in export[:3]) or r["fetched_at"] is None:
                raise ValueError(f"no export: {export}")
            parent = f"{root}/{export[0]}/{export[1]}_{export[2]}"
            if export != now:
                now, newest = export, _newest(store, parent, export[3])
            digest = hashlib.sha256(body).hexdigest()
            if newest and newest[0] == digest:
                if newest[1] and _read(store, f"{newest[1]}/{BODY}") != body:
                    raise ValueError(f"hash collision or damaged payload: {newest[1]}")
                out.reused += 1
                continue
            json.loads(body)  # what isn't JSON is no response
            folder = f"{staging}/{attempt}/{len(out.folders)}"  # deeper than readers look
            store.create_dir(folder)
            for name, content in ((BODY, body), (MANIFEST, json.dumps({**r, "sha256": digest}, indent=2, default=str).encode())):
                with store.open_output_stream(f"{folder}/{name}") as f:
                    f.write(content)
            out.folders.append((folder, parent, digest))
            newest = (digest, None)
        return out

    def commit(self, messages: list[Staged | None]) -> None:
        store, _, _ = self._place()
        done = []
        try:
            for folder, parent, digest in (f for m in messages if m for f in m.folders):
                target, occurrence = f"{parent}/{digest}", 1
                while store.get_file_info(target).type != fs.FileType.NotFound:
                    occurrence += 1
                    target = f"{parent}/{digest}_{occurrence:06d}"
                store.create_dir(target)
                done.append(target)
                for name in (BODY, MANIFEST):
                    store.move(f"{folder}/{name}", f"{target}/{name}")
        except BaseException:
            for target in done:
                store.delete_dir(target)
            raise
        finally:
            self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Also what attempts have staged that failed or came second, and what older jobs have left."""
        store, root, staging = self._place()
        left = []
        for x in store.get_file_info(fs.FileSelector(f"{root}/_staging", allow_not_found=True)):
            old = x.mtime is not None and datetime.now(timezone.utc) - x.mtime > STALE
            if x.path == staging or old:
                store.delete_dir(x.path)
            else:
                left.append(x)
        if not left and store.get_file_info(f"{root}/_staging").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_staging")


def _read(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()


def _newest(store: fs.FileSystem, parent: str, url: str) -> tuple[str, str] | None:
    """Digest and folder of the newest stored revision of an export."""
    found = []
    for x in store.get_file_info(fs.FileSelector(parent, allow_not_found=True)):
        if x.type != fs.FileType.Directory:
            continue
        if store.get_file_info(f"{x.path}/{MANIFEST}").type != fs.FileType.File:
            raise ValueError(f"incomplete revision: {x.path}; inspect it before the next write")
        told = json.loads(_read(store, f"{x.path}/{MANIFEST}"))
        if told["url"] == url:
            found.append((told["fetched_at"], x.path, told["sha256"]))
    _, path, digest = max(found, default=(None, None, None))
    return (digest, path) if path else None


def append(rows: DataFrame, root: str) -> None:
    """Adds bodies to the store, of each export in order of ``fetched_at``; further columns go to the manifests.

    An export's bodies are compared one after another by one task, which holds one of them; jobs that write the same export at
    the same time must be kept apart by their scheduler.
    """
    importable(rows.sparkSession).dataSource.register(RevisionStore)
    dealt = rows.repartition(*EXPORT).sortWithinPartitions(*EXPORT, "fetched_at", F.sha2("body", 256))
    dealt.write.format("revisions").mode("append").save(root)
