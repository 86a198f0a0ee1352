"""Documents to a store in batches, all or nothing: a data source with commit and abort, and its progress document.

A task gives its rows to the store in batches of a bounded size, under ids made of the job, the task and the batch's number.
They are staged: nobody sees them. Only when all tasks have ended does the driver publish the batches of the attempts that
counted, and, last, the progress document. A task that runs again stages its batches again under the same ids; a job that
fails leaves nothing behind but what `abort` throws away.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

LARGEST = 500


class Store(Protocol):
    """What a store has to do; it goes to the tasks, so it must be picklable."""

    def stage(self, job: str, batch: str, attempt: str, documents: list[dict]) -> None: ...

    def publish(self, job: str, batches: list[tuple[str, str]], progress: dict) -> None:
        """Makes those (batch, attempt) seen, then the progress document; the same job again changes nothing."""
        ...

    def discard(self, job: str) -> None: ...


@dataclass
class Staged(WriterCommitMessage):
    batches: list[tuple[str, str]]
    documents: int
    sums: dict[str, int]


class BatchWriter(DataSourceWriter):
    def __init__(self, store: Store, job: str, size: int, count_by: str | None, add_up: str | None) -> None:
        self.store, self.job, self.size, self.count_by, self.add_up = store, job, size, count_by, add_up

    def write(self, iterator: Iterator[Row]) -> Staged:
        task = TaskContext.get()
        attempt = str(task.taskAttemptId())
        out, held, sums = Staged([], 0, {}), [], {}

        def give() -> None:
            batch = f"{task.partitionId():06d}-{len(out.batches):06d}"
            self.store.stage(self.job, batch, attempt, held)
            out.batches.append((batch, attempt))

        for row in iterator:
            doc = row.asDict(recursive=True)
            held.append(doc)
            out.documents += 1
            if self.count_by:
                key = str(doc.get(self.count_by)).lower()
                sums[key] = sums.get(key, 0) + 1
            if self.add_up:
                sums[f"total {self.add_up}"] = sums.get(f"total {self.add_up}", 0) + (doc.get(self.add_up) or 0)
            if len(held) == self.size:
                give()
                held = []
        if held:
            give()
        out.sums = sums
        return out

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        progress: dict = {"job": self.job, "documents": sum(m.documents for m in done), "batches": sum(len(m.batches) for m in done), "done": 0}
        for m in done:
            for k, v in m.sums.items():
                progress[k] = progress.get(k, 0) + v
        self.store.publish(self.job, [b for m in done for b in m.batches], progress)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.store.discard(self.job)


def write_documents(df: DataFrame, store: Store, job: str | None = None, size: int = LARGEST, count_by: str | None = None, add_up: str | None = None) -> str:
    """Writes the rows of df as documents in batches of at most `size`; returns the job's name. A job that was published isn't written twice.

    The progress document has the number of documents and batches, of documents by `count_by`, and the sum of `add_up`.
    """
    if not 0 < size <= LARGEST:
        raise ValueError(f"a batch holds 1 to {LARGEST} documents")
    job = job or uuid.uuid4().hex
    name = f"rosterloom_batches_{uuid.uuid4().hex}"

    class Batches(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            return BatchWriter(store, job, size, count_by, add_up)

    df.sparkSession.dataSource.register(Batches)
    df.write.format(name).mode("append").save()
    return job


@dataclass
class FolderStore:
    """A store in a folder that all machines mount: a file of JSON lines for each batch, and a progress document for each job."""

    root: str

    def _staged(self, job: str) -> str:
        return f"{self.root}/_staged/{job}"

    def stage(self, job: str, batch: str, attempt: str, documents: list[dict]) -> None:
        os.makedirs(self._staged(job), exist_ok=True)
        path = f"{self._staged(job)}/{batch}.{attempt}"
        with open(f"{path}.tmp", "w", encoding="utf-8") as f:
            for d in documents:
                f.write(json.dumps(d, ensure_ascii=False, default=str) + "\n")
        os.replace(f"{path}.tmp", path)

    def published(self, job: str) -> bool:
        return os.path.exists(f"{self.root}/_progress/{job}.json")

    def publish(self, job: str, batches: list[tuple[str, str]], progress: dict) -> None:
        if not self.published(job):
            os.makedirs(f"{self.root}/_progress", exist_ok=True)
            for batch, attempt in batches:  # by name, so that a publication which broke off goes on
                here, there = f"{self._staged(job)}/{batch}.{attempt}", f"{self.root}/{job}-{batch}.jsonl"
                if os.path.exists(here):
                    os.replace(here, there)
            with open(f"{self.root}/_progress/{job}.tmp", "w", encoding="utf-8") as f:
                json.dump(progress, f)
            os.replace(f"{self.root}/_progress/{job}.tmp", f"{self.root}/_progress/{job}.json")
        self.discard(job)

    def discard(self, job: str) -> None:
        shutil.rmtree(self._staged(job), ignore_errors=True)

    def progress(self, job: str) -> dict:
        with open(f"{self.root}/_progress/{job}.json", encoding="utf-8") as f:
            return json.load(f)

    def clear(self) -> int:
        """Deletes all documents that are seen, and the progress documents; how many batches there were."""
        there = [n for n in os.listdir(self.root) if n.endswith(".jsonl")] if os.path.isdir(self.root) else []
        shutil.rmtree(f"{self.root}/_progress", ignore_errors=True)
        for n in there:
            os.remove(f"{self.root}/{n}")
        return len(there)
