"""K7 as a sink: update requests go to a receiver and into a journal, with commit and
abort, from a batch or a stream.

Each task sends its requests (with `sender`, a plug-in named `module:function` that
takes a list of requests and returns one flag each) and writes those accepted to a
file of its own in a staging folder. Only the file's name goes to the driver. When all
tasks have succeeded the files are renamed into the journal; a task that was repeated
leaves a file that no message names, which is removed with the staging folder. After
a failure nothing of the attempt is in the journal; requests are sets, so what a
receiver got twice does no harm. A stream's files carry the batch id, and a replayed
batch replaces its own.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quadrant.sources.files import executor_filesystem

SCHEMA = "bucket long, batch long, n_quads long, request string"
#: Requests that a sender gets at a time.
SEND = 50


class RefusedError(RuntimeError):
    """The receiver did not take a request."""


@dataclass
class Staged(WriterCommitMessage):
    name: str | None


class _Delivery:
    def __init__(self, options: dict[str, str], attempt: str):
        self.path, self.sender, self.attempt = options["path"].rstrip("/"), options.get("sender"), attempt

    @property
    def staging(self) -> str:
        return f"{self.path}.staging/{self.attempt}"

    def write(self, iterator: Iterator[Row]) -> Staged:
        send = None
        if self.sender:
            module, name = self.sender.split(":")
            send = getattr(importlib.import_module(module), name)
        fs, root = executor_filesystem(self.staging)
        fs.create_dir(root, recursive=True)
        name, out, wait = f"{uuid.uuid4().hex}.json", None, []

        def flush() -> None:
            nonlocal out
            if send and not all(send([r["request"] for r in wait])):
                raise RefusedError(f"refused a request of bucket {wait[0]['bucket']}")
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}")
            out.write("".join(json.dumps(r) + "\n" for r in wait).encode())
            wait.clear()
        for row in iterator:
            wait.append({"bucket": row.bucket, "batch": row.batch, "n_quads": row.n_quads, "request": row.request})
            if len(wait) == SEND:
                flush()
        if wait:
            flush()
        if out is None:
            return Staged(None)
        out.close()
        return Staged(name)

    def _drop(self) -> None:
        fs, root = executor_filesystem(self.staging)
        if fs.get_file_info(root).type.name == "Directory":
            fs.delete_dir(root)

    def publish(self, messages: list[Staged | None], prefix: str) -> None:
        fs, root = executor_filesystem(self.staging)
        _, journal = executor_filesystem(self.path)
        fs.create_dir(journal, recursive=True)
        for m in messages:
            if m is not None and m.name and fs.get_file_info(f"{root}/{m.name}").is_file:
                fs.move(f"{root}/{m.name}", f"{journal}/{prefix}{m.name}")
        self._drop()


class DeliveryWriter(_Delivery, DataSourceWriter):
    def commit(self, messages: list[Staged | None]) -> None:
        self.publish(messages, "")

    def abort(self, messages: list[Staged | None]) -> None:
        self._drop()


class DeliveryStreamWriter(_Delivery, DataSourceStreamWriter):
    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        from pyarrow.fs import FileSelector
        fs, journal = executor_filesystem(self.path)
        prefix = f"batch-{batchId:010d}-"
        for info in fs.get_file_info(FileSelector(journal, allow_not_found=True)):  # what a replayed batch left
            if info.base_name.startswith(prefix):
                fs.delete_file(info.path)
        self.publish(messages, prefix)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._drop()


class QuadDelivery(DataSource):
    """Options: path (the journal's folder), sender (`module:function`, none: journal only)."""

    @classmethod
    def name(cls) -> str:
        return "quad_delivery"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a journal is appended to")
        return DeliveryWriter(dict(self.options), uuid.uuid4().hex)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        # made anew for the tasks and for the commit, and a stream has one batch at a time: a fixed staging folder
        return DeliveryStreamWriter(dict(self.options), "stream")
