"""Pushes as a sink with receipts: each task sends its rows and notes what came of them.

A task takes its rows in groups.  A group's intent is written, the group is sent, then
its receipts are put in place in one move.  Many groups' receipts are then put together
in one file, and only after that the groups' own files go.  A task that is started again passes over
keys that have a receipt, so a lost worker repeats the open group at most; the job's
commit says that all rows were tried.  Receipts stay as files: no row and no key goes
through the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from . import files

#: Rows that a lost worker may send again.
GROUP = 20
#: Groups whose receipts are put together in one file, so that recording a tick reads few of them.
TOGETHER = 1_000
RETRIES, PAUSE_SECONDS = 3, 0.25
DEAD = ("BadDeviceToken", "Unregistered")
SENT, GONE, FAILED = "sent", "dead", "failed"


class SendError(Exception):
    """A push that the service refused."""

    def __init__(self, status: int, reason: str):
        super().__init__(status, reason)
        self.status, self.reason = status, reason


def send(sender, token: str, payload: dict, pause: float = PAUSE_SECONDS) -> None:
    """Up to three tries; a dead token or a refusal that trying again can't mend ends at once."""
    for attempt in range(1, RETRIES + 1):
        try:
            return sender.send(token, payload)
        except SendError as error:
            lasting = error.reason in DEAD or (400 <= error.status < 500 and error.status != 429)
            if lasting or attempt == RETRIES:
                raise
        except Exception:
            if attempt == RETRIES:
                raise
        time.sleep(pause * attempt)


@dataclass
class Tried(WriterCommitMessage):
    rows: int


class PushWriter(DataSourceWriter):
    """Rows (key, device, token, payload); rows of a device stand together, so after its token is found dead no more are tried."""

    def __init__(self, folder: str, sender, pause: float):
        self.folder, self.sender, self.pause = folder, sender, pause

    def _outcome(self, row: Row) -> str:
        try:
            send(self.sender, row["token"], json.loads(row["payload"]), self.pause)
        except SendError as error:
            return GONE if error.reason in DEAD else FAILED
        except Exception:  # one device's failure must not stop the others
            return FAILED
        return SENT

    def write(self, iterator: Iterator[Row]) -> Tried:
        context = TaskContext.get()
        name = f"p{context.partitionId():06d}"
        done = {json.loads(line)["key"] for path in files.listed(f"{self.folder}/receipts", f"{name}-") for line in files.read_text(path).splitlines()}
        dead, n, tried, whole = None, 0, 0, {}  # whole: receipts of groups whose files are to be put together
        todo = (row for row in iterator if row["key"] not in done)
        while group := list(islice(todo, GROUP)):
            stamp = f"{name}-{context.taskAttemptId()}-{n:06d}.json"
            files.put_text(f"{self.folder}/intents/{stamp}", "\n".join(json.dumps({"key": r["key"]}) for r in group))
            receipts = []
            for row in group:
                outcome = GONE if dead is not None and row["device"] == dead else self._outcome(row)
                dead = row["device"] if outcome == GONE else dead
                receipts.append(json.dumps({"key": row["key"], "outcome": outcome}))
            files.put_text(f"{self.folder}/receipts/{stamp}", "\n".join(receipts))
            whole[stamp] = receipts
            n, tried = n + 1, tried + len(group)
            if len(whole) == TOGETHER:
                whole = self._together(whole)
        self._together(whole)
        return Tried(tried)

    def _together(self, whole: dict[str, list[str]]) -> dict:
        """One file for the receipts of many groups; none left over."""
        if len(whole) > 1:
            last = list(whole)[-1]
            files.put_text(f"{self.folder}/receipts/{last.removesuffix('.json')}-all.json", "\n".join(line for lines in whole.values() for line in lines))
            for stamp in whole:
                files.remove(f"{self.folder}/receipts/{stamp}")
                files.remove(f"{self.folder}/intents/{stamp}")
        return {}

    def commit(self, messages: list) -> None:
        """All rows were tried: one number of rows a task."""
        files.put_text(f"{self.folder}/tried.json", json.dumps([m.rows for m in messages if m is not None]))

    def abort(self, messages: list) -> None:
        """What was sent stays noted; the next tick takes it up."""


def sink(sender: object, folder: str, pause: float) -> type[DataSource]:
    """A sink that sends by ``sender``, which travels with the tasks, and keeps its notes in ``folder``."""

    class Push(DataSource):
        @classmethod
        def name(cls) -> str:
            return "push"

        def schema(self) -> str:
            return "key string, device string, token string, payload string"

        def writer(self, schema, overwrite: bool) -> PushWriter:
            return PushWriter(folder, sender, pause)

    return Push

