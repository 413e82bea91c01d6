"""Changes of whole hours of a table that survive a job that dies half way.

A change is first written to a staging folder beside the table, laid out like it, and noted in the
table's journal. ``staging``: the folder may be incomplete, so the table is still as it was.
``staged``: the folder is complete, and each of its hours takes the place of the table's own, by
renaming. Whoever uses the table next finishes a staged change, and discards one that was not, unless it
may be resumed. One job at a time may change a table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.sources.folders import Folders, in_parallel

JOURNAL = "_journal"
STAGING = "_staging"
BUILT = "_built"
LAYER = "_layer"


@dataclass
class Change:
    """One change under way; ``note`` is what the table is marked with once it is done."""

    spark: SparkSession
    root: str
    name: str
    resumable: bool = False
    plan: dict = field(default_factory=dict)
    note: dict = field(default_factory=dict)
    state: str = "staging"

    @property
    def staging(self) -> str:
        """Where the hours are staged."""
        return self.beside("hours")

    def beside(self, name: str) -> str:
        """A folder for something the change needs on the way, which goes when the change is done."""
        return f"{self.root}/{STAGING}/{self.name}/{name}"

    def save(self) -> None:
        Folders(self.spark, self.root).write_json(
            f"{JOURNAL}/{self.name}",
            {"state": self.state, "resumable": self.resumable, "plan": self.plan, "note": self.note},
        )

    def stage(self) -> None:
        """The staging folder is complete: from now on the change will happen."""
        self.state = "staged"
        self.save()

    def finish(self) -> None:
        """Swap the hours. May be repeated: an hour that is no longer staged has its place already."""
        table, staged = Folders(self.spark, self.root), Folders(self.spark, self.staging)
        in_parallel(lambda hour: table.move_here(staged, hour), staged.hours(whole=True))
        for name, value in self.note.items():
            table.write_json(name, value)
        self.drop()

    def drop(self) -> None:
        table = Folders(self.spark, self.root)
        table.delete(f"{JOURNAL}/{self.name}")
        table.delete(f"{STAGING}/{self.name}")


def begin(
    spark: SparkSession, root: str, kind: str, plan: dict | None = None, note: dict | None = None, resumable: bool = False
) -> Change:
    """Note a change of the table at ``root`` that is about to be staged."""
    root = root.rstrip("/")
    change = Change(spark, root, f"{kind}-{uuid.uuid4().hex}", resumable, plan or {}, note or {})
    change.save()
    return change


def unfinished(spark: SparkSession, root: str) -> list[Change]:
    root = root.rstrip("/")
    folders = Folders(spark, root)
    found = []
    for name in folders.names(JOURNAL):
        entry = None if name.startswith(".") else folders.read_json(f"{JOURNAL}/{name}")
        if entry is not None:
            found.append(Change(spark, root, name, entry["resumable"], entry["plan"], entry["note"], entry["state"]))
    return found


def recover(spark: SparkSession, root: str) -> list[Change]:
    """Finish staged changes of a table, discard others, and return those that wait to be resumed."""
    waiting = []
    for change in unfinished(spark, root):
        if change.state == "staged":
            change.finish()
        elif change.resumable:
            waiting.append(change)
        else:
            change.drop()
    return waiting


def read_marker(spark: SparkSession, root: str) -> T.StructType | None:
    """The schema of a table whose build has been finished; None for any other folder."""
    found = Folders(spark, root).read_json(BUILT)
    return None if found is None else T.StructType.fromJson(found)


def write_marker(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Note that a table is built. Overwriting a table as a whole takes the marker away again."""
    Folders(spark, root).write_json(BUILT, schema.jsonValue())
