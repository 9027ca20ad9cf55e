"""What a checkpoint keeps beside Spark's own files: records of every batch, plans of bounded runs.

Entries are files that are made once (create-if-absent): a batch or run that is done again finds
its entry and changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from eventweave.sinks.snapshots import create_if_absent, folder_exists, names_in, read_text, remove_folder

LEDGER, PLANS = "eventweave_batches", "eventweave_runs"
#: Entries that are kept; totals are carried on.
KEEP = 50

Position = Mapping[tuple[str, int], int]


class BatchLedger:
    """Records of every batch and of all batches so far."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in names_in(self.spark, self.path) if n.endswith(".json"))

    def _entry(self, batch_id: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/{batch_id:020d}.json"))

    def record(self, batch_id: int, records: int) -> None:
        """The first entry of a batch stands."""
        numbers = self._numbers()
        before = max((n for n in numbers if n < batch_id), default=None)
        total = records + (self._entry(before)["total"] if before is not None else 0)
        if create_if_absent(self.spark, f"{self.path}/{batch_id:020d}.json", json.dumps({"records": records, "total": total})):
            for n in numbers[:-KEEP]:
                remove_folder(self.spark, f"{self.path}/{n:020d}.json")

    def records(self, batch_id: int) -> int:
        return self._entry(batch_id)["records"]

    def total(self) -> int:
        """Records of all batches, each once."""
        numbers = self._numbers()
        return self._entry(numbers[-1])["total"] if numbers else 0


@dataclass(frozen=True)
class RunPlan:
    """Offsets of one bounded run: above ``after``, up to ``until``, by topic and partition."""
    number: int
    after: Position
    until: Position


class RunPlans:
    """Plans of the bounded runs of a checkpoint; a plan stands until it is closed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in names_in(self.spark, self.path) if n.endswith(".plan"))

    def _plan(self, number: int) -> RunPlan:
        d = json.loads(read_text(self.spark, f"{self.path}/{number:020d}.plan"))
        return RunPlan(number, *({(t, p): o for t, p, o in d[k]} for k in ("after", "until")))

    def open(self) -> RunPlan | None:
        """The last plan if its run did not end."""
        numbers = self._numbers()
        if not numbers or folder_exists(self.spark, f"{self.path}/{numbers[-1]:020d}.done"):
            return None
        return self._plan(numbers[-1])

    def ends(self) -> Position:
        """Where the last run ended."""
        numbers = self._numbers()
        return self._plan(numbers[-1]).until if numbers else {}

    def add(self, after: Position, until: Position) -> RunPlan:
        """A new plan; of two drivers that plan the same run the first one's stands."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        text = json.dumps({k: [[t, p, o] for (t, p), o in v.items()] for k, v in (("after", after), ("until", until))})
        create_if_absent(self.spark, f"{self.path}/{number:020d}.plan", text)
        for n in numbers[:-KEEP]:
            for end in ("plan", "done"):
                remove_folder(self.spark, f"{self.path}/{n:020d}.{end}")
        return self._plan(number)

    def close(self, plan: RunPlan) -> None:
        create_if_absent(self.spark, f"{self.path}/{plan.number:020d}.done", "")
