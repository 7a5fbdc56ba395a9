"""A run of several steps that can go on where it stopped.

Each finished step leaves a small file in the run's ledger folder: what it
returned, and what its inputs were (how many files, and a hash of their names,
sizes and times).  A second run over the same folder skips a step if the file
is there, its inputs are what they were and no earlier step has run again;
every other step runs.  Steps write their tables with overwrite or commit whole
seasons, so one that stopped half way is simply run again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from varzea.sources import storage


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, resume: bool = True):
        self.spark, self.folder, self.resume = spark, folder.rstrip("/"), resume
        self.again = False
        self.ran: list[str] = []
        self.skipped: list[str] = []

    def step(self, name: str, run: Callable[[], object], inputs: list[str] = ()):
        """``run()``, or what it returned the last time.  Results must be JSON values."""
        path = f"{self.folder}/{name}.json"
        seen = storage.listing(self.spark, list(inputs))
        if self.resume and not self.again:
            done = json.loads(storage.read_text(self.spark, path) or "null")
            if done and done["inputs"] == seen:
                self.skipped.append(name)
                return done["result"]
        self.again = True
        storage.delete(self.spark, path)
        result = run()
        storage.write_text(self.spark, path, json.dumps({"inputs": seen, "result": result}))
        self.ran.append(name)
        return result
