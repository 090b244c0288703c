"""What a stream has committed to its folder, batch by batch, from the log that Spark's file sink keeps there.

The log has a file for each batch, named by its number, whose lines name the files that the batch added. Every so many batches a file ending
in `.compact` repeats all before it; the single ones may then be deleted. A batch can be told as long as a compact file at or before it and
all single ones since are there.
"""

import json
import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession

from strata.sources.files import Stored, found, read_text

FOLDER = "_spark_metadata"


@dataclass(frozen=True)
class SinkLog:
    """The log's files by batch number; `compact` are the numbers of those that hold all before them."""

    spark: SparkSession
    files: dict[int, Stored]
    compact: frozenset[int]

    def batches(self) -> dict[int, datetime]:
        """The batches that can be told, with the time of their commit."""
        return {n: f.at for n, f in sorted(self.files.items()) if self._needed(n) is not None}

    def _needed(self, number: int) -> list[int] | None:
        """The log files that together name all files of batches 0 to `number`; None if one of them is gone."""
        start = max((c for c in self.compact if c <= number), default=0)
        needed = list(range(start, number + 1))
        return needed if needed and all(n in self.files for n in needed) else None

    def _entries(self, numbers: list[int]) -> dict[str, int]:
        """Path and size of the files that these log files name. They come to the driver, as for any reader of the folder."""
        out = {}
        for number in numbers:
            for line in read_text(self.spark, self.files[number].path).splitlines():
                entry = json.loads(line) if line.startswith("{") else {}
                if entry.get("action") == "add":
                    out[entry["path"]] = entry["size"]
        return out

    def entries(self, number: int) -> dict[str, int]:
        """Path and size of the files that batches 0 to `number` added."""
        needed = self._needed(number)
        if needed is None:
            raise ValueError(f"batch {number} is not in the log, or no longer")
        return self._entries(needed)

    def added(self, number: int) -> dict[str, int]:
        """Path and size of the files that batch `number` alone added."""
        if number not in self.files:
            raise ValueError(f"batch {number} is not in the log, or no longer")
        if number not in self.compact:
            return self._entries([number])
        before = self.entries(number - 1) if number else {}
        return {path: size for path, size in self._entries([number]).items() if path not in before}


def read_log(spark: SparkSession, folder: str) -> SinkLog:
    """The log of the stream that writes to `folder`; without batches if there is none."""
    files, compact = {}, set()
    for file in found(spark, f"{folder}/{FOLDER}/*"):
        name = re.fullmatch(r"(\d+)(\.compact)?", file.name)
        if name:
            files[int(name[1])] = file
            if name[2]:
                compact.add(int(name[1]))
    return SinkLog(spark, files, frozenset(compact))
