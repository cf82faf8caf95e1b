"""Turns of runs that share a store: numbered claims, each given to one run only.

A run reads the claims there are, settles what it would save against silver and the keys of claims
not yet saved, and then takes the next number. That fails if another run was faster; its keys are then
compared, and only a run that shares an id with it settles anew. Nobody waits to settle; sinks are written one
run at a time in the order of the numbers, since appends to one folder cannot overlap.

``turns/<number>`` holds the name of the run, ``<number>.saved`` or ``<number>.failed`` beside it says how it
ended. A claim with neither counts as at work until its ``lease`` runs out. The folder has to be on
a file system whose rename does not replace a file (HDFS), or a local one; object stores without that
cannot serve concurrent runs.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

KEPT = 1000  # saved claims that stay for comparison; a run that missed more settles anew
POLL_SECONDS = 1.0

OPEN, SAVED, FAILED = "open", "saved", "failed"


@dataclass(frozen=True)
class Turn:
    number: int
    state: str
    at: float  # when the run took it or last said that it is at work


class Turns:
    """The claims in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._folder = spark._jvm, folder
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(""))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}" if name else self._folder)

    def listed(self) -> list[Turn]:
        """All claims that are kept, by number."""
        at: dict[int, float] = {}
        ends: dict[int, str] = {}
        for status in self._fs.listStatus(self._path("")):
            number, _, end = status.getPath().getName().partition(".")
            if not number:
                continue
            if end:
                ends[int(number)] = SAVED if SAVED in (end, ends.get(int(number))) else FAILED
            else:
                at[int(number)] = status.getModificationTime() / 1000
        return [Turn(n, ends.get(n, OPEN), at[n]) for n in sorted(at)]

    def run_of(self, number: int) -> str:
        stream = self._fs.open(self._path(f"{number:012d}"))
        try:
            return self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream)).readLine()
        finally:
            stream.close()

    def unsaved(self, turns: list[Turn]) -> dict[int, str]:
        return {t.number: self.run_of(t.number) for t in turns if t.state != SAVED}

    def take(self, number: int, run_id: str) -> bool:
        """Put a claim with its content where none is; whether this run got it."""
        part = f".{uuid.uuid4().hex}"
        if self._fs.getScheme() == "file":  # its rename would replace the file
            root = self._path("").toUri().getPath()
            with open(f"{root}/{part}", "w") as out:
                out.write(run_id)
            try:
                os.link(f"{root}/{part}", f"{root}/{number:012d}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{root}/{part}")
        out = self._fs.create(self._path(part), False)
        out.write(bytearray(run_id.encode()))
        out.close()
        taken = self._fs.rename(self._path(part), self._path(f"{number:012d}"))
        if not taken:
            self._fs.delete(self._path(part), False)
        return taken

    def claim(self, run_id: str, base: int, shares: Callable[[list[str]], bool]) -> int | None:
        """The next number, or None if a run that claimed after ``base`` shares an id with this one."""
        while True:
            newer = [t.number for t in self.listed() if t.number > base]
            if newer:
                if len(newer) != newer[-1] - base:  # some are no longer kept
                    return None
                others = sorted({self.run_of(n) for n in newer} - {run_id})
                if others and shares(others):
                    return None
                base = newer[-1]
            if self.take(base + 1, run_id):
                return base + 1

    def again(self, run_id: str) -> int:
        """A further turn of a run that has claimed, whose earlier attempts are over."""
        for number, name in self.unsaved(self.listed()).items():
            if name == run_id:
                self.fail(number)
        while True:
            number = self.listed()[-1].number + 1
            if self.take(number, run_id):
                return number

    def is_abandoned(self, run_id: str, lease: float) -> bool:
        """Whether a run has claimed, is not saved, and nobody is at work on it."""
        turns = self.listed()
        own = [t for t in turns if t.state != SAVED and self.run_of(t.number) == run_id]
        return bool(own) and not any(self._at_work(t, lease) for t in own)

    @staticmethod
    def _at_work(turn: Turn, lease: float) -> bool:
        return turn.state == OPEN and time.time() - turn.at < lease

    def wait(self, number: int, lease: float) -> None:
        """Until no earlier claim is at work. The lease of this one starts when its turn comes."""
        while True:
            self._fs.setTimes(self._path(f"{number:012d}"), int(time.time() * 1000), -1)
            if not any(t.number < number and self._at_work(t, lease) for t in self.listed()):
                return
            time.sleep(POLL_SECONDS)

    def fail(self, number: int) -> None:
        self._fs.create(self._path(f"{number:012d}.{FAILED}"), True).close()

    def saved(self, run_id: str) -> list[str]:
        """End all claims of a run as saved. Returns runs whose claims are no longer kept."""
        turns = self.listed()
        for number, name in self.unsaved(turns).items():
            if name == run_id:
                self._fs.create(self._path(f"{number:012d}.{SAVED}"), True).close()
        gone = [t.number for t in turns if t.state == SAVED and t.number <= turns[-1].number - KEPT]
        names = [self.run_of(n) for n in gone]
        for number in gone:
            for end in ("", f".{FAILED}", f".{SAVED}"):  # the end last: a claim without one would be open
                self._fs.delete(self._path(f"{number:012d}{end}"), False)
        return names
