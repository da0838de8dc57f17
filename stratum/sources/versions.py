"""Published versions: a rebuild never takes away what readers have.

Each build writes a folder of its own, ``v-<id>``, beside earlier ones.  Once it
is whole, a numbered pointer file in ``published/`` names it; the pointer with
the highest number is the current version.  A pointer appears by one rename, so
a reader finds the former version or the new one, a build that dies half-way is
never pointed at, and of two builds that end at once both get a number.  Tables
written into one folder (the marts of a run) are always read together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from stratum.sources import files

POINTERS = "published"
#: Versions that stay: readers that have resolved an earlier one can finish.
KEEP = 3

T = TypeVar("T")


class NotPublishedError(FileNotFoundError):
    def __init__(self, base: str):
        super().__init__(f"nothing has been published under {base}")


def published(spark: SparkSession, base: str) -> list[str]:
    """The version folders that have been pointed at and are still there, oldest first."""
    base = base.rstrip("/")
    found = []
    for number in files.names(spark, f"{base}/{POINTERS}"):
        folder = files.read_file(spark, f"{base}/{POINTERS}/{number}")
        if folder is not None:  # else: expired meanwhile
            found.append(f"{base}/{folder.decode()}")
    return found


def current(spark: SparkSession, base: str) -> str:
    """The folder of the current version."""
    base = base.rstrip("/")
    for number in reversed(files.names(spark, f"{base}/{POINTERS}")):
        folder = files.read_file(spark, f"{base}/{POINTERS}/{number}")
        if folder is not None:
            return f"{base}/{folder.decode()}"
    raise NotPublishedError(base)


def is_published(spark: SparkSession, base: str) -> bool:
    return bool(files.names(spark, f"{base.rstrip('/')}/{POINTERS}"))


def publish(spark: SparkSession, base: str, write: Callable[[str], T], *, keep: int = KEEP) -> T:
    """Run ``write(folder)`` on a new folder, then make that the current
    version and expire all but the last ``keep``.  If ``write`` fails, nothing
    has changed for readers; its folder goes with a later expiry."""
    base = base.rstrip("/")
    folder = f"v-{uuid.uuid4().hex[:12]}"
    result = write(f"{base}/{folder}")
    while True:
        last = max(map(int, files.names(spark, f"{base}/{POINTERS}")), default=0)
        try:
            files.write_file(spark, f"{base}/{POINTERS}/{last + 1:08d}", folder.encode())
            break
        except files.FileTakenError:
            continue  # another build was first: the next number
    expire(spark, base, keep)
    return result


def expire(spark: SparkSession, base: str, keep: int = KEEP) -> list[str]:
    """Delete all but the last ``keep`` published versions, pointers first.
    Folders that were never pointed at stay: a build may be writing them."""
    gone = []
    base = base.rstrip("/")
    numbers = files.names(spark, f"{base}/{POINTERS}")
    for number in numbers[:max(0, len(numbers) - max(1, keep))]:
        folder = files.read_file(spark, f"{base}/{POINTERS}/{number}")
        files.delete(spark, f"{base}/{POINTERS}/{number}")
        if folder is not None:
            files.delete(spark, f"{base}/{folder.decode()}")
            gone.append(f"{base}/{folder.decode()}")
    return gone
