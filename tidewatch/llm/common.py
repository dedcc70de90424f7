"""What the corpus operators share: reading, the shared folder, words, what a Python worker keeps."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the checkpoint folder set on the context.

    Where neither is set, a session in one process (master local[n], as in tests) sets a temporary folder of its own, which goes when it
    ends; a cluster gets an error, since no other place is known to be shared.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Code points of texts that are worked on together.
BLOCK = 4_000_000


def blocks(texts: list[str], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `most` code points."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (size < most or end == at):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


_kept: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps under key from task to task. It keeps one thing: another operator's goes before this one's is made."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Generations(dict):
    """Word -> what `make` says of it, kept in two generations of about `size` bytes each; an entry counts `each` bytes and its word."""

    def __init__(self, make: Callable[[Any], Any], size: int = 48_000_000, each: int = 200) -> None:
        super().__init__()
        self.make, self.size, self.each = make, size, each
        self.before: dict = {}
        self.used = 0

    def __missing__(self, word: Any) -> Any:
        got = self.before.get(word)
        if got is None:
            got = self.make(word)
        self[word] = got
        self.used += self.each + len(word)
        return got

    def turn(self) -> None:
        """Begin a new generation if this one is full; to be called between texts."""
        if self.used > self.size:
            self.before = dict(self)
            self.clear()
            self.used = 0
