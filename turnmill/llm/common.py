"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: What a worker process keeps between tasks, by name.
KEPT: dict[str, tuple] = {}

#: Seconds without a task after which a worker process gives it back.
IDLE = 1.5

_lock = threading.RLock()
_users, _ended = [0], [0]  # tasks, or operators of one, that use what is kept; those that have


def release() -> None:
    """Give back what an earlier stage has kept in this worker process; idle workers hold it otherwise."""
    if KEPT:
        KEPT.clear()
        gc.collect()  # encoders refer to themselves
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc, which keeps freed blocks otherwise
    if trim is not None:
        trim(0)


@contextmanager
def kept(make: Callable[[], tuple]) -> Iterator[tuple]:
    """What ``make`` finds in KEPT or puts there.  Later tasks of the process go on with it; when none comes for a while, it is given back."""
    with _lock:
        found = make()
        _users[0] += 1
    try:
        yield found
    finally:
        del found
        with _lock:
            _users[0] -= 1
            _ended[0] += 1
            timer = threading.Timer(IDLE, _release_idle, [_ended[0]])
            timer.daemon = True
            timer.start()


def _release_idle(ended: int) -> None:
    with _lock:
        if not _users[0] and ended == _ended[0]:
            release()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session may lack the setting (tests); it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="turnmill-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bitmaps of 32,768 numbers each that are broadcast, 64 MB; rows are joined by a shuffle if there are more.
BITMAPS = 1 << 14


def flagged(rows: DataFrame, numbers: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean column ``flag``: whether their ``number`` is among those of ``numbers``.

    Numbers are those of ``monotonically_increasing_id``.  One bit for each is broadcast, so that wide rows stay where they are.
    """
    place = F.col("number") + 1  # bitmaps begin behind multiples of 32,768, as partitions do
    stretch, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = staged(numbers.groupBy(stretch.alias("stretch")).agg(F.bitmap_construct_agg(bit).alias("bits")), "bits")
    if bits.count() > BITMAPS:
        among = numbers.select("number", F.lit(True).alias(flag)).distinct()
        return rows.join(among, "number", "left").select(*rows.columns, F.coalesce(flag, F.lit(False)).alias(flag))
    octet = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    among = F.coalesce(F.getbit(octet, (bit % 8).cast("int")) == 1, F.lit(False))
    joined = rows.withColumn("stretch", stretch).join(F.broadcast(bits), "stretch", "left")
    return joined.withColumn(flag, among).drop("stretch", "bits")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a NULL id counts as remainder 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(0))


def local_path(uri: str) -> str:
    """A shared folder as a path that workers can open and map; other stores can't be mapped."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        raise ValueError(f"the shared folder must be mounted on every machine, got {uri}")
    return uri


#: Bytes of a text that are cut into words at a time.
BLOCK = 1 << 20


def word_blocks(raw: bytes):
    """Lists of the words of ``raw``, about BLOCK bytes at a time, so that long texts need little memory.

    ``bytes.split`` splits at exactly the six white-space bytes of WORD.
    """
    if len(raw) <= BLOCK:
        yield raw.split()
        return
    start = 0
    while start < len(raw):
        end = min(start + BLOCK, len(raw))
        while end < len(raw) and not raw[end : end + 1].isspace():
            found = [x for x in (raw.find(c, end, end + 4096) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")) if x >= 0]
            end = min(found, default=min(end + 4096, len(raw)))
        yield raw[start:end].split()
        start = end
