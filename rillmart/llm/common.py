"""What the operators of this subpackage share: tables, written intermediate results, and small expressions."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.session import run_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"  # the ASCII white space all contracts here mean


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs no earlier step, and fixes values such as generated numbers.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text, where ``lower`` does just that, takes the faster way."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fingerprint(value: Column, seed: int = 0) -> list[Column]:
    """128 bits as two longs."""
    return [F.xxhash64(F.lit(2 * seed), value), F.xxhash64(F.lit(2 * seed + 1), value)]


_HELD: dict[str, Any] = {}


def held(owner: str, make: Callable[[], Any] = dict) -> Any:
    """What a Python worker keeps from task to task for one operator.

    Spark gives a worker tasks of one stage after the other; when another operator asks, the memory of the one before is given
    back to the system first.
    """
    if owner not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[owner] = make()
    return _HELD[owner]


def give_back() -> None:
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
