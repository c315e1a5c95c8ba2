"""What tasks hold in Python: batches bounded in bytes, freed memory given back."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tilerank.llm import common


def resident() -> float:
    """MB of this process that are no files."""
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_batches_are_bounded_in_bytes(spark):
    """8,000 texts of 4,000 bytes were one batch of 32 MB."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    rows = spark.range(0, 8000, 1, 1).select("id", F.repeat(F.lit("abcd"), 1000).alias("text"))
    got = rows.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 8000
    assert max(r["size"] for r in got) < 2 * common.BATCH_BYTES


def test_freed_memory_goes_back():
    """A block that stays above freed ones keeps them in the process, unless they are given back."""
    stays = []

    def emit(batches):
        for b in batches:
            blocks = [np.ones(8000) for _ in range(2000)]  # 128 MB in blocks too small to be mapped
            stays.append(np.ones(8000))
            del blocks
            yield b

    before = resident()
    for _ in emit([1]):
        pass
    kept = resident() - before
    common.give_back()
    before = resident()
    assert list(common.lean(emit)([1, 2, 3])) == [1, 2, 3]
    assert resident() - before < 20 < kept
