"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.shared import cut, release, shared_root, table  # noqa: F401  for the operators

#: Words are maximal runs of anything but space, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def uniform(*parts: Column) -> Column:
    """A reproducible uniform number in [0, 1): the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``buckets`` (null id: of empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def slices(batches, rows: int = 512):
    """Arrow batches in pieces of ``rows``, so that few texts at a time are Python objects."""
    pa.default_memory_pool().release_unused()  # what an operator before left in this worker
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
