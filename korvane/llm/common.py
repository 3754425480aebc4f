"""Keys, foreign columns and text pieces shared by the corpus operators."""

from __future__ import annotations

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from korvane.session import ship_code

#: Stands for a null doc_id inside keys.
NULL_ID = -(2**63)
#: Words are runs of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


class Hidden:
    """docs with every foreign column under a private name, so that none can clash with a column an operator makes.

    df: the columns own under their names, all others as o_0, o_1, ... by position. Names
    are taken exactly: beside `text`, a column `Text` is foreign.
    """

    def __init__(self, docs: DataFrame, *own: str):
        ship_code(docs.sparkSession)
        self.names = list(docs.columns)
        at = {self.names.index(n): n for n in own}
        self.private = [at.get(i, f"o_{i}") for i in range(len(self.names))]
        self.df = docs.toDF(*self.private)
        self.others = [c for c in self.private if c not in own]

    def shown(self, df: DataFrame, *added: str, changed: dict[str, Column] | None = None) -> DataFrame:
        """df with the columns of docs in their order and under their names, then the added ones.

        changed: columns to stand in for those of docs, by name. An added name that docs has
        already, but for case, gets underscores after it; so no column is lost or doubled.
        """
        new, taken = changed or {}, {n.lower() for n in self.names}
        out = [new.get(n, F.col(c)).alias(n) for n, c in zip(self.names, self.private, strict=True)]
        for n in added:
            name = n
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            out.append(F.col(n).alias(name))
        return df.select(*out)

    def schema(self, *names: str, **added: str) -> StructType:
        """These private columns of df, then added ones by name and type."""
        new = StructType.fromDDL(", ".join(f"{n} {kind}" for n, kind in added.items()))
        return StructType([self.df.schema[c] for c in names] + new.fields)


def keyed(docs: DataFrame) -> DataFrame:
    """docs plus k_id and k_hash, which name a row without a global counter.

    Rows equal in doc_id and text share a key, and whatever an operator decides
    for a key holds for each of them.
    """
    return docs.withColumns(
        {"k_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "k_hash": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))}
    )


def doc_id_of(k_id: Column) -> Column:
    return F.when(k_id != F.lit(NULL_ID), k_id)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (the splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bits of a bitmap for each key that is to be in it; binary logarithms of the fewest and the most bits (128 MB), and of those of a chunk.
ROOM, LEAST_BITS, MOST_BITS, CHUNK_BITS = 16, 20, 30, 16


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the values of a column of longs, as bytes: has() then tells which keys it surely lacks.

    Its size grows with the keys up to 2^MOST_BITS bits; beyond, more keys that are not in it pass. It is
    made in chunks by the executors, so the driver gets its bytes and no keys.
    """
    log = min(MOST_BITS, max(LEAST_BITS, (ROOM * keys.count() - 1).bit_length()))
    at = keys.select(F.pmod(column, F.lit(1 << log)).alias("at")).distinct()

    def pack(group: pa.Table) -> pa.Table:
        at = group.column("at").to_numpy()
        bits = np.zeros(1 << CHUNK_BITS, bool)
        bits[at & ((1 << CHUNK_BITS) - 1)] = True
        return pa.table({"chunk": pa.array([int(at[0]) >> CHUNK_BITS], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()])})

    chunks = at.groupBy(F.shiftright("at", CHUNK_BITS).alias("chunk")).applyInArrow(pack, "chunk int, bits binary").toArrow()
    out = np.zeros((1 << log) // 8, np.uint8)
    size = (1 << CHUNK_BITS) // 8
    for chunk, bits in zip(chunks.column("chunk").to_pylist(), chunks.column("bits"), strict=True):
        out[chunk * size : (chunk + 1) * size] = np.frombuffer(bits.as_py(), np.uint8)
    return out


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of these 64-bit keys a bitmap lets through."""
    at = keys.view(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


@cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def trim() -> None:
    """Gives memory that is no longer used back to the system: Python workers stay alive after their task."""
    pa.default_memory_pool().release_unused()
    _libc()(0)


def trimming(f):
    """f, a function from batches to batches, with trim() when it ends."""

    def each(batches):
        yield from f(batches)
        trim()

    return each
