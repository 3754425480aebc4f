"""Seeded noise for robustness tests: every draw is a hash of (seed, id, position), so runs agree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typos(text: Column, key: Column, p: float = 0.1, seed: int = 42) -> Column:
    """Each character in turn is, with probability p, dropped or exchanged with the next, either as likely; a character can travel."""

    @F.pandas_udf("string")
    def each(texts: pd.Series, keys: pd.Series) -> pd.Series:
        out = []
        for t, k in zip(texts, keys, strict=True):
            if t is None:
                out.append(None)
                continue
            rng, chars, i = np.random.default_rng([seed, int(k) % 2**63]), list(t), 0
            while i < len(chars):
                if rng.random() < p:
                    if rng.random() < 0.5:
                        del chars[i]
                        continue
                    if i + 1 < len(chars):
                        chars[i], chars[i + 1] = chars[i + 1], chars[i]
                i += 1
            out.append("".join(chars))
        return pd.Series(out, dtype=object)

    return each(text, F.xxhash64(key))


def drop_part(address: Column, key: Column, p: float = 0.3, seed: int = 42) -> Column:
    """With probability p one of the comma-separated parts goes; a single part stays."""
    parts = F.transform(F.split(address, ","), F.trim)
    hit = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / 1e6 < p
    k = F.pmod(F.xxhash64(F.lit(seed + 1), key), F.size(parts))
    return F.when(hit & (F.size(parts) > 1), F.array_join(F.filter(parts, lambda x, i: i != k), ", ")).otherwise(address)


def corrupt(df: DataFrame, name_p: float = 0.1, address_p: float = 0.3, seed: int = 42) -> DataFrame:
    """Records with typos in names, and addresses with a part dropped and a few typos. Normalise afterwards: noise must reach the columns that scores read."""
    address = typos(drop_part(F.col("business_address"), F.col("entity_id"), address_p, seed), F.col("entity_id"), 0.05, seed + 2)
    return df.withColumns({"business_name": typos(F.col("business_name"), F.col("entity_id"), name_p, seed), "business_address": address})
