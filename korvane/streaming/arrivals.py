"""New records of source 1 matched as they arrive, against a pool that stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from korvane.operators.matcher import PairMatcher
from korvane.plans.linkage import Settings, infer


def match_arrivals(arrivals: DataFrame, s2: DataFrame, s3: DataFrame, matcher: PairMatcher, out: str, checkpoint: str, settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Each micro-batch of a streaming DataFrame of records is linked and appended to Parquet at out; one-to-one holds within a batch. once: stops when what is there now is done."""

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            infer(matcher, df, s2, s3, settings)[0].write.mode("append").parquet(out)

    stream = arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()
