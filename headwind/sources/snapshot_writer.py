"""Entities to snapshot files, the inverse of the decoder. Each task writes its own files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.functions.clock import utc_day, utc_hour_text
from headwind.sources import feedspec

ENTITIES_PER_FILE = 500


def encode_snapshots(entities: DataFrame, feed: str) -> DataFrame:
    """`(path, content)`: entities of one header second and batch, a bounded number per message.

    Sorting by header gathers a snapshot in few messages; the entity id in the order lets a large
    snapshot spread over several tasks.
    """
    order = [F.col("header_s"), F.col("e.id")]
    rows = entities.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "header_s",
        F.concat(
            F.lit(f"feed={feed}/date="),
            utc_day(F.col("header_s")).cast("string"),
            F.lit("/hour="),
            utc_hour_text(F.col("header_s")),
        ).alias("folder"),
        F.to_json("e").alias("e"),
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        message_class = feedspec.feed_message()
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            files = []
            for (header_s, folder), group in batch.groupby(["header_s", "folder"]):
                header = {"gtfs_realtime_version": "2.0", "timestamp": int(header_s)}
                texts = list(group["e"])
                for start in range(0, len(texts), ENTITIES_PER_FILE):
                    chunk = [json.loads(t) for t in texts[start : start + ENTITIES_PER_FILE]]
                    # names, numbers, lists and enum labels as the message's own constructor takes them
                    message = message_class(header=header, entity=chunk)
                    path = f"{folder}/part={task}-{n}/{feed}_{int(header_s)}.pb"
                    files.append((path, message.SerializeToString(deterministic=True)))
                    n += 1
            yield pd.DataFrame(files, columns=["path", "content"])

    return rows.mapInPandas(encode, "path string, content binary")


def write_snapshots(files: DataFrame, root: str) -> int:
    """Write `(path, content)` rows below `root`, a folder every executor can reach.

    `files` should come from a table, so that a repeated task writes the same files again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        local = root.removeprefix("file:")
        store, base = fs.FileSystem.from_uri(root) if "://" in local else (fs.LocalFileSystem(), local)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                target = f"{base}/{path.as_py()}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(target) as out:
                    # a view into the batch; contents are not copied
                    out.write(content.as_buffer())
            yield batch.select(["path"])

    return files.select("path", "content").mapInArrow(write, "path string").count()
