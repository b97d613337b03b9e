"""Which small files of a table are written together."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small_bytes(target_bytes: int) -> int:
    """Files from this size on are left alone."""
    return target_bytes // 2


def crowded(files: DataFrame, target_bytes: int) -> DataFrame:
    """The small files of the partitions in which they are many for their size.

    ``files`` has path, length and number, the partition's. These partitions have at
    least two small files, of an eighth of the target size on average.
    """
    small = files.where(F.col("length") < small_bytes(target_bytes))
    count, total = F.count(F.lit(1)), F.sum("length")
    many = small.groupBy("number").agg(count.alias("n"), total.alias("bytes"))
    many = many.where((F.col("n") > 1) & (F.col("bytes") < F.col("n") * target_bytes / 8))
    return small.join(many.select("number"), "number", "left_semi")


def packed_bins(small: DataFrame, target_bytes: int) -> DataFrame:
    """number, folder, name and bin of the files to write together.

    Per partition, first fit by decreasing length: a file goes to the first bin with room
    for it, else to a new one. Files alone in their bin are left out. Ties go by name.
    """
    named = small.select(
        "number",
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"),
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
        "length",
    )

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values(["length", "name"], ascending=[False, True], ignore_index=True)
        files["bin"] = first_fit(files["length"].tolist(), target_bytes)
        together = files.groupby("bin")["name"].transform("size") > 1
        return files.loc[together, ["number", "folder", "name", "bin"]]

    return named.groupBy("number").applyInPandas(pack, "number INT, folder STRING, name STRING, bin INT")


def first_fit(lengths: list[int], target: int) -> list[int]:
    """The bin of each length, in the given order; a tree of most room finds the first that fits."""
    width = 1
    while width < len(lengths):
        width *= 2
    room = [target] * (2 * width)
    out = []
    for length in lengths:
        at = 1
        while at < width:
            at = 2 * at if room[2 * at] >= length else 2 * at + 1
        out.append(at - width)
        room[at] -= length
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return out
