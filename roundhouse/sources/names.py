"""Keys that are written in file names and URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_asset_name(df: DataFrame, name: str = "file_name", suffixes: tuple[str, ...] = ("_card.json", "_dwpose.pkl", ".json", ".pkl")) -> DataFrame:
    """Adds base_name, chunk_index and chunk_start from date_time_index_start names; other names have no row."""
    stem = F.regexp_replace(F.substring_index(F.col(name), "/", -1), "(" + "|".join(x.replace(".", r"\.") for x in suffixes) + ")$", "")
    part = F.split(stem, "_")
    out = df.withColumn("__part", part).where(F.size("__part") == 4)
    part = F.col("__part")
    out = out.withColumns({"base_name": F.concat_ws("_", part[0], part[1]), "chunk_index": part[2].try_cast("int"), "chunk_start": part[3].try_cast("int")})
    return out.where("chunk_index is not null and chunk_start is not null").drop("__part")


def parse_frame_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds round_name and frame_id from <round>_f<frame>.png, split at the last _f, and a status."""
    pattern = r"^(.*)_f(\d+)\.png$"
    frame = F.regexp_extract(name, pattern, 2).try_cast("int")
    return df.withColumns({"round_name": F.when(frame.isNotNull(), F.regexp_extract(name, pattern, 1)), "frame_id": frame, "status": F.when(frame.isNull(), "bad_filename").otherwise("ok")})


def index_chunks(df: DataFrame) -> DataFrame:
    """Per base_name its chunk files in order of start, and their number."""
    files = F.array_sort(F.collect_list(F.struct("chunk_start", "file_name")))
    return df.groupBy("base_name").agg(files.alias("files"), F.count("*").alias("n_chunks"))


def video_name_from_url(url: Column) -> Column:
    """The file's name without extension; a base64 fileuri=... parameter is decoded first."""
    coded = F.regexp_extract(url, r"fileuri=([A-Za-z0-9+/=]+)", 1)
    path = F.when(coded != "", F.decode(F.unbase64(coded), "UTF-8")).otherwise(url)
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
