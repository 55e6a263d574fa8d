"""Writers of label files, images, distribution tables, names files and reports; they make new outputs in folders of their own."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.files import _hadoop
from cairn.sources.named_files import write_files


def six_places(value: Column) -> Column:
    """A number to six places, the nearest to its exact value, as a label file has it."""

    @F.pandas_udf("string")
    def of(v: pd.Series) -> pd.Series:
        return v.map(lambda x: f"{x:.6f}")

    return of(value)


def label_lines(boxes: DataFrame) -> DataFrame:
    """``split``, ``stem`` and ``text``: a line of class and four numbers of six places for each box, in order of ``line_no``."""
    line = F.concat_ws(" ", F.col("cls").cast("string"), *[six_places(F.col(k)) for k in "xywh"])
    lines = boxes.select("split", "stem", "line_no", line.alias("line"))
    rows = lines.groupBy("split", "stem").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("l"))  # a file's lines
    return rows.select("split", "stem", F.concat(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))


def write_labels(boxes: DataFrame, folder: str, files: DataFrame | None = None) -> None:
    """``folder/split/labels/stem.txt`` of each label; ``files`` (``split``, ``stem``) lists labels that may have no box, which get
    an empty file."""
    lines = label_lines(boxes)
    if files is not None:
        lines = files.select("split", "stem").distinct().join(lines, ["split", "stem"], "left")
    path = F.concat_ws("/", "split", F.lit("labels"), F.concat("stem", F.lit(".txt")))
    write_files(lines.select(path.alias("path"), F.coalesce("text", F.lit("")).alias("content")), folder)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written by the driver to any file system that Spark knows."""
    at, files = _hadoop(spark, path)
    out = files.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_text(spark, path, json.dumps(value, indent=2))


def names_yaml(names: list[str], root: str = ".") -> str:
    lines = [f"path: {root}", "train: train/images", "val: val/images", "test: test/images", "", f"nc: {len(names)}", f"names: {names}"]
    return "\n".join(lines) + "\n"


def csv_text(header: list[str], rows: list[list]) -> str:
    """A small table as CSV; None is an empty cell."""
    cell = lambda v: "" if v is None else f'"{str(v).replace(chr(34), chr(34) * 2)}"' if any(c in str(v) for c in ',"\n\r') else str(v)
    return "".join(",".join(map(cell, r)) + "\n" for r in [header, *rows])


def escape(value: object) -> str:
    """A cell of a Markdown table."""
    return "" if value is None else str(value).replace("|", "\\|")


def table(header: list[str], rows: list[list], numbers: int = 0) -> list[str]:
    """Lines of a Markdown table whose last ``numbers`` columns are aligned right."""
    marks = ["---"] * (len(header) - numbers) + ["---:"] * numbers
    return ["| " + " | ".join(header) + " |", "|" + "|".join(marks) + "|", *["| " + " | ".join(map(escape, r)) + " |" for r in rows]]


def markdown(title: str, df: DataFrame) -> str:
    """All rows of a small aggregate as a Markdown table, in order of its columns."""
    rows = [list(r) for r in df.orderBy(*df.columns).toLocalIterator()]
    return "\n".join([f"# {title}", "", *table(df.columns, rows)]) + "\n"
