"""A large quoted CSV read in many tasks, although its texts hold line breaks.

Spark cuts a text file into byte ranges and gives each the lines that begin in it. Whether a range begins inside a quoted text depends
on all ranges before it. So each range is first summed up as a function of that: where it ends if it begins outside, and if it
begins inside a text. These functions are composed along the file, which is one row for each range. Then every range knows how it
begins and cuts its own records; only a record that crosses a border travels, to be put together with its other parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import is_small, lookup_join, materialize, measured, size_measures

QUOTED = r'"(?:[^"]|"")*+"'  # a quote inside is doubled
PLAIN = r'(?:[^",][^,]*+)?'
ENDS_INSIDE = re.compile(rf'(?:(?:{QUOTED}[^,]*+|{PLAIN}),)*+"(?:[^"]|"")*+\Z')
CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*+')


def state_after(line: str, inside: bool) -> bool:
    """Whether a text is still open after the line. Quotes count at the start of a field only, as the CSV reader has it."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = CLOSES.match(line)
        if not closed:
            return True
        if closed.end() == len(line):
            return False
        at = closed.end() + 1  # after the comma
    return ENDS_INSIDE.match(line, at) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line, file, start: the lines as they stand, in order inside a range, with the range's first byte."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """file, start, from_outside, from_inside: the state at a range's end for either state at its beginning."""
    at, ends = None, None
    for batch in batches:
        for file, start, line in zip(batch["file"], batch["start"], batch["line"]):
            if (file, start) != at:
                if at is not None:
                    yield pd.DataFrame([(*at, *ends)], columns=["file", "start", "from_outside", "from_inside"])
                at, ends = (file, start), (False, True)
            if '"' in line:
                ends = (state_after(line, ends[0]), state_after(line, ends[1])) if ends[0] != ends[1] else (state_after(line, ends[0]),) * 2
    if at is not None:
        yield pd.DataFrame([(*at, *ends)], columns=["file", "start", "from_outside", "from_inside"])


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """file, start, nr, kind, record: whole records, and the parts of those cut by a border: what the range before left open (head),
    what is left open (tail), and a range that lies inside one text (between). nr counts the records of a range."""
    at, inside, parts, kind, nr, found = None, False, [], None, 0, []

    def close(kind_):
        found.append((*at, nr, kind_, "\n".join(parts)))

    for batch in batches:
        for file, start, line, begins in zip(batch["file"], batch["start"], batch["line"], batch["begins_inside"]):
            if (file, start) != at:
                if parts:
                    close("between" if kind == "head" else "tail")
                at, inside, parts, kind, nr = (file, start), bool(begins), [], "head" if begins else "whole", 0
            parts.append(line)
            inside = state_after(line, inside)
            if not inside:
                close(kind)
                parts, kind, nr = [], "whole", nr + 1
        yield pd.DataFrame(found, columns=["file", "start", "nr", "kind", "record"])
        found = []
    if parts:
        close("between" if kind == "head" else "tail")
        yield pd.DataFrame(found, columns=["file", "start", "nr", "kind", "record"])


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """The typed rows of CSV files that Spark's own reader would take as one task each.

    Quoted texts may hold commas, line breaks and doubled quotes, also across the borders of ranges, and one text may cover many
    ranges. Lines end in \\n or \\r\\n. Empty lines are no rows; with `header` each file's first record is none either. Other
    rows are parsed by `from_csv`, so a field that does not fit its type is null. The files are read twice, without a
    shuffle of their rows. A range's size is `spark.sql.files.maxPartitionBytes`.
    """
    lines = _lines(spark, path)
    sums = lines.mapInPandas(_sums, "file string, start long, from_outside boolean, from_inside boolean")
    # The state at a range's end is fixed by the last range before it that ends alike from either state, and by how many ranges
    # after that one turn it around.
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"fixed": F.when(F.col("from_outside") == F.col("from_inside"), F.struct("start", F.col("from_outside").alias("state"))),
                             "turns": F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("long")).over(along)})
    sums = sums.withColumn("known", F.when(F.col("fixed").isNotNull(), F.struct(F.col("fixed.state").alias("state"), "turns")))
    sums = sums.withColumns({"last": F.last("known", ignorenulls=True).over(before), "so_far": F.lag("turns", 1, 0).over(along)})
    turned = (F.col("so_far") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    begins = materialize(sums.select(F.struct("file", "start").alias("range"), (F.coalesce("last.state", F.lit(False)) != turned).alias("begins_inside")), "ranges")
    lines = lines.withColumns({"range": F.struct("file", "start"), "at": F.monotonically_increasing_id()})
    begins, sizes = measured(begins.filter("begins_inside"), "inside", **size_measures(begins))  # one row for each range that begins in a text
    if is_small(sizes):
        known = lines.join(F.broadcast(begins), "range", "left")  # keeps the order of the lines
    else:
        known = lookup_join(lines, begins, "range", "left", small=False).repartition("file", "start").sortWithinPartitions("file", "start", "at")
    known = known.select("file", "start", "line", F.coalesce("begins_inside", F.lit(False)).alias("begins_inside"))
    records = materialize(known.mapInPandas(_records, "file string, start long, nr long, kind string, record string"), "records")
    cut = records.filter("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == "tail")
    cut = cut.withColumn("number", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    part = F.struct("start", (F.col("kind") == "tail").alias("tail"), "nr", "record")
    joined = cut.groupBy("file", "number").agg(F.array_sort(F.collect_list(part)).alias("p"))  # the parts of one record
    joined = joined.select(F.col("p")[0]["start"].alias("start"), F.col("p")[0]["nr"].alias("nr"), F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    whole = records.filter("kind = 'whole'").select("start", "nr", "record").unionByName(joined)
    whole = whole.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")
    if header:
        whole = whole.filter("not (start = 0 and nr = 0)")
    fields = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {"quote": '"', "escape": '"', "multiLine": "true"})
    return whole.select(fields.alias("row")).select("row.*")
