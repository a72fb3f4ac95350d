"""Monthly results sheets: stacked wide blocks to one long table.

Many exported sheets can be read at once; every sheet is its own partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions import parse

HEADER = "SAOs Achieved"
NUMBERS = ("saos", "sao_target", "saos_inbound", "saos_event", "pipeline_usd")


def _blocks(lines: DataFrame) -> DataFrame:
    """lines: sheet, line (order), cells (array of text). Adds the block a line is in."""
    name = F.trim(F.coalesce(F.get("cells", F.lit(1)), F.lit("")))
    kinds = F.create_map(*[F.lit(x) for k, v in vocab.SHEET_BLOCKS.items() for x in (k, v or "skip")])
    rows = lines.withColumn("name", name).withColumn("_starts", F.try_element_at(kinds, F.col("name")))
    w = Window.partitionBy("sheet").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", F.last("_starts", ignorenulls=True).over(w))


def _months(lines: DataFrame) -> DataFrame:
    """(sheet, col, month) of the first header line of a sheet."""
    heads = lines.where(F.trim(F.get("cells", F.lit(1))) == HEADER)
    first = heads.groupBy("sheet").agg(F.min_by("cells", "line").alias("cells"))
    return first.select("sheet", F.posexplode("cells").alias("col", "cell")).select(
        "sheet", "col", parse.month("cell").alias("month")
    ).where("month IS NOT NULL")


def _values(lines: DataFrame) -> DataFrame:
    cells = _blocks(lines).where("block IS NOT NULL AND block <> 'skip' AND _starts IS NULL")
    return (
        cells.select("sheet", "name", "block", "line", F.posexplode("cells").alias("col", "cell"))
        .withColumn("value", parse.money("cell"))
        .where("value IS NOT NULL")
        .join(_months(lines), ["sheet", "col"])
    )


def monthly_results(lines: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """(sheet, rep_name, month, five numbers, status, ramping flag, team, dates)."""
    pairs = [F.lit(x) for kv in (aliases or {"": ""}).items() for x in kv]
    rep = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("name")), F.col("name")).alias("rep_name")
    is_rep = ~F.col("name").isin(*vocab.SHEET_NON_REP_ROWS)
    wide = (
        _values(lines).where(is_rep)
        .groupBy("sheet", rep, "month")
        .pivot("block", list(NUMBERS))
        .agg(F.max_by("value", "line"))
    )
    cell = lambda i: F.trim(F.get("cells", F.lit(i)))
    meta = (
        _blocks(lines).where(is_rep & (F.col("block") == "saos") & F.col("_starts").isNull())
        .groupBy("sheet", rep)
        .agg(F.max_by(F.struct(
            (F.coalesce(cell(2), F.lit("")) == "(Ramping)").alias("is_ramping"),
            parse.day(F.get("cells", F.lit(4))).alias("start_date"), parse.day(F.get("cells", F.lit(5))).alias("end_date"),
            F.nullif(cell(7), F.lit("")).alias("status"), F.nullif(cell(8), F.lit("")).alias("team"),
        ), "line").alias("m"))
        .select("sheet", "rep_name", "m.*")
    )
    return wide.join(meta, ["sheet", "rep_name"], "left")


def checksum(lines: DataFrame, results: DataFrame) -> DataFrame:
    """Months whose own total row disagrees with the sum over reps."""
    own = _values(lines).where((F.col("name") == "Overall") & (F.col("block") == "saos")).groupBy("sheet", "month").agg(
        F.max_by("value", "line").alias("sheet_total")
    )
    reps = results.groupBy("sheet", "month").agg(F.coalesce(F.sum("saos"), F.lit(0)).alias("rep_total"))
    return own.join(reps, ["sheet", "month"], "left").withColumn(
        "matches", F.col("sheet_total") == F.coalesce("rep_total", F.lit(0))
    )


def header_months(lines: DataFrame, least: int = vocab.SHEET_LEAST_MONTHS) -> DataFrame:
    """(sheet, months, whole) of every sheet: how many months its header names, and whether they are enough.

    A sheet whose header is missing or cut has no column for some results, which would otherwise
    vanish without a word.
    """
    named = _months(lines).groupBy("sheet").agg(F.count(F.lit(1)).alias("months"))
    every = lines.select("sheet").distinct().join(named, "sheet", "left")
    return every.select("sheet", F.coalesce("months", F.lit(0)).alias("months")).withColumn("whole", F.col("months") >= least)


def roster_drift(results: DataFrame, roster: DataFrame) -> DataFrame:
    """(rep_name, in_sheet, in_roster) of names that only one of the two has."""
    sheet = results.select(F.col("rep_name").alias("a")).distinct()
    names = roster.select(F.col("name").alias("b")).where("b IS NOT NULL").distinct()
    both = sheet.join(names, F.col("a") == F.col("b"), "full_outer")
    return both.where("a IS NULL OR b IS NULL").select(
        F.coalesce("a", "b").alias("rep_name"), F.col("a").isNotNull().alias("in_sheet"), F.col("b").isNotNull().alias("in_roster")
    )
