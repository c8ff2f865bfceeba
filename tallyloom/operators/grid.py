"""Tables out of cell grids (file, sheet, row, col, value): merged headers, sections, targets, categories and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHEET = ["file", "sheet"]


def data_sheets(cells: DataFrame) -> DataFrame:
    """cells without summary and chart sheets."""
    return cells.filter(~F.col("sheet").rlike("(?i)^(summary|chart)"))


def filled_headers(cells: DataFrame, n_rows: int) -> DataFrame:
    """The first rows' cells, merged ones filled from the left; blank text counts as empty."""
    w = Window.partitionBy(*SHEET, "row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    text = F.nullif(F.trim("value"), F.lit(""))
    return cells.filter(F.col("row") < n_rows).withColumn("value", F.last(text, True).over(w))


def section_of_columns(cells: DataFrame, row: int) -> DataFrame:
    """For each column the section header at or before it in one row: a number, a space and text ("5.1 x" is none)."""
    w = Window.partitionBy(*SHEET).orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    is_section = F.col("value").rlike(r"^\s*\d+\s+\S")
    return cells.filter(F.col("row") == row).select(*SHEET, "col", F.last(F.when(is_section, F.col("value")), True).over(w).alias("section"))


def signatures(headers: DataFrame) -> DataFrame:
    """One text for each column: its header cells from top to bottom, joined by " | ", in lower case."""
    listed = F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("row", "value"))))
    return headers.groupBy(*SHEET, "col").agg(F.lower(F.concat_ws(" | ", F.transform(listed, lambda x: x["value"]))).alias("signature"))


def resolved_targets(sigs: DataFrame, targets: dict[str, list[list[str]]]) -> DataFrame:
    """For each target the leftmost column whose signature has all words of one of its word sets; unresolved ones have a null col."""
    spark = sigs.sparkSession
    spec = spark.createDataFrame([(t, [[w.lower() for w in s] for s in sets]) for t, sets in targets.items()], "target string, sets array<array<string>>")
    pairs = sigs.crossJoin(F.broadcast(spec))  # a handful of targets, given by the caller
    fits = F.exists("sets", lambda s: F.forall(s, lambda w: F.contains(F.col("signature"), w)))
    return pairs.groupBy(*SHEET, "target").agg(F.min(F.when(fits, F.col("col"))).alias("col"))


def categories(cells: DataFrame, label_col: int, names: list[str], first_row: int) -> DataFrame:
    """Label cells with the category row above them; category rows and totals themselves are left out."""
    w = Window.partitionBy(*SHEET).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    upper = F.upper(F.trim("value"))
    is_category = F.lit(False)
    for n in names:
        is_category = is_category | (upper == n.upper()) | upper.startswith(n.upper() + " ")
    rows = cells.filter((F.col("col") == label_col) & (F.col("row") >= first_row)).withColumn("_is", is_category)
    rows = rows.withColumn("category", F.last(F.when(F.col("_is"), F.col("value")), True).over(w))
    return rows.filter(~F.col("_is") & ~upper.startswith("TOTAL")).select(*SHEET, "row", F.col("value").alias("label"), "category")


def extracted(cells: DataFrame, columns: DataFrame, first_row: int, targets: list[str], parse: Column) -> DataFrame:
    """A row for each sheet row with a column for each target; rows in which all targets are null (footnotes) are left out."""
    named = cells.filter(F.col("row") >= first_row).join(columns.filter("col is not null"), [*SHEET, "col"])
    wide = named.groupBy(*SHEET, "row").pivot("target", targets).agg(F.first(parse))
    return wide.filter(F.coalesce(*targets).isNotNull())


def summed(a: Column, b: Column) -> Column:
    """The sum if both are there, else the first."""
    return F.when(a.isNotNull() & b.isNotNull(), a + b).otherwise(a)


def resolved_by_section(columns: DataFrame, specs: dict[str, dict[str, list[str]]]) -> DataFrame:
    """For each target the leftmost column whose section, label and unit hold all words of its spec, and its section none of section_not.

    columns has (file, sheet, col, section, label, unit); words are compared in lower case. A target that isn't found has
    a null col: `missing` lists those.
    """
    kinds = ("section", "section_not", "column", "unit")
    rows = [(t, *([w.lower() for w in s.get(k, [])] for k in kinds)) for t, s in specs.items()]
    spec = columns.sparkSession.createDataFrame(rows, "target string, " + ", ".join(f"_{k} array<string>" for k in kinds))
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    holds = lambda words, c: F.forall(words, lambda w: F.contains(low(c), w))
    fits = holds("_section", "section") & ~F.exists("_section_not", lambda w: F.contains(low("section"), w)) & holds("_column", "label") & holds("_unit", "unit")
    pairs = columns.crossJoin(F.broadcast(spec))  # a handful of targets, given by the caller
    return pairs.groupBy(*SHEET, "target").agg(F.min(F.when(fits, F.col("col"))).alias("col"))


def missing(resolved: DataFrame) -> DataFrame:
    """The targets that a sheet has no column for."""
    return resolved.filter("col is null").select(*SHEET, "target")


def group_columns(headers: DataFrame, group: str, word: str = "outstanding") -> DataFrame:
    """(file, sheet, col, how): the column of `word` inside a group's span of the filled headers.

    The span begins at the leftmost cell of the first row that holds the group's name and goes as far as the cells are
    equal. Below it the first row, and in it the leftmost column, whose text holds the word counts ("span"). Where there
    is none, the first cell that is the group's own name below a cell with the word counts ("banner"). Else there is no row.
    """
    h = headers.select(*SHEET, "row", "col", F.lower(F.coalesce("value", F.lit(""))).alias("v"))
    named = h.filter(F.contains("v", F.lit(group.lower())))
    at = named.groupBy(*SHEET).agg(F.min(F.struct("row", "col", "v")).alias("_g"))
    line = h.join(at, SHEET).filter((F.col("row") == F.col("_g.row")) & (F.col("col") >= F.col("_g.col")))
    stop = line.groupBy(*SHEET).agg(F.min(F.when(F.col("v") != F.col("_g.v"), F.col("col"))).alias("_stop"))
    span = at.join(stop, SHEET)
    inside = h.join(span, SHEET).filter((F.col("row") > F.col("_g.row")) & (F.col("col") >= F.col("_g.col")) & (F.col("_stop").isNull() | (F.col("col") < F.col("_stop"))) & F.contains("v", F.lit(word)))
    first = inside.groupBy(*SHEET).agg(F.min(F.struct("row", "col"))["col"].alias("_inside"))
    banner = h.groupBy(*SHEET, "col").agg(F.min(F.when(F.contains("v", F.lit(word)), F.col("row"))).alias("_above"))
    own = h.filter(F.trim("v") == group.lower()).join(banner, [*SHEET, "col"]).filter(F.col("_above") < F.col("row"))
    below = own.groupBy(*SHEET).agg(F.min(F.struct("row", "col"))["col"].alias("_below"))
    out = at.join(first, SHEET, "left").join(below, SHEET, "left")
    return out.select(*SHEET, F.coalesce("_inside", "_below").alias("col"), F.when(F.col("_inside").isNotNull(), "span").otherwise("banner").alias("how")).filter("col is not null")


def sheet_formats(cells: DataFrame, formats: list[tuple[str, str]]) -> DataFrame:
    """(file, sheet, format): the first format whose mark the sheet's name holds, in any case; none: null."""
    found = F.coalesce(*(F.when(F.contains(F.lower("sheet"), F.lit(mark.lower())), F.lit(name)) for name, mark in formats))
    return cells.select(*SHEET).distinct().withColumn("format", found)
