"""Reports as tables of text lines, and reading such tables back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_lines(rows: DataFrame, columns: dict[str, Column], order: list[str], group: str | None = None, heading: str = "## ") -> DataFrame:
    """Markdown pipe table per group: heading, header, rule and one line per row, as (group, part, line) rows to write in order.

    ``columns`` maps a heading to its formatted text column."""
    keys = [group] if group else []
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns.values()]), F.lit(" |"))
    body = rows.select(*keys, F.lit(3).alias("part"), F.struct(*order).alias("_o"), cells.alias("line"))
    head = "| " + " | ".join(columns) + " |"
    rule = "| " + " | ".join([":---"] * len(columns)) + " |"
    title = F.concat(F.lit(heading), F.col(group).cast("string")) if group else F.lit(heading)
    tops = (rows.select(*keys).distinct() if keys else rows.sparkSession.range(1).drop("id")).select(
        *keys, F.explode(F.array(
            F.struct(F.lit(0).alias("part"), title.alias("line")), F.struct(F.lit(1).alias("part"), F.lit(head).alias("line")),
            F.struct(F.lit(2).alias("part"), F.lit(rule).alias("line")))).alias("_t")).select(*keys, "_t.*")
    return tops.unionByName(body, allowMissingColumns=True).orderBy(*keys, "part", "_o").drop("_o")


def parse_table(texts: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """Rows of the first pipe table after ``heading``: (key, row_no, cells map).  Rows of another width are dropped."""
    at = F.instr(F.col(text), F.lit(heading))
    lines = F.transform(F.split(F.substring(F.col(text), at, F.length(text)), "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    is_row = lambda s: s.startswith("|") & s.endswith("|")
    rows = texts.where(at > 0).select(key, lines.alias("_l"))
    first = F.array_position(F.transform("_l", is_row), True).cast("int")
    rows = rows.withColumn("_f", first).where(F.col("_f") > 0).withColumn("_t", F.slice("_l", F.greatest(F.lit(1), F.col("_f")), F.size("_l")))
    stop = F.array_position(F.transform("_t", lambda s: ~is_row(s)), True).cast("int")
    rows = rows.withColumn("_n", F.when(stop > 0, stop - 1).otherwise(F.size("_t")))
    cells = lambda s: F.transform(F.split(F.regexp_replace(s, r"^\|+|\|+$", ""), r"\|"), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
    rows = rows.select(key, cells(F.get("_t", F.lit(0))).alias("_h"), F.slice("_t", F.lit(3), F.greatest(F.col("_n") - 2, F.lit(0))).alias("_r"))
    out = rows.select(key, "_h", F.posexplode("_r").alias("row_no", "_s")).withColumn("_c", cells(F.col("_s")))
    return out.where(F.size("_c") == F.size("_h")).select(key, "row_no", F.map_from_arrays("_h", "_c").alias("cells"))
