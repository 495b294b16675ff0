"""The overall statistics report of a sentence table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators import profile
from textlab.operators import profile_states as ps
from textlab.session import staged


def overall_stats(
    df: DataFrame,
    group: str = "name",
    section: str = "section",
    date: str = "filingDate",
    text: str = "sentence",
    distinct: Sequence[str] = ("name", "cik", "section"),
    lists: Sequence[str] = (),
    approx: bool = False,
) -> dict[str, DataFrame]:
    """All parts of the report, from the states of one scan, which are written once (``states``).

    ``scalars`` holds rows, distinct counts, dates and null counts. With ``approx``, distinct columns other than ``group``
    and ``section`` are counted by a sketch in a second scan instead of being listed; ``lists`` takes a scan each.
    """
    counted = [group, section, *([] if approx else distinct)]
    states = staged(ps.profile_states(df, counted, date, text), "profile")
    return report_parts(states, df, group, section, distinct, lists, approx)


def report_parts(
    states: DataFrame, df: DataFrame, group: str = "name", section: str = "section", distinct: Sequence[str] = ("name", "cik", "section"),
    lists: Sequence[str] = (), approx: bool = False,
) -> dict[str, DataFrame]:
    """The report of stored or merged states; ``df`` gives the columns and, where asked for, what the states do not hold."""
    listed = [c for c in distinct if not approx or c in (group, section)]
    scalars = ps.scalars(states, df.columns, listed)
    rest = [c for c in distinct if c not in listed]
    if rest:
        found = df.agg(*[profile.distinct_with_null(c, True).cast("long").alias(c) for c in rest]).first()
        scalars = scalars.withColumns({f"unique {c}": F.lit(found[c]) for c in rest})
    uniques = scalars.select(*[F.col(f"`unique {c}`").alias(c) for c in distinct])
    missing = scalars.select(*[F.col(f"`missing {c}`").alias(c) for c in df.columns])
    parts = {
        "states": states,
        "scalars": scalars,
        "shape": scalars.select(
            F.col("rows").alias("total_rows"), F.lit(len(df.columns)).cast("long").alias("total_columns"), F.lit(",".join(df.columns)).alias("column_names")),
        "unique_values": profile.unpivot_row(uniques, "column_name", "unique_count"),
        "top_groups": ps.top_values(states, group, df.schema[group].dataType, 10),
        "date_range": scalars.select("earliest", "latest"),
        "text_statistics": ps.text_statistics(states),
        "section_distribution": ps.top_values(states, section, df.schema[section].dataType, 15),
        "missing_data": profile.unpivot_row(missing, "column_name", "n_missing").filter("n_missing > 0"),
    }
    for column in lists:
        parts[f"unique_values_{column}"] = profile.unique_exploded(df, column, approx)
    return parts


def as_rows(df: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    """The report as (part, item, value, text) rows, from one scalar aggregation and the group counts."""
    number, words = F.lit(None).cast("double"), F.lit(None).cast("string")

    def row(part: str, item, value=number, text=words):
        return F.struct(
            F.lit(part).alias("part"),
            (F.lit(item) if isinstance(item, str) else item).cast("string").alias("item"),
            value.cast("double").alias("value"),
            text.alias("text"),
        )

    scalars = stats["scalars"]
    rows = [
        row("shape", "rows", F.col("rows")),
        row("shape", "columns", F.lit(len(df.columns)), F.lit(",".join(df.columns))),
        row("dates", "earliest", text=F.col("earliest")),
        row("dates", "latest", text=F.col("latest")),
    ]
    for name in scalars.columns:
        part, _, item = name.partition(" ")
        if item:
            rows.append(row(part, item, F.col(f"`{name}`")))
    fixed = scalars.select(F.inline(F.array(*rows))).filter("part <> 'missing' or value > 0")
    lengths = stats["text_statistics"].select(
        F.inline(F.array(*[row("length", c, F.col(c)) for c in stats["text_statistics"].columns]))
    )
    result = fixed.unionByName(lengths)
    for part in ("top_groups", "section_distribution"):
        group, n = stats[part].columns
        result = result.unionByName(
            stats[part].select(row(part, F.col(group), F.col(n)).alias("r")).select("r.*")
        )
    for part, counted in stats.items():
        if part.startswith("unique_values_"):
            result = result.unionByName(counted.select(
                row("unique", F.col("column_name"), F.col("unique_count")).alias("r")
            ).select("r.*"))
    return result
