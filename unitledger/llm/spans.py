"""Places of pattern matches in whole texts, as column expressions.

Patterns are Java regular expressions. Positions are code points, ends exclusive. A text is cut
at the matches once, so the cost is linear in its length; texts around a match come from the gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points before and after a match that count as its context.
AROUND = 50
#: Places are gathered in runs of this length, so that appending stays cheap with many matches.
_RUN = 256

SPAN = "struct<start:bigint,stop:bigint,match:string,around:string>"


def located(text: Column, pattern: str, only_with: str | None = None) -> Column:
    """Leftmost matches that do not overlap, as an array of `SPAN`.

    `only_with` is a plain string that every match holds; texts without it are not searched.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("match"), F.slice(gaps, 2, F.size(gaps)).alias("next"))
    parts = F.filter(
        F.transform(
            parts,
            lambda x: F.struct(
                F.length(x["gap"]).cast("long").alias("gap"),
                x["match"].alias("match"),
                F.concat(F.right(x["gap"], F.lit(AROUND)), F.lit(" "), F.left(x["next"], F.lit(AROUND))).alias("around"),
            ),
        ),
        lambda x: x["match"].isNotNull(),
    )
    none = F.array().cast(f"array<{SPAN}>")
    empty = F.struct(F.lit(0).cast("long").alias("at"), none.alias("run"), F.array().cast(f"array<array<{SPAN}>>").alias("runs"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["match"])
        own = F.array(F.struct(start.alias("start"), stop.alias("stop"), x["match"].alias("match"), x["around"].alias("around")))
        full = F.size(acc["run"]) >= _RUN
        return F.struct(
            stop.alias("at"),
            F.when(full, own).otherwise(F.concat(acc["run"], own)).alias("run"),
            F.when(full, F.concat(acc["runs"], F.array(acc["run"]))).otherwise(acc["runs"]).alias("runs"),
        )

    spans = F.aggregate(parts, empty, step, lambda acc: F.flatten(F.concat(acc["runs"], F.array(acc["run"]))))
    return spans if only_with is None else F.when(F.contains(text, F.lit(only_with)), spans).otherwise(none)


def spans_text(spans: Column) -> Column:
    """`kind:start:stop` joined by commas; the spans are in order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans by the first's."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        piece = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(clear, F.concat(acc["out"], F.array(piece, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))))
            .otherwise(acc["out"])
            .alias("out"),
        )

    rest = F.aggregate(
        spans,
        start,
        step,
        lambda acc: F.array_join(
            F.concat(acc["out"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))), ""
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(rest)
