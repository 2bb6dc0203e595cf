"""Secrets in texts, told from copied examples by who owns them.

Patterns propose candidates. The hash of each candidate value is counted over the whole corpus by
distinct repositories and distinct owners: a value that many owners hold is an example that was
copied around, one that stays with a single owner looks live. Distinct (value, repository, owner)
rows are formed before they are shuffled, so a value in a third of all texts costs a row per
repository and task. Only hashes leave the text, never the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.llm.common import prepare, written
from unitledger.llm.spans import located, spans_text
from unitledger.operators.skew import keyed_join

_NAME = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = rf"(?:{_NAME})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"

# Kinds in order, with pattern and a string that every match holds.
BASE = ("assign", "access", "hex")
KINDS = {
    "assign": (_ASSIGN, None),
    "access": (r"AKIA[A-Z0-9]{12,}", "AKIA"),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}+", None),
    "github": (r"gh[opsur]_[A-Za-z0-9]{36,}", "gh"),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "eyJ"),
    "pem": (r"-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----[A-Za-z0-9+/=\x0A\x0D\x20]{40,}", "PRIVATE KEY"),
}
#: A value with so many distinct owners, or more, is a copied example.
COPIED_OWNERS = 3
#: A live-looking value has a digit, a letter and so many different characters.
LEAST_CHARACTERS = 8


def owner_of(repository: Column) -> Column:
    """The part of a repository name before the first slash; the whole name without one."""
    return F.substring_index(repository, "/", 1)


def _value(kind: str, match: Column) -> Column:
    return F.regexp_extract(match, _ASSIGN, 1) if kind == "assign" else match


def _candidates_of(text: Column, order: int, kind: str) -> Column:
    value = lambda s: _value(kind, s["match"])
    spans = located(text, *KINDS[kind])
    if kind == "assign":
        spans = F.filter(spans, lambda s: F.length(value(s)) >= 8)
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            F.sha2(value(s), 256).alias("value"),
            (
                (F.size(F.array_distinct(F.split(value(s), ""))) >= LEAST_CHARACTERS)
                & value(s).rlike("[0-9]")
                & value(s).rlike("[A-Za-z]")
            ).alias("plausible"),
        ),
    )


def _candidates(text: Column) -> dict[str, Column]:
    return {kind: _candidates_of(text, order, kind) for order, kind in enumerate(KINDS)}


def _count(spans: Column | str, holds) -> Column:
    return F.size(F.filter(spans, holds)).cast("long")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", copied_owners: int = COPIED_OWNERS
) -> DataFrame:
    """Secret spans of every input row with a verdict from the whole corpus.

    Returns the id, `n_<kind>` for the base kinds (assign, access, hex), `base` and `spans`
    (sorted arrays of start, order, stop, kind, owners, live), `n_live` and `n_copied`. Base spans
    are always in `spans`; other kinds only when they look live: varied characters and fewer than
    `copied_owners` owners. Null and empty texts have no spans; a null repository counts as one
    with an empty name. Repeated rows are kept. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    source = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    found = source.withColumns({f"_{k}": v for k, v in _candidates(F.col("text")).items()})
    found = found.select("id", "repo", F.array_sort(F.concat(*[F.col(f"_{k}") for k in KINDS])).alias("candidates"))
    found = written(
        found.withColumn("key", F.when(F.size("candidates") > 0, F.sha2(F.to_json(F.struct("candidates")), 256)))
    )
    single = found.filter("key is not null").select("id", "key", "repo", F.explode("candidates").alias("c"))
    owners = (
        single.select(F.col("c.value").alias("value"), "repo")
        .distinct()
        .groupBy("value")
        .agg(F.count("*").alias("repos"), F.countDistinct(owner_of(F.col("repo"))).alias("owners"))
    )
    rows = (
        found.filter("key is not null")
        .dropDuplicates(["id", "key"])
        .select("id", "key", F.explode("candidates").alias("c"))
    )
    judged = keyed_join(rows.withColumn("value", F.col("c.value")), owners, ["value"], "left").select(
        "id",
        "key",
        F.struct(
            "c.start",
            "c.order",
            "c.stop",
            "c.kind",
            "repos",
            "owners",
            (F.col("c.plausible") & (F.col("owners") < copied_owners)).alias("live"),
        ).alias("span"),
    )
    per_row = judged.groupBy("id", "key").agg(F.array_sort(F.collect_list("span")).alias("judged"))
    per_row = per_row.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "judged")
    spans = F.coalesce("judged", F.array().cast(per_row.schema["judged"].dataType))
    out = found.join(per_row, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    out = out.select("id", spans.alias("judged"))
    base = lambda s: s["kind"].isin(*BASE)
    return out.select(
        F.col("id").alias(id_col),
        *[_count("judged", _of_kind(k)).alias(f"n_{k}") for k in BASE],
        F.filter("judged", base).alias("base"),
        F.filter("judged", lambda s: base(s) | s["live"]).alias("spans"),
        _count("judged", lambda s: s["live"]).alias("n_live"),
        _count("judged", lambda s: s["owners"] >= copied_owners).alias("n_copied"),
    )


def secret_report(docs: DataFrame, **columns) -> DataFrame:
    found = scan_secrets(docs, **columns)
    return found.select(
        found.columns[0],
        *[f"n_{k}" for k in BASE],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )
