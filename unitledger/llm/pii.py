"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

All of it is column expressions in one projection: no shuffle, no Python on the executors. The
patterns are written so that each text is read in linear time: runs are taken whole (possessive)
and only start where a run starts or the last match ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.llm.common import fresh, prepare
from unitledger.llm.spans import located, masked, spans_text

# Kinds in order, with pattern, a string that every match holds, weight of the bare
# pattern, weight of its checksum, and the words that make a match more likely when they are near.
BASE = ("email", "ip", "card", "phone")
KINDS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        60,
        0,
        "e-?mail|mail|contact|write",
    ),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 40, 0, "ip|address|host|server|client"),
    "card": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+", None, 30, 40, "card|visa|mastercard|credit|debit|payment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 40, 0, "phone|call|tel|telephone|mobile|cell|fax"),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        None,
        20,
        50,
        "iban|account|bank|konto|compte|cuenta",
    ),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 25, 0, "ssn|social security|taxpayer"),
}
CONTEXT_WEIGHT = 25
#: Score from which a span of a kind beyond the base ones is reported.
THRESHOLD = 50
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    digit = lambda c: F.ascii(c) - F.when(c <= "9", 48).otherwise(55)
    step = lambda a, c: (a * F.when(c <= "9", 10).otherwise(100) + digit(c)) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    """Whether a proposed match is one; what holds without a checksum is decided by form alone."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike(f"^{_PART}$"))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return _mod97(match)
    return F.lit(True)


def _spans_of(text: Column, order: int, kind: str) -> Column:
    pattern, needs, weight, checksum, words = KINDS[kind]
    near = f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"
    confirmed = F.filter(located(text, pattern, needs), lambda s: _confirmed(kind, s["match"]))
    scored = F.transform(
        confirmed,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            (F.lit(weight + checksum) + F.when(F.lower(s["around"]).rlike(near), CONTEXT_WEIGHT).otherwise(0)).alias("score"),
        ),
    )
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= THRESHOLD)


def pii_spans(text: Column) -> dict[str, Column]:
    """Per kind an array of (start, order, stop, kind, score). Null texts count as empty."""
    whole = F.coalesce(text, F.lit(""))
    return {kind: _spans_of(whole, order, kind) for order, kind in enumerate(KINDS)}


def find_pii(docs: DataFrame, text_col: str = "text", prefix: str = "pii_") -> DataFrame:
    """Adds the columns `<kind>`, `base` and `spans` with the prefix (sorted arrays of spans) to all columns.

    A span is (start, order, stop, kind, score). Base kinds (email, ip, card, phone) are reported
    whenever their pattern and check hold; the others (iban, ssn) from a score of `THRESHOLD`,
    which an iban reaches by its checksum and an ssn by words near it. Null and empty texts have
    no spans. Columns of these names are replaced; all rows stay, repeated ones too.
    """
    prepare(docs.sparkSession)
    kinds = pii_spans(F.col(text_col))
    found = docs.withColumns({f"{prefix}{k}": v for k, v in kinds.items()})
    ordered = lambda names: F.array_sort(F.concat(*[F.col(f"{prefix}{k}") for k in names]))
    return found.withColumns({f"{prefix}base": ordered(BASE), f"{prefix}spans": ordered(KINDS)})


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced by `<KIND>`; rows, columns and null texts stay.

    Where `length_col` exists it is set to the new length of changed texts.
    """
    prefix = fresh(docs, "pii_")
    found = find_pii(docs, text_col, prefix)
    spans = F.col(f"{prefix}spans")
    out = found.withColumn(
        text_col, F.when(F.col(text_col).isNull(), F.col(text_col)).otherwise(masked(F.col(text_col), spans))
    )
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(
            length_col, F.when(F.size(spans) > 0, F.length(text_col).cast(kind)).otherwise(F.col(length_col))
        )
    return out.select(*docs.columns)


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: counts of the base kinds, digest of the base spans, all spans and their scores."""
    found = find_pii(docs.select(F.col(id_col), F.col(text_col)), text_col)
    return found.select(
        id_col,
        *[F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(spans_text(F.col("pii_base")), 256).alias("base_sha256"),
        spans_text(F.col("pii_spans")).alias("spans"),
        F.array_join(F.transform("pii_spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
