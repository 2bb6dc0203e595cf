"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitledger.llm import (
    decontaminate,
    extraction,
    fim,
    langid,
    ngram_join,
    pieces,
    pii,
    quality,
    secret_scan,
    sharding,
    substring_dedup,
    vector_codes,
    warc,
)
from unitledger.llm.common import table

_LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_places(kinds: list[tuple[str, str]]) -> str:
    """Common table expressions up to `pos`: every match (x) of every kind with its place and the text around."""
    each = "\n  UNION ALL ".join(
        f"SELECT doc_id, '{kind}' AS kind, {i} AS ord, regexp_extract_all(t, '{pattern}') AS m, "
        f"string_split_regex(t, '{pattern}') AS g FROM d"
        for i, (kind, pattern) in enumerate(kinds)
    )
    return f"""
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  {each}),
one AS (SELECT doc_id, kind, ord, m, g, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0),
pos AS (
  SELECT doc_id, kind, ord, m[i] AS x, right(g[i], 50) || ' ' || left(g[i + 1], 50) AS around,
         list_sum(list_transform(g[1:i], lambda z: length(z)))
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda z: length(z))), 0) AS start
  FROM one)"""


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


_NEAR = " ".join(
    f"WHEN '{kind}' THEN regexp_matches(lower(around), '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)')"
    for kind, (_, _, _, _, words) in pii.KINDS.items()
)
_WEIGHT = " ".join(f"WHEN '{kind}' THEN {a + b}" for kind, (_, _, a, b, _) in pii.KINDS.items())
_NUMBER = "CAST(digits[i] AS INT)"
OP1_SQL = rf"""
WITH {_sql_places([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
])},
checked AS (
  SELECT *, regexp_replace(x, '[^0-9]', '', 'g') AS digits,
         substr(replace(x, ' ', ''), 5) || substr(replace(x, ' ', ''), 1, 4) AS turned FROM pos),
kept AS (
  SELECT doc_id, kind, ord, start, start + length(x) AS stop,
         CASE kind {_WEIGHT} END + CASE WHEN CASE kind {_NEAR} END THEN {pii.CONTEXT_WEIGHT} ELSE 0 END AS score
  FROM checked WHERE CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(x, '.'), lambda p:
      length(ltrim(p, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(p, '0') AS INT), 0) <= 255))
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN (length(digits) - i) % 2 = 1 THEN {_NUMBER} * 2 - CASE WHEN {_NUMBER} > 4 THEN 9 ELSE 0 END
           ELSE {_NUMBER} END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0, list_transform(string_split(turned, ''), lambda c:
      CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
      lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1
    ELSE true END),
named AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans,
         string_agg(CAST(score AS VARCHAR), ',' ORDER BY start, ord) AS scores
  FROM kept WHERE ord < 4 OR score >= {pii.THRESHOLD} GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores
FROM d LEFT JOIN named USING (doc_id)
"""


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


OP4_SQL = rf"""
WITH word AS (
  SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all({_LOWER_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS t
  FROM item WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM word, sizes WHERE len(w) >= n),
spot AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM place),
hit AS (SELECT DISTINCT doc_id, spot.n, i, item_id FROM spot JOIN win ON spot.t = win.t AND spot.n = win.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT word.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM word LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_texts(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


_ASSIGN = secret_scan.KINDS["assign"][0].replace("'", "''")
OP7_SQL = rf"""
WITH {_sql_places([
    ("assign", _ASSIGN),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
    *[(kind, pattern) for kind, (pattern, _) in secret_scan.KINDS.items() if kind not in secret_scan.BASE],
])},
valued AS (SELECT *, CASE WHEN kind = 'assign' THEN regexp_extract(x, '{_ASSIGN}', 1) ELSE x END AS v FROM pos),
kept AS (
  SELECT valued.*, coalesce(source, '') AS repo FROM valued JOIN documents USING (doc_id)
  WHERE CASE kind WHEN 'assign' THEN length(v) >= 8 WHEN 'access' THEN length(x) >= 16
        WHEN 'hex' THEN length(x) >= 32 ELSE true END),
owners AS (SELECT v, count(DISTINCT split_part(repo, '/', 1)) AS owners FROM kept GROUP BY v),
judged AS (
  SELECT kept.*, owners, owners < {secret_scan.COPIED_OWNERS}
         AND len(list_distinct(string_split(v, ''))) >= {secret_scan.LEAST_CHARACTERS}
         AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS live
  FROM kept JOIN owners USING (v)),
named AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || (start + length(x)), ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
         string_agg(kind || ':' || start || ':' || (start + length(x)), ',' ORDER BY start, ord) FILTER (ord < 3 OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (owners >= {secret_scan.COPIED_OWNERS}) AS n_copied
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN named USING (doc_id)
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


OP8_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS bytes, sha256(h) AS digest FROM p),
r AS (SELECT *, CASE WHEN bytes >= {warc.REVISIT_FROM} THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM q)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM r
"""


#: Name of the tokenizer's file in the folder of public vocabularies.
PIECES = "piece_bpe_32k.model"


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


OP10_SQL = rf"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM word),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM rows a JOIN rows b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = doc_id
"""


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = fim.fill_in_middle(docs, restored_col="restored")
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, w, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS a,
         CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS b, CAST('0x' || h[17:24] AS BIGINT) % 100 AS c,
         CAST('0x' || h[25:32] AS BIGINT) % 100 AS e FROM d),
cut AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90
           THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(w[greatest(a, b) + 1:n], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_report(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spot AS (
  SELECT doc_id, i, array_to_string(w[i:i + {substring_dedup.WINDOW - 1}], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) AS i FROM d)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) AS k FROM spot
  WHERE t IN (SELECT t FROM spot GROUP BY t HAVING count(*) > 1)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS t FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


def _op13_sql() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    near = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"near{r} AS MATERIALIZED (SELECT row, vec_id, label, p, v, min(struct_pack(far := CAST({near} AS BIGINT), e := e)) AS hit "
            f"FROM part JOIN book{r} USING (p) GROUP BY row, vec_id, label, p, v)"
        )
        if r < rounds:
            steps.append(
                f"sums{r} AS (SELECT p, hit.e AS e, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS x "
                f"FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM part) + 1)) AS j) GROUP BY p, hit.e, j),\n"
                f"book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.c, o.c) AS c FROM book{r} o "
                f"LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS c FROM sums{r} GROUP BY p, e) n USING (p, e))"
            )
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {vector_codes.SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT row, vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
  FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (SELECT p, row - 1 AS e, v AS c FROM part WHERE row <= {entries}),
{",\n".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', hit.e), '' ORDER BY p) AS code, CAST(sum(hit.far) AS BIGINT) AS error
  FROM near{rounds} GROUP BY row, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j))
        FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS j FROM book{rounds})) AS codebooks_sha256
FROM coded
"""


OP13_SQL = _op13_sql()

QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_html_extraction": op5_html_extraction,
    "op6_sharding": op6_sharding,
    "op7_secret_scan": op7_secret_scan,
    "op8_warc": op8_warc,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_ngram_join": op10_ngram_join,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_vector_codes": op13_vector_codes,
}
SQL = {
    "op1_pii": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op7_secret_scan": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op10_ngram_join": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
