"""Queries for code decoding, text repair, dates and class codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.functions import dates, text
from unitledger.sources.catalog import decode_columns


@query(
    """SELECT c.c_custkey, n.n_name AS nation FROM customer c
       LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) n ON n.n_nationkey = c.c_nationkey"""
)
def decode_single_code(t: Tables):
    catalog = t.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Wert"))
    units = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return decode_columns(units, catalog, ["nation"])


@query(
    """WITH u AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN ' , ' ELSE (o_orderkey % 30) || ', ' || (o_custkey % 40) ||
              CASE WHEN o_orderstatus = 'P' THEN ',,' || (o_orderkey % 11) ELSE '' END END AS codes FROM orders),
       e AS (SELECT o_orderkey, i, trim(list_extract(string_split(codes, ','), i)) AS code
             FROM u, generate_series(1, 4) AS g(i) WHERE i <= len(string_split(codes, ','))),
       d AS (SELECT e.o_orderkey, string_agg(n_name, ',' ORDER BY i) AS names FROM e JOIN nation ON n_nationkey = TRY_CAST(e.code AS INTEGER)
             GROUP BY e.o_orderkey)
       SELECT u.o_orderkey, d.names AS fuels FROM u LEFT JOIN d ON d.o_orderkey = u.o_orderkey"""
)
def decode_code_list(t: Tables):
    key = F.col("o_orderkey")
    codes = F.when(key % 7 == 0, " , ").otherwise(
        F.concat(
            (key % 30).cast("string"), F.lit(", "), (F.col("o_custkey") % 40).cast("string"),
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(",,"), (key % 11).cast("string"))).otherwise(""),
        )
    )
    catalog = t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Wert"))
    return decode_columns(t.orders.select("o_orderkey", codes.alias("fuels")), catalog, ["fuels"])


@query(
    """WITH u AS (SELECT l_orderkey, l_linenumber, [l_orderkey, l_orderkey + 1, l_partkey] AS codes FROM lineitem WHERE l_linenumber <> 4
                  UNION ALL SELECT NULL, l_linenumber, [l_orderkey] FROM lineitem WHERE l_linenumber = 4 UNION ALL SELECT l_orderkey, 5, [l_orderkey] FROM lineitem WHERE l_linenumber = 1),
       n AS (SELECT *, row_number() OVER () AS r FROM u), e AS (SELECT r, unnest(range(1, len(codes) + 1)) AS i, codes FROM n),
       k AS (SELECT o_orderkey AS id, min(o_orderpriority) AS w FROM (SELECT o_orderkey, o_orderpriority FROM orders UNION ALL SELECT o_orderkey, '0 ' || o_orderstatus FROM orders WHERE o_orderkey % 3 = 0) GROUP BY o_orderkey),
       d AS (SELECT r, string_agg(w, ',' ORDER BY i) AS t FROM e JOIN k ON k.id = codes[i] GROUP BY r)
       SELECT n.l_orderkey AS id, l_linenumber AS line, d.t AS texts FROM n LEFT JOIN d ON d.r = n.r"""
)
def decode_large_catalog(t: Tables):
    """A catalog as large as `orders`, with repeated codes; rows repeat and lack keys."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = t.lineitem.filter("l_linenumber <> 4").select(key.alias("id"), F.concat_ws(", ", key, key + 1, "l_partkey").alias("texts"), line.alias("line"))
    keyless = t.lineitem.filter("l_linenumber = 4").select(F.lit(None).cast("bigint").alias("id"), key.cast("string").alias("texts"), line.alias("line"))
    again = t.lineitem.filter("l_linenumber = 1").select(key.alias("id"), key.cast("string").alias("texts"), F.lit(5).cast(t.lineitem.schema["l_linenumber"].dataType).alias("line"))
    catalog = t.orders.select(F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("Wert"))
    repeated = t.orders.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("Id"), F.concat(F.lit("0 "), "o_orderstatus").alias("Wert"))
    return decode_columns(rows.unionByName(keyless).unionByName(again), catalog.unionByName(repeated), ["texts"])


@query(
    """SELECT s_name, CASE s_nationkey % 6 WHEN 1 THEN 'Stromerzeugungslokation' WHEN 2 THEN 'Stromverbrauchslokation'
              WHEN 3 THEN 'Gaserzeugungslokation' WHEN 4 THEN 'Gasverbrauchslokation' ELSE CAST(s_nationkey % 6 AS VARCHAR) END AS kind
       FROM supplier"""
)
def decode_keep_unmapped(t: Tables):
    return t.supplier.select("s_name", text.code_to_text(F.col("s_nationkey") % 6, text.LOCATION_TYPES).alias("kind"))


@query(
    """WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'DK-' || (c_custkey % 10000) WHEN c_custkey % 5 = 1 THEN NULL
              WHEN c_custkey % 5 = 2 THEN (1000 + c_custkey) || '.0' ELSE CAST(c_custkey * 37 AS VARCHAR) END AS plz,
              CAST(9000000 + c_custkey * 3001 AS VARCHAR) AS ags FROM customer),
       v AS (SELECT *, CASE WHEN plz LIKE '%.0' THEN left(plz, length(plz) - 2) ELSE plz END AS p FROM u)
       SELECT c_custkey, CASE WHEN length(p) = 4 AND regexp_full_match(p, '[0-9]+') THEN '0' || p ELSE p END AS "Postleitzahl",
              CASE WHEN length(ags) = 7 THEN '0' || ags ELSE ags END AS "Gemeindeschluessel" FROM v"""
)
def conditional_zero_pad(t: Tables):
    k = F.col("c_custkey")
    plz = (
        F.when(k % 5 == 0, F.concat(F.lit("DK-"), (k % 10000).cast("string")))
        .when(k % 5 == 1, F.lit(None))
        .when(k % 5 == 2, F.concat((k + 1000).cast("string"), F.lit(".0")))
        .otherwise((k * 37).cast("string"))
    )
    units = t.customer.select("c_custkey", plz.alias("Postleitzahl"), (9000000 + k * 3001).cast("string").alias("Gemeindeschluessel"))
    return text.pad_known_keys(units)


@query(
    """SELECT event_id, strftime(TRY_CAST('2022-03-' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 40 AS VARCHAR), 2, '0') AS DATE),
              '%Y-%m-%d') AS day, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, TRY_CAST(event_type AS DOUBLE) AS not_a_number
       FROM events"""
)
def lenient_cast(t: Tables):
    k = F.get_json_object("props", "$.k").try_cast("int")
    raw = F.concat(F.lit("2022-03-"), F.lpad((k % 40).cast("string"), 2, "0"))
    return t.events.select(
        "event_id", dates.iso_date(dates.lenient_date(raw)).alias("day"), k.alias("k"),
        F.col("event_type").try_cast("double").alias("not_a_number"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
              CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y') || '-01-01' END AS year_day
       FROM events"""
)
def two_format_timestamp(t: Tables):
    ts, n = F.col("ts"), F.col("event_id")
    raw = (
        F.when(n % 3 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
        .when(n % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd"))
    )
    year = F.concat(F.date_format(ts, "yyyy"), F.when(n % 2 == 0, ".0").otherwise(".5"))
    parsed = dates.two_format_timestamp(raw)
    shown = F.when(n % 3 == 0, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", shown.alias("stamp"), dates.iso_date(dates.year_only_date(year)).alias("year_day"))


@query(
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS orders,
              CASE WHEN strftime(o_orderdate, '%m%d') <= '0401' THEN strftime(o_orderdate - INTERVAL 1 YEAR, '%y') || '.2'
                   WHEN strftime(o_orderdate, '%m%d') <= '1001' THEN strftime(o_orderdate, '%y') || '.1'
                   ELSE strftime(o_orderdate, '%y') || '.2' END AS release
       FROM orders GROUP BY o_orderdate"""
)
def release_version(t: Tables):
    days = t.orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("orders"))
    return days.select(dates.iso_date(F.col("o_orderdate")).alias("day"), "orders", dates.release_version(F.col("o_orderdate")).alias("release"))


@query(
    r"""SELECT p_partkey, TRY_CAST(nullif(regexp_replace(p_brand || ' -' || p_retailprice || ' m', '[^-0-9.]+', '', 'g'), '') AS DOUBLE) AS mixed,
               TRY_CAST(nullif(regexp_replace('lat' || p_retailprice, '[A-Za-z]+', '', 'g'), '') AS DOUBLE) AS letters_only,
               nullif(regexp_replace(p_brand, '[^0-9]', '', 'g'), '') AS digits, nullif(regexp_replace(p_name, '[^0-9]', '', 'g'), '') AS no_digits
        FROM part"""
)
def coordinate_text_clean(t: Tables):
    price = F.col("p_retailprice").cast("string")
    return t.part.select(
        "p_partkey",
        text.coordinate(F.concat("p_brand", F.lit(" -"), price, F.lit(" m"))).alias("mixed"),
        text.coordinate_without_letters(F.concat(F.lit("lat"), price)).alias("letters_only"),
        text.digits_or_null(F.col("p_brand")).alias("digits"),
        text.digits_or_null(F.col("p_name")).alias("no_digits"),
    )


MAKERS = ["Nordex", "Adwen/Areva", "Senvion/REpower", "Enercon", "Siemens", "Vestas", "Vensys", "GE Wind", "Eno", "aerodyn", "Unknown"]
POWERS = [1500, 2000, 2050, 3000, 3400]
DIAMETERS = [70, 77, 82, 90, 100, 116, 125, 132, 140]


@query(
    """WITH u AS (SELECT p_partkey, list_extract(['Nordex', 'Adwen/Areva', 'Senvion/REpower', 'Enercon', 'Siemens', 'Vestas', 'Vensys', 'GE Wind', 'Eno', 'aerodyn', 'Unknown'],
              CAST(p_partkey % 11 + 1 AS INTEGER)) AS maker, list_extract([1500, 2000, 2050, 3000, 3400], CAST(p_partkey % 5 + 1 AS INTEGER)) AS power,
              list_extract([70, 77, 82, 90, 100, 116, 125, 132, 140], CAST(p_partkey % 9 + 1 AS INTEGER)) AS diameter FROM part)
       SELECT p_partkey, CASE WHEN maker = 'Nordex' THEN CASE WHEN power IN (1500, 3000) AND diameter IN (70, 77, 82, 100, 116, 125, 132, 140) THEN 'AW' ELSE 'N' END
              WHEN maker = 'Senvion/REpower' THEN CASE WHEN power IN (2000, 2050) THEN 'MM' ELSE 'S' END
              WHEN maker = 'Adwen/Areva' THEN 'AD' WHEN maker = 'Enercon' THEN 'E' WHEN maker = 'Siemens' THEN 'SWT' WHEN maker = 'Vestas' THEN 'V'
              WHEN maker = 'Vensys' THEN 'VS' WHEN maker = 'GE Wind' THEN 'GE' WHEN maker = 'Eno' THEN 'ENO' WHEN maker = 'aerodyn' THEN 'SCD' ELSE '' END
              || '-' || diameter || '_' || power AS class_code FROM u"""
)
def class_code_case(t: Tables):
    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("p_partkey") % len(values) + 1).cast("int"))

    return t.part.select("p_partkey", text.turbine_class(pick(MAKERS), pick(POWERS), pick(DIAMETERS)).alias("class_code"))


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Biomasse' WHEN 'MACHINERY' THEN 'Wasser' ELSE c_mktsegment END AS type,
              COALESCE(CASE WHEN c_custkey % 3 > 0 THEN c_name END, '') || COALESCE(CASE WHEN c_custkey % 2 > 0 THEN c_mktsegment END, '') AS name,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'biomass' WHEN 'MACHINERY' THEN 'hydro' END AS technology
       FROM customer"""
)
def relabel_and_concat(t: Tables):
    from unitledger.specs import UNIT_TYPES

    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    kind = text.relabel(segment, {"BUILDING": "Biomasse", "MACHINERY": "Wasser"})
    return t.customer.select(
        "c_custkey", kind.alias("type"),
        text.full_name(F.when(k % 3 > 0, F.col("c_name")), F.when(k % 2 > 0, segment)).alias("name"),
        text.literal_map(UNIT_TYPES)[kind].alias("technology"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt; ' ELSE 'has_geom; ' END ||
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'inside; ' ELSE '' END AS comment FROM customer"""
)
def audit_comment_chain(t: Tables):
    comment = text.append_comment(F.lit(None).cast("string"), "debt; ", F.col("c_acctbal") < 0)
    comment = text.append_comment(comment, "has_geom; ", F.col("c_acctbal") >= 0)
    comment = text.append_comment(comment, "inside; ", F.col("c_mktsegment") == "BUILDING")
    return t.customer.select("c_custkey", comment.alias("comment"))


@query(
    """SELECT comment, count(*) AS n FROM (SELECT CASE WHEN c_acctbal < 0 THEN 'debt; ' ELSE 'has_geom; ' END ||
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'inside; ' ELSE '' END AS comment FROM customer) GROUP BY comment"""
)
def audit_comment_histogram(t: Tables):
    return audit_comment_chain(t).groupBy("comment").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT c_custkey, replace(c_name || chr(13) || ' office', chr(13), '') AS "Behoerde", CAST(NULL AS VARCHAR) AS "Aktenzeichen" FROM customer"""
)
def carriage_returns_stripped(t: Tables):
    raw = t.customer.select(
        "c_custkey", F.concat("c_name", F.lit("\r office")).alias("Behoerde"), F.lit(None).cast("string").alias("Aktenzeichen")
    )
    return text.strip_carriage_returns(raw)
