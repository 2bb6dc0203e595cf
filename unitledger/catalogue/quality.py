"""Queries for keys, duplicates, completeness and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.functions import dates
from unitledger.operators import profile
from unitledger.operators import snapshot as snap
from unitledger.operators.skew import first_per_key, keyed_join, ranked


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER
         (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""
)
def pk_first_wins(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return first_per_key(rows, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")])


@query(
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events) WHERE rn = 1"""
)
def batch_last_wins(t: Tables):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return first_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


REPEATED_EVENTS_SQL = """(SELECT event_id, ts, user_id, event_type, value FROM events
   UNION ALL SELECT event_id, ts + to_microseconds(event_id % 3), user_id, event_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END FROM events)"""


@query(
    f"""SELECT event_id, epoch_us(ts) AS us, user_id, event_type, value FROM (SELECT *, count(*) OVER (PARTITION BY event_id, ts, user_id, event_type, value) AS n FROM {REPEATED_EVENTS_SQL}) WHERE n > 1"""
)
def duplicate_groups_timestamps(t: Tables):
    """Repeats count only if they agree to the microsecond."""
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    events = t.events.select(*columns)
    later = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 3)
    again = events.withColumns({"ts": later, "value": F.when(F.col("event_id") % 5 > 0, F.col("value"))})
    both = events.withColumn("ts", F.col("ts").cast("timestamp")).unionByName(again)
    return profile.duplicated_rows(both).select("event_id", F.unix_micros("ts").alias("us"), "user_id", "event_type", "value")


@query(
    """SELECT doc_id, lang, source, n_chars FROM (SELECT *, count(*) OVER (PARTITION BY text, lang, n_chars) AS n FROM documents) WHERE n > 1"""
)
def duplicate_groups_all(t: Tables):
    return profile.duplicated_rows(t.documents, ignore=["doc_id", "source"]).select("doc_id", "lang", "source", "n_chars")


@query(
    """SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text, lang, n_chars ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def duplicate_groups_first(t: Tables):
    return profile.unique_rows(t.documents, [F.col("doc_id")], ignore=["doc_id", "source"]).select("doc_id", "lang", "n_chars")


@query("SELECT DISTINCT event_type, user_id FROM events")
def distinct_pairs(t: Tables):
    return t.events.select("event_type", "user_id").distinct()


@query(
    """SELECT c_custkey, mismatch FROM (SELECT c_custkey, n_regionkey <> c_custkey % 5 AS mismatch, row_number() OVER
         (PARTITION BY c_custkey ORDER BY n_regionkey <> c_custkey % 5, n_nationkey) AS rn
       FROM customer JOIN nation ON n_regionkey IN (c_nationkey % 5, c_custkey % 3)) WHERE rn = 1"""
)
def best_match_first(t: Tables):
    key = F.col("c_custkey")
    wanted = t.customer.select("c_custkey", F.explode(F.array_distinct(F.array(F.col("c_nationkey") % 5, (key % 3).cast("int")))).alias("n_regionkey"))
    pairs = keyed_join(wanted, t.nation.select("n_regionkey", "n_nationkey"), ["n_regionkey"], "inner")
    scored = pairs.select("c_custkey", "n_nationkey", (F.col("n_regionkey") != key % 5).alias("mismatch"))
    return first_per_key(scored, ["c_custkey"], [F.col("mismatch"), F.col("n_nationkey")]).select("c_custkey", "mismatch")


@query(
    """SELECT event_id, round(3 + (value - lo) * 17 / (hi - lo), 6) AS marker FROM events,
         (SELECT min(value) AS lo, max(value) AS hi FROM events)"""
)
def min_max_scale(t: Tables):
    scaled = profile.min_max_scaled(t.events.select("event_id", "value"), "value", 3.0, 20.0, "marker")
    return scaled.select("event_id", F.round("marker", 6).alias("marker"))


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders")
def ranked_curve(t: Tables):
    return ranked(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], "position")


@query("SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer")
def surrogate_ids(t: Tables):
    return ranked(t.customer.select("c_name"), [F.col("c_name")], "id")


LABELLED_SQL = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"


def labelled(t: Tables):
    return keyed_join(t.documents.select("doc_id", "lang", "source"), t.labels, ["doc_id"], "left")


@query(
    f"""WITH d AS {LABELLED_SQL}, w AS (SELECT count(*) AS n, count(doc_id) AS a, count(lang) AS b, count(source) AS c, count(quality) AS q, count(toxic) AS x FROM d)
        SELECT 'doc_id' AS column_name, round(100.0 * a / n, 4) AS filled_percent FROM w UNION ALL SELECT 'lang', round(100.0 * b / n, 4) FROM w
        UNION ALL SELECT 'source', round(100.0 * c / n, 4) FROM w UNION ALL SELECT 'quality', round(100.0 * q / n, 4) FROM w
        UNION ALL SELECT 'toxic', round(100.0 * x / n, 4) FROM w"""
)
def completeness_columns(t: Tables):
    return profile.completeness(labelled(t)).select("column_name", F.round("filled_percent", 4).alias("filled_percent"))


@query(
    f"""WITH r AS (SELECT doc_id AS k, 3 + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT AS filled FROM {LABELLED_SQL})
        SELECT count(*) AS n_rows, min(filled) AS min_filled, max(filled) AS max_filled, min(k) FILTER (filled = (SELECT min(filled) FROM r)) AS min_key,
               min(k) FILTER (filled = (SELECT max(filled) FROM r)) AS max_key FROM r"""
)
def completeness_rows(t: Tables):
    df = labelled(t)
    return profile.row_completeness(df, "doc_id", df.columns)


@query(
    """SELECT 'labels' AS table_name, 'doc_id' AS column_name, 100e0 AS filled_percent UNION ALL SELECT 'labels', 'quality', (SELECT round(100.0 * count(quality) / count(*), 4) FROM labels)
       UNION ALL SELECT 'labels', 'toxic', (SELECT round(100.0 * count(toxic) / count(*), 4) FROM labels)
       UNION ALL SELECT 'orders', 'o_orderkey', (SELECT round(100.0 * count(o_orderkey) / count(*), 4) FROM orders)
       UNION ALL SELECT 'orders', 'clerk', (SELECT round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 4) FROM orders)"""
)
def completeness_report(t: Tables):
    from unitledger.plans.quality import completeness_report as report

    clerk = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("clerk")
    shares = report({"labels": t.labels, "orders": t.orders.select("o_orderkey", clerk)})
    return shares.select("table_name", "column_name", F.round("filled_percent", 4).alias("filled_percent"))


@query(f"SELECT doc_id, lang, source FROM {LABELLED_SQL}")
def fill_ratio_columns(t: Tables):
    return profile.order_by_fill(labelled(t), min_share=0.9)


@query("SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest FROM events GROUP BY event_type")
def newest_per_type(t: Tables):
    newest = t.events.groupBy("event_type").agg(F.max("ts").alias("ts"))
    return newest.select("event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest"))


@query(
    """SELECT 'type' AS level, p_type AS a, NULL::VARCHAR AS b, NULL::INTEGER AS c, count(*) AS n FROM part GROUP BY p_type
       UNION ALL SELECT 'brand', p_type, p_brand, NULL, count(*) FROM part GROUP BY p_type, p_brand
       UNION ALL SELECT 'size', p_type, p_brand, p_size, count(*) FROM part GROUP BY p_type, p_brand, p_size"""
)
def grouped_counts_multi(t: Tables):
    a, b, c = F.col("p_type").alias("a"), F.col("p_brand").alias("b"), F.col("p_size").alias("c")
    levels = {"type": [a], "brand": [a, b], "size": [a, b, c]}
    source = t.part.select(a, b, c)
    counts = [profile.grouped_count(source, *["a", "b", "c"][: len(keys)]).withColumn("level", F.lit(level)) for level, keys in levels.items()]
    return snap.union_by_name([counts[2], counts[1], counts[0]])


@query("SELECT 'ALL' AS p_type, count(*) AS n FROM part UNION ALL SELECT p_type, count(*) FROM part GROUP BY p_type")
def total_plus_groups(t: Tables):
    return profile.total_and_groups(t.part, "p_type")


@query(f"SELECT count(*) AS n_rows, count(lang) AS n_lang, count(quality) AS n_quality, count(toxic) AS n_toxic FROM {LABELLED_SQL}")
def null_profile(t: Tables):
    return profile.null_profile(labelled(t), ["lang", "quality", "toxic"])


@query(
    """SELECT event_type, count(value) AS n, min(value) AS smallest, max(value) AS largest, round(sum(value), 2) AS total, round(avg(value), 4) AS mean
       FROM events GROUP BY event_type"""
)
def facts_table(t: Tables):
    return profile.facts(t.events, "event_type", "value").drop("mean").join(
        t.events.groupBy("event_type").agg(F.round(F.avg("value"), 4).alias("mean")), "event_type"
    )


@query("SELECT DISTINCT p_brand FROM part")
def unique_values(t: Tables):
    return t.part.select("p_brand").distinct()


@query(
    """WITH m AS (SELECT c_nationkey, (n_regionkey <> c_custkey % 5) AS mismatch FROM customer JOIN nation ON n_nationkey = c_nationkey)
       SELECT c_nationkey, count(*) FILTER (mismatch) AS mismatches, round(count(*) FILTER (mismatch) * 1.0 / (SELECT count(*) FROM m), 6) AS share
       FROM m GROUP BY c_nationkey"""
)
def mismatch_share(t: Tables):
    from unitledger.plans.quality import mismatch_totals

    joined = keyed_join(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, ["n_nationkey"], "inner")
    flagged = joined.select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") != F.col("c_custkey") % 5).alias("mismatch"))
    totals = mismatch_totals(flagged, "c_nationkey")
    return totals.select("c_nationkey", "mismatches", F.round("share", 6).alias("share"))


SETS_SQL = """(SELECT k, bool_or(s = 'c') AS customers, bool_or(s = 'b') AS buyers, bool_or(s = 'u') AS users FROM
  (SELECT c_custkey AS k, 'c' AS s FROM customer WHERE c_acctbal > 0 UNION ALL SELECT o_custkey, 'b' FROM orders WHERE o_orderstatus = 'F'
   UNION ALL SELECT user_id, 'u' FROM events) GROUP BY k)"""


def id_sets(t: Tables):
    return profile.membership(
        {
            "customers": t.customer.filter("c_acctbal > 0").select("c_custkey"),
            "buyers": t.orders.filter("o_orderstatus = 'F'").select("o_custkey"),
            "users": t.events.select("user_id"),
        },
        "k",
    )


@query(f"SELECT customers, buyers, users, count(*) AS n FROM {SETS_SQL} GROUP BY ALL")
def set_membership_matrix(t: Tables):
    return profile.combination_sizes(id_sets(t), ["customers", "buyers", "users"])


@query(f"SELECT k FROM {SETS_SQL} WHERE customers AND users AND NOT buyers")
def set_membership_filter(t: Tables):
    return id_sets(t).filter("customers and users and not buyers").select("k")


OVERLAP_SQL = """(SELECT k, kind, bool_or(s = 'a') AS a, bool_or(s = 'b') AS b FROM (SELECT c_custkey % 700 AS k, c_mktsegment AS kind, 'a' AS s FROM customer
  UNION ALL SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'AUTOMOBILE' END, 'b' FROM supplier) GROUP BY k, kind)"""


@query(
    f"""SELECT kind, count(*) FILTER (a AND NOT b) AS only_left, count(*) FILTER (a AND b) AS both, count(*) FILTER (b AND NOT a) AS only_right, count(*) AS total FROM {OVERLAP_SQL} GROUP BY kind
        UNION ALL SELECT 'sum', count(*) FILTER (a AND NOT b), count(*) FILTER (a AND b), count(*) FILTER (b AND NOT a), count(*) FROM {OVERLAP_SQL}"""
)
def set_overlap_totals(t: Tables):
    from unitledger.plans.quality import compare_registers

    ours = t.customer.select((F.col("c_custkey") % 700).alias("k"), F.col("c_mktsegment").alias("kind"))
    other = F.col("s_suppkey") % 3
    theirs = t.supplier.select(
        F.col("s_suppkey").alias("k"),
        F.when(other == 0, "BUILDING").when(other == 1, "MACHINERY").otherwise("AUTOMOBILE").alias("kind"),
    )
    return compare_registers(ours, theirs, "k", "kind")


@query(
    """SELECT 0 AS step, 'all' AS name, count(*) AS n FROM customer UNION ALL SELECT 1, 'positive', count(*) FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT 2, 'building', count(*) FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'"""
)
def funnel_counts(t: Tables):
    positive = F.col("c_acctbal") > 0
    steps = {"all": F.lit(True), "positive": positive, "building": positive & (F.col("c_mktsegment") == "BUILDING")}
    long = profile.funnel_flags(t.customer, steps)
    place = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("name")) - 1
    return long.select(place.cast("int").alias("step"), "name", "n")


@query(
    """SELECT p_partkey, CASE WHEN p_size > 30 THEN 31 ELSE p_size END AS bucket, p_size <= 30 AS small, (p_name IS NOT NULL) AS has_name, row_number() OVER
         (ORDER BY CASE WHEN p_size > 30 THEN 31 ELSE p_size END DESC NULLS LAST, p_type DESC NULLS LAST, p_partkey DESC NULLS LAST) AS position FROM part"""
)
def bucketed_full_sort(t: Tables):
    rows = t.part.select(
        F.when(F.col("p_size") > 30, 31).otherwise(F.col("p_size")).alias("bucket"),
        "p_type", "p_partkey", (F.col("p_size") <= 30).alias("small"), F.col("p_name").isNotNull().alias("has_name"),
    )
    order = [F.desc_nulls_last(c) for c in ["bucket", "p_type", "p_partkey"]]
    return ranked(rows, order, "position").drop("p_type")


@query("SELECT 'a' AS column_name UNION ALL SELECT 'p_size'")
def duplicate_columns(t: Tables):
    wide = t.part.select(
        "p_partkey", F.upper("p_name").alias("a"), "p_size", F.upper("p_name").alias("b"), F.col("p_size").alias("size_copy"),
        F.when(F.col("p_size") < 50, F.col("p_size")).alias("almost"), F.lower("p_name").alias("other"),
    )
    names = profile.duplicate_columns(wide, "p_partkey")
    return t.spark.createDataFrame([(n,) for n in names], "column_name string")


@query(
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus <> 'F') AS fetched, count(*) FILTER (o_orderstatus = 'F') AS missed FROM orders
       WHERE o_orderkey IS NOT NULL GROUP BY o_orderpriority"""
)
def batch_outcome_counts(t: Tables):
    from unitledger.streaming.mirror import outcome_counts

    replies = t.orders.select("o_orderpriority", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("reply"))
    return outcome_counts(replies, "reply", "o_orderpriority")


@query(
    """SELECT lang, round(100.0 * count(quality) / count(*), 4) AS quality_filled, count(*) AS n, strftime(DATE '2024-01-31', '%Y-%m-%d') AS day
       FROM (SELECT d.lang, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY lang"""
)
def completeness_per_group(t: Tables):
    filled = labelled(t).groupBy("lang").agg(
        F.round(F.avg(F.col("quality").isNotNull().cast("int")) * 100, 4).alias("quality_filled"), F.count(F.lit(1)).alias("n")
    )
    return filled.withColumn("day", dates.iso_date(F.lit("2024-01-31").cast("date")))
