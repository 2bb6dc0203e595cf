"""Queries for joins, set operations, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.operators import relational as rel
from unitledger.operators import snapshot as snap
from unitledger.operators.skew import keyed_join
from unitledger.plans import worklist

BASIC_SQL = """
  SELECT 'SEE' || o_orderkey AS "EinheitMastrNummer", o_orderpriority AS "Einheittyp",
         CASE WHEN o_orderstatus <> 'F' THEN 'EEG' || o_custkey END AS "EegMastrNummer",
         CASE WHEN o_orderstatus = 'P' THEN 'KWK' || (o_orderkey % 250) END AS "KwkMastrNummer",
         o_totalprice AS "Erzeugungsleistung", o_orderstatus AS "BestandsanlageMastrNummer"
  FROM orders"""


def basic_units(t: Tables):
    return t.orders.select(
        F.concat(F.lit("SEE"), "o_orderkey").alias("EinheitMastrNummer"),
        F.col("o_orderpriority").alias("Einheittyp"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("EEG"), "o_custkey")).alias("EegMastrNummer"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("KWK"), F.col("o_orderkey") % 250)).alias("KwkMastrNummer"),
        F.col("o_totalprice").alias("Erzeugungsleistung"),
        F.col("o_orderstatus").alias("BestandsanlageMastrNummer"),
    )


def unit_details(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("Bruttoleistung"))
    extended = lines.select(F.concat(F.lit("SEE"), "l_orderkey").alias("EinheitMastrNummer"), "Bruttoleistung")
    eeg = t.customer.select(
        F.concat(F.lit("EEG"), "c_custkey").alias("EegMastrNummer"),
        F.col("c_mktsegment").alias("Meldedatum"),
        F.col("c_acctbal").alias("InstallierteLeistung"),
    )
    kwk = t.supplier.select(
        F.concat(F.lit("KWK"), "s_suppkey").alias("KwkMastrNummer"),
        F.col("s_name").alias("Meldedatum"),
        F.col("s_acctbal").alias("ThermischeNutzleistung"),
    )
    return {"extended": extended, "eeg": eeg, "kwk": kwk}


SNAPSHOT_COLUMNS = """b."EinheitMastrNummer", b."Einheittyp", b."EegMastrNummer", b."KwkMastrNummer",
  b."Erzeugungsleistung", b."BestandsanlageMastrNummer" AS "BestandsanlageMastrNummer_basic",
  x."EinheitMastrNummer" AS "EinheitMastrNummer_extended", x."Bruttoleistung" AS "Bruttoleistung_extended",
  e."EegMastrNummer" AS "EegMastrNummer_eeg", e."Meldedatum" AS "Meldedatum_eeg", e."InstallierteLeistung",
  k."KwkMastrNummer" AS "KwkMastrNummer_kwk", k."Meldedatum" AS "Meldedatum_kwk", k."ThermischeNutzleistung" """

SNAPSHOT_FROM = f"""FROM ({BASIC_SQL}) b
  LEFT JOIN (SELECT 'SEE' || l_orderkey AS "EinheitMastrNummer", sum(l_quantity) AS "Bruttoleistung"
             FROM lineitem GROUP BY l_orderkey) x ON x."EinheitMastrNummer" = b."EinheitMastrNummer"
  LEFT JOIN (SELECT 'EEG' || c_custkey AS "EegMastrNummer", c_mktsegment AS "Meldedatum",
             c_acctbal AS "InstallierteLeistung" FROM customer) e ON e."EegMastrNummer" = b."EegMastrNummer"
  LEFT JOIN (SELECT 'KWK' || s_suppkey AS "KwkMastrNummer", s_name AS "Meldedatum",
             s_acctbal AS "ThermischeNutzleistung" FROM supplier) k ON k."KwkMastrNummer" = b."KwkMastrNummer"
  WHERE b."Einheittyp" = '1-URGENT'"""


@query(f"SELECT {SNAPSHOT_COLUMNS} {SNAPSHOT_FROM}")
def snapshot_join(t: Tables):
    return snap.technology_snapshot(basic_units(t), unit_details(t), "1-URGENT")


@query(f'SELECT {SNAPSHOT_COLUMNS} {SNAPSHOT_FROM} ORDER BY b."EinheitMastrNummer" LIMIT 100')
def snapshot_limited(t: Tables):
    return snap.technology_snapshot(basic_units(t), unit_details(t), "1-URGENT", limit=100)


@query(
    """SELECT o_orderkey AS k, o_orderpriority AS name, c_custkey AS k_1, c_name AS name_1,
              s_suppkey AS k_2, s_name AS name_2
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_orderkey"""
)
def snapshot_duplicate_name_rule(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("name"), "o_custkey")
    customer = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return snap.left_join_details(orders, [(customer, "o_custkey", "k"), (supplier, "k", "k")]).drop("o_custkey")


@query(
    """SELECT name, nation, balance, kind FROM (
         SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, 'customer' AS kind FROM customer
         UNION ALL SELECT s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
         UNION ALL SELECT p_name, NULL, NULL, 'part' FROM part)"""
)
def reverse_fill_union(t: Tables):
    strip = {"customer": "c_", "supplier": "s_", "part": "p_"}
    tables = {
        kind: getattr(t, kind).withColumnsRenamed(
            {f"{p}name": "name", f"{p}nationkey": "nation", f"{p}acctbal": "balance"}
        )
        for kind, p in strip.items()
    }
    return snap.reverse_fill(tables, ["name", "nation", "balance", "kind"], "kind")


@query(
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)"""
)
def anti_missing_detail(t: Tables):
    finished = t.orders.filter("o_orderstatus = 'F'")
    return rel.missing_detail(t.customer.select("c_custkey", "c_name"), finished, "c_custkey", "o_custkey")


@query(
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS has_urgent
       FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')"""
)
def semi_existing_keys(t: Tables):
    open_customers = rel.existing_keys(t.customer.select("c_custkey"), t.orders.filter("o_orderstatus = 'O'"), "c_custkey", "o_custkey")
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return rel.member_flag(open_customers, "c_custkey", urgent, "o_custkey", "has_urgent")


@query(
    """SELECT e.event_id, e.user_id FROM events e WHERE e.event_id % 2 = 0 AND EXISTS
         (SELECT 1 FROM events s WHERE s.event_id % 2 = 1 AND s.user_id = e.user_id AND s.ts < e.ts)"""
)
def exists_older_version(t: Tables):
    """Every other event is in the batch, all the rest are stored."""
    batch, stored = t.events.filter("event_id % 2 = 0"), t.events.filter("event_id % 2 = 1")
    return rel.has_older_version(batch, stored, "user_id", "ts").select("event_id", "user_id")


@query(
    """SELECT o.o_orderkey, c.c_name AS customer_name, n.n_name AS customer_nation, s.s_name AS supplier_name
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey"""
)
def multi_key_left_join(t: Tables):
    customer = t.customer.select("c_custkey", F.col("c_name").alias("customer_name"), "c_nationkey")
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("customer_nation"))
    supplier = t.supplier.select("s_suppkey", F.col("s_name").alias("supplier_name"))
    joined = snap.left_join_details(
        t.orders.select("o_orderkey", "o_custkey"),
        [(customer, "o_custkey", "c_custkey"), (supplier, "o_custkey", "s_suppkey")],
    )
    with_nation = snap.left_join_details(joined, [(nation, "c_nationkey", "n_nationkey")])
    return with_nation.select("o_orderkey", "customer_name", "customer_nation", "supplier_name")


@query(
    """SELECT c.c_custkey AS key, c.c_name AS name_x, s.s_name AS name_y, c.c_acctbal AS acctbal_x, s.s_acctbal AS acctbal_y
       FROM customer c JOIN supplier s ON c.c_custkey = s.s_suppkey"""
)
def merge_overlap_suffix(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    right = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    shared = ["name", "acctbal"]
    return snap.suffixed(left, shared, "x").join(snap.suffixed(right, shared, "y"), "key")


@query(
    """SELECT n.n_nationkey, n.n_name, a.customers, a.balance FROM nation n LEFT JOIN
         (SELECT c_nationkey, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
          WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9000 GROUP BY c_nationkey) a ON a.c_nationkey = n.n_nationkey"""
)
def aggregate_join_back(t: Tables):
    rich = t.customer.filter("c_mktsegment = 'MACHINERY' AND c_acctbal > 9000")
    return rel.join_back(
        t.nation.select("n_nationkey", "n_name"),
        rich.withColumnRenamed("c_nationkey", "n_nationkey"),
        "n_nationkey",
        {"customers": F.count(F.lit(1)), "balance": F.round(F.sum("c_acctbal"), 2)},
    )


CANDIDATES_SQL = """
  WITH u AS (SELECT c_custkey AS id, c_custkey % 499 AS plz, CAST(floor(c_acctbal / 5000) AS BIGINT) AS power,
             CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'old'
                  WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 'new' END AS side FROM customer),
  g AS (SELECT plz, power, count(*) FILTER (side = 'old') AS n_old, count(*) FILTER (side = 'new') AS n_new
        FROM u GROUP BY plz, power)"""


def _sided(t: Tables):
    units = t.customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") % 499).alias("plz"),
        F.floor(F.col("c_acctbal") / 5000).cast("bigint").alias("power"), "c_mktsegment",
    )
    segment = F.col("c_mktsegment")
    return units, segment.isin("BUILDING", "AUTOMOBILE"), segment.isin("MACHINERY", "HOUSEHOLD")


@query(
    CANDIDATES_SQL
    + """ SELECT u.plz, u.power, u.side, u.id, g.n_old, g.n_new FROM u JOIN g ON u.plz = g.plz AND u.power = g.power
          WHERE u.side IS NOT NULL AND g.n_old > 0 AND g.n_new > 0"""
)
def self_join_candidates(t: Tables):
    units, old, new = _sided(t)
    return rel.duplicate_candidates(units, ["plz", "power"], "id", old, new)


@query(
    CANDIDATES_SQL
    + """, a AS (SELECT plz, count(*) FILTER (side = 'new') AS all_new FROM u GROUP BY plz)
         SELECT u.plz, u.power, u.side, u.id, g.n_old, g.n_new FROM u JOIN g ON u.plz = g.plz AND u.power = g.power
         JOIN a ON a.plz = u.plz WHERE u.side IS NOT NULL AND g.n_old > 0 AND g.n_new > 0 AND g.n_new = a.all_new"""
)
def self_join_candidates_strict(t: Tables):
    units, old, new = _sided(t)
    return rel.duplicate_candidates(units, ["plz", "power"], "id", old, new, strict=True)


@query(
    """SELECT c.c_custkey, c.c_name, o.o_orderdate_text AS newest_order, o.o_totalprice AS newest_price FROM customer c
       JOIN (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_text, o_totalprice, row_number() OVER
             (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
       ON o.o_custkey = c.c_custkey AND o.rn = 1"""
)
def key_supplement_last_wins(t: Tables):
    source = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("newest_order"),
        F.col("o_totalprice").alias("newest_price"), "o_orderdate", "o_orderkey",
    )
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return rel.supplement_by_key(t.customer.select("c_custkey", "c_name"), source, "c_custkey", ["newest_order", "newest_price"], order)


@query(
    """SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE -1 END AS quality,
              CASE WHEN l.doc_id IS NOT NULL THEN l.toxic ELSE -1 END AS toxic
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
)
def label_update_by_key(t: Tables):
    units = t.documents.select("doc_id", "lang", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic"))
    return rel.update_by_key(units, t.labels, "doc_id", ["quality", "toxic"])


@query(
    """SELECT d.doc_id, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id
       WHERE d.lang = 'en' AND l.quality IS NOT NULL"""
)
def label_export_filter(t: Tables):
    relevant = t.documents.filter("lang = 'en'").select("doc_id")
    return keyed_join(relevant, t.labels, ["doc_id"], "inner").filter("quality is not null").select("doc_id", "quality", "toxic")


@query(
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS credit, NULL::VARCHAR AS type FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier"""
)
def union_missing_columns(t: Tables):
    customer = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("credit"))
    supplier = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("type"))
    return snap.union_by_name([customer, supplier])


@query(
    """SELECT 'both' AS part, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
       UNION ALL SELECT 'only_customer', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""
)
def key_intersection_difference(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("k"))
    buyers = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    both = customers.intersect(buyers).select(F.lit("both").alias("part"), "k")
    return both.unionAll(customers.subtract(buyers).select(F.lit("only_customer").alias("part"), "k"))


@query(
    """SELECT nation, count(*) AS n, round(sum(balance), 2) AS balance FROM
       (SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier)
       GROUP BY nation"""
)
def concat_then_group(t: Tables):
    parts = [
        t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
    ]
    return snap.union_by_name(parts).groupBy("nation").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance"))


@query(
    """SELECT p_partkey, p_name FROM part WHERE regexp_matches(upper(left(p_type, 3)), '^[S,M][T,E,M][A,D]')
       AND contains(p_name, 'ring') AND NOT starts_with(p_name, 'red')"""
)
def prefix_class_filter(t: Tables):
    head = F.upper(F.left("p_type", F.lit(3)))
    kept = t.part.filter(head.rlike("^[S,M][T,E,M][A,D]"))
    return kept.filter(F.col("p_name").contains("ring") & ~F.col("p_name").startswith("red")).select("p_partkey", "p_name")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '1998-01-31' THEN 'before' ELSE 'after' END AS part
       FROM orders WHERE o_orderdate IS NOT NULL"""
)
def date_threshold_split(t: Tables):
    cut = F.lit("1998-01-31").cast("timestamp")
    dated = t.orders.filter(F.col("o_orderdate").isNotNull()).select("o_orderkey", "o_orderdate")
    before = dated.filter(F.col("o_orderdate") <= cut).withColumn("part", F.lit("before"))
    after = dated.filter(F.col("o_orderdate") > cut).withColumn("part", F.lit("after"))
    return before.unionByName(after).select("o_orderkey", "part")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS "EinheitMastrNummer", CAST(floor(c_acctbal) AS INTEGER) AS "Bruttoleistung",
              n_name AS "Bundesland", 'bulk' AS "DatenQuelle", '2024-01-31' AS "DatumDownload", 'Deutschland' AS "Land",
              NULL::VARCHAR AS "Name"
       FROM customer JOIN nation ON n_nationkey = c_nationkey"""
)
def rename_project_cast(t: Tables):
    joined = keyed_join(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, ["n_nationkey"], "inner")
    renamed = joined.withColumnsRenamed({"c_custkey": "EinheitMastrNummer", "n_name": "Bundesland"}).drop("c_mktsegment", "n_regionkey")
    typed = renamed.withColumns(
        {
            "EinheitMastrNummer": F.col("EinheitMastrNummer").cast("string"),
            "Bruttoleistung": F.floor("c_acctbal").cast("int"),
            "DatenQuelle": F.lit("bulk"),
            "DatumDownload": F.lit("2024-01-31"),
            "Land": F.lit("Deutschland"),
            "Name": F.lit(None).cast("string"),
        }
    )
    return typed.select("EinheitMastrNummer", "Bruttoleistung", "Bundesland", "DatenQuelle", "DatumDownload", "Land", "Name")


@query(
    """WITH u AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS ags,
              c_custkey * 7919 % 500 - 250.0 AS lon, c_custkey * 104729 % 250 - 125.0 AS lat, c_mktsegment FROM customer)
       SELECT c_custkey, substr(ags, 1, 5) AS district, substr(ags, 1, 2) AS state FROM u
       WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND substr(ags, 1, 2) >= '02' AND c_mktsegment = 'BUILDING'"""
)
def region_prefix_filters(t: Tables):
    key = F.col("c_custkey")
    units = t.customer.select(
        "c_custkey", "c_mktsegment",
        F.lpad((key * 7919 % 100000000).cast("string"), 8, "0").alias("ags"),
        (key * 7919 % 500 - 250.0).alias("lon"), (key * 104729 % 250 - 125.0).alias("lat"),
    )
    placed = units.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    picked = placed.filter((F.substring("ags", 1, 2) >= "02") & (F.col("c_mktsegment") == "BUILDING"))
    return picked.select("c_custkey", F.substring("ags", 1, 5).alias("district"), F.substring("ags", 1, 2).alias("state"))


@query(
    """SELECT p_partkey, round(CASE WHEN p_retailprice > 950 THEN p_retailprice / 10 ELSE p_retailprice END, 3) AS price,
              CASE WHEN p_retailprice > 950 THEN 'capacity=reduce/10' ELSE '' END AS tags
       FROM part WHERE p_size > 5"""
)
def conditional_scale_delete(t: Tables):
    too_big = F.col("p_retailprice") > 950
    located = t.part.withColumn("position", F.when(F.col("p_size") > 5, F.col("p_size"))).filter(F.col("position").isNotNull())
    return located.select(
        "p_partkey",
        F.round(F.when(too_big, F.col("p_retailprice") / 10).otherwise(F.col("p_retailprice")), 3).alias("price"),
        F.when(too_big, "capacity=reduce/10").otherwise("").alias("tags"),
    )


@query(
    """SELECT c.c_custkey, COALESCE(o.flag, c.c_acctbal > 0) AS in_credit FROM customer c
       LEFT JOIN (SELECT s_suppkey, s_acctbal > 5000 AS flag FROM supplier) o ON o.s_suppkey = c.c_custkey
       WHERE c.c_custkey NOT IN (SELECT n_nationkey FROM nation)"""
)
def override_and_exclude(t: Tables):
    flags = t.customer.select("c_custkey", (F.col("c_acctbal") > 0).alias("in_credit"))
    overrides = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), (F.col("s_acctbal") > 5000).alias("in_credit"))
    exclusions = t.nation.select(F.col("n_nationkey").cast("bigint").alias("c_custkey"))
    return rel.override_flags(flags, overrides, exclusions, "c_custkey", ["in_credit"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1999-01-01'
         AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))"""
)
def delete_by_keys(t: Tables):
    building = t.customer.filter("c_mktsegment = 'BUILDING'")
    stale = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))
    return rel.drop_keys(t.orders, building, "o_custkey", "c_custkey", where=stale).select("o_orderkey", "o_custkey")


@query(
    """SELECT c.c_custkey, COALESCE(m.best, 'none') AS match, m.best IS NOT NULL AS matched FROM customer c LEFT JOIN
         (SELECT o_custkey, min(o_orderpriority) AS best FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) m
       ON m.o_custkey = c.c_custkey"""
)
def writeback_matches(t: Tables):
    units = t.customer.select("c_custkey", F.lit("none").alias("match"), F.lit(False).alias("matched"))
    pairs = (
        t.orders.filter("o_orderstatus = 'F'")
        .select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("best"), F.lit(True).alias("hit"))
        .distinct()
    )
    return rel.write_back(units, pairs, "c_custkey", {"match": "best", "matched": "hit"})


@query("SELECT * FROM (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderpriority = '2-HIGH' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50)")
def ordered_top_n(t: Tables):
    newest = t.orders.filter("o_orderpriority = '2-HIGH'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)
    return newest.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' ORDER BY md5(event_id || '-42'), event_id LIMIT 10")
def random_pick(t: Tables):
    """A reproducible random choice of ten relevant units (the sample size is the feature)."""
    units = t.events.withColumn("manval_relevant", F.col("event_type") == "purchase")
    return worklist.pick_random(units, 10, seed=42, key="event_id").select("event_id", "user_id", "value")


@query("SELECT c.c_custkey AS customer_key, c.c_name AS customer_name, o.o_totalprice AS order_price, o.o_orderstatus FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey")
def translate_columns(t: Tables):
    """Names that would clash (two columns called `customer_key`, or `customer_name`) stay as they are."""
    names = {"c_custkey": "customer_key", "c_name": "customer_name", "o_totalprice": "order_price", "o_custkey": "customer_key", "o_orderstatus": "customer_name"}
    customer = snap.translate_columns(t.customer, names)
    joined = customer.join(t.orders.withColumnRenamed("o_custkey", "customer_key"), "customer_key")
    return snap.translate_columns(joined, names).select("customer_key", "customer_name", "order_price", "o_orderstatus")
