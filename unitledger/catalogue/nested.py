"""Queries for nested replies, linked ids, tags and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.functions import dates, nested


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS "Hausnummer", event_type AS "Hersteller", CAST(user_id AS VARCHAR) AS "HerstellerId",
              CASE WHEN event_id % 4 > 0 THEN event_type || CASE WHEN event_id % 4 > 1 THEN ',' || user_id ELSE '' END END AS "ArtDerFlaeche",
              CASE WHEN event_id % 3 > 0 THEN 'SEE' || event_id || CASE WHEN event_id % 3 > 1 THEN ', SEE' || (event_id + 1) ELSE '' END ELSE '' END AS "VerknuepfteEinheiten"
       FROM events"""
)
def flatten_nested(t: Tables):
    n = F.col("event_id")

    def unit(offset):
        return F.struct(F.concat(F.lit("SEE"), n + offset).alias("MaStRNummer"), F.lit("Wind").alias("Einheittyp"))

    units = F.array(unit(0), unit(1))
    surfaces = F.array(F.col("event_type"), F.col("user_id").cast("string"))
    reply = t.events.select(
        "event_id",
        F.struct(F.get_json_object("props", "$.k").alias("Wert"), F.lit(False).alias("NichtVorhanden")).alias("Hausnummer"),
        F.struct(F.col("user_id").cast("string").alias("Id"), F.col("event_type").alias("Wert")).alias("Hersteller"),
        F.slice(surfaces, 1, F.least(n % 4, F.lit(2)).cast("int")).alias("ArtDerFlaeche"),
        F.slice(units, 1, (n % 3).cast("int")).alias("VerknuepfteEinheiten"),
    )
    return nested.flatten_reply(reply)


@query(
    """WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 4 AS n FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN n > 0 THEN 'P' || l_partkey ELSE '' END || CASE WHEN n > 1 THEN ', S' || l_suppkey ELSE '' END
              || CASE WHEN n > 2 THEN ', O' || l_orderkey ELSE '' END AS links,
              CASE WHEN n > 0 THEN 'part' || CASE WHEN n > 1 THEN ',supplier' ELSE '' END || CASE WHEN n > 2 THEN ',order' ELSE '' END END AS kinds,
              CASE WHEN n > 0 THEN 'P' || l_partkey END AS first_link
       FROM u"""
)
def linked_ids_join(t: Tables):
    def link(kind, letter, column):
        return F.struct(F.concat(F.lit(letter), column).alias("id"), F.lit(kind).alias("kind"))

    every = F.array(link("part", "P", "l_partkey"), link("supplier", "S", "l_suppkey"), link("order", "O", "l_orderkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.slice(every, 1, F.col("l_linenumber") % 4).alias("all_links"))
    wide = lines.select("*", *nested.columns_of_arrays(F.col("all_links"), ["id", "kind"]))
    return wide.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        nested.joined_ids(F.col("all_links"), "id").alias("links"),
        nested.joined_list(F.col("kind")).alias("kinds"),
        nested.first_as_text(F.col("id")).alias("first_link"),
    )


def event_tags(t: Tables):
    kind, n = F.col("event_type"), F.col("event_id")
    tags = F.create_map(F.lit("processed"), F.lit("true"))
    tags = nested.merge_tags(tags, {"location": "onshore"}, kind == "click")
    tags = nested.merge_tags(tags, {"location": "offshore"}, kind == "view")
    tags = nested.merge_tags(tags, {"location": "na"}, ~kind.isin("click", "view"))
    tags = nested.merge_tags(tags, {"flag": "A"}, n % 2 == 0)
    tags = nested.merge_tags(tags, {"flag": "B"}, n % 6 == 0)
    return t.events.select("event_id", tags.alias("tags"))


TAGS_SQL = """(SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'B' WHEN event_id % 2 = 0 THEN 'A' END AS flag,
    CASE event_type WHEN 'click' THEN 'onshore' WHEN 'view' THEN 'offshore' ELSE 'na' END AS location FROM events)"""


@query(f"SELECT COALESCE('flag=' || flag || ';', '') || 'location=' || location || ';processed=true' AS tags, count(*) AS n FROM {TAGS_SQL} GROUP BY 1")
def tags_merge_histogram(t: Tables):
    return event_tags(t).groupBy(nested.tags_text(F.col("tags")).alias("tags")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT location, true AS processed, count(*) AS n, count(*) FILTER (flag IS NOT NULL) AS with_flag
        FROM {TAGS_SQL} WHERE location <> 'na' GROUP BY location"""
)
def tags_field_counts(t: Tables):
    tags = F.col("tags")
    kept = event_tags(t).filter(nested.tag(tags, "location") != "na")
    return kept.groupBy(nested.tag(tags, "location").alias("location"), nested.tag_is_true(tags, "processed").alias("processed")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.map_contains_key("tags", "flag")).alias("with_flag")
    )


@query(
    """SELECT event_id, '{"event_type":"' || event_type || '","k":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE json_extract_string(props, '$.k') END
              || ',"user_id":' || user_id || '}' AS doc,
              '[{"k":' || json_extract_string(props, '$.k') || ',"n":' || event_id || '}]' AS list_doc FROM events"""
)
def json_serialise(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    with_struct = t.events.select(
        "event_id",
        F.struct("user_id", "event_type", F.when(F.col("event_id") % 5 != 0, k).alias("k")).alias("s"),
        F.array(F.struct(F.col("event_id").alias("n"), k.alias("k"))).alias("a"),
    )
    return with_struct.select(
        "event_id",
        nested.sorted_json(F.col("s"), ["user_id", "event_type", "k"]).alias("doc"),
        nested.sorted_json_list(F.col("a"), ["n", "k"]).alias("list_doc"),
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '=' || CAST(floor(o_totalprice) AS BIGINT) || ';' ||
              strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') || '=' || CAST(floor(o_totalprice / 2) AS BIGINT) AS history,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS first_change
       FROM orders"""
)
def iso_date_nested(t: Tables):
    day, price = F.col("o_orderdate"), F.col("o_totalprice")
    later = day + F.make_dt_interval(F.lit(30))
    changes = F.array(
        F.struct(day.alias("at"), price.alias("price")), F.struct(later.alias("at"), (price / 2).alias("price"))
    )
    texts = F.transform(
        changes, lambda c: F.concat(dates.iso_date(c["at"]), F.lit("="), F.floor(c["price"]).cast("string"))
    )
    return t.orders.select("o_orderkey", F.array_join(texts, ";").alias("history"), dates.iso_timestamp(day).alias("first_change"))


@query(
    "SELECT l_orderkey, "
    + ", ".join(f"round(sum(l_extendedprice) FILTER (l_linenumber = {i}), 2) AS slot{i}" for i in range(1, 8))
    + " FROM lineitem GROUP BY l_orderkey"
)
def transpose_key_values(t: Tables):
    """Key and value rows of an order as one row with a column per key."""
    pairs = t.lineitem.select("l_orderkey", F.concat(F.lit("slot"), "l_linenumber").alias("key"), F.col("l_extendedprice").alias("value"))
    return pairs.groupBy("l_orderkey").pivot("key", [f"slot{i}" for i in range(1, 8)]).agg(F.round(F.sum("value"), 2))


@query(
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, CAST(round(embedding[1], 6) AS DOUBLE) AS first_value, label FROM embeddings"""
)
def array_first_element(t: Tables):
    return t.embeddings.select(
        "vec_id", F.size("embedding").alias("size"), F.round(F.try_element_at("embedding", F.lit(1)), 6).cast("double").alias("first_value"), "label"
    )


@query(
    """SELECT conv_id, turn, replace(text, chr(10), ', ') AS lines, string_split(text, chr(10))[1] AS first_line,
              CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines FROM conversations"""
)
def text_line_lists(t: Tables):
    lines = F.split("text", "\n")
    return t.conversations.select(
        "conv_id", "turn",
        nested.joined_ids(F.transform(lines, lambda x: F.struct(x.alias("line"))), "line").alias("lines"),
        nested.first_as_text(lines).alias("first_line"), F.size(lines).alias("n_lines"),
    )
