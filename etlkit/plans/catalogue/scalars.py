"""Column functions on whole texts, dates, arrays, maps, structs and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit import functions as fn
from etlkit.plans.catalogue.registry import query
from etlkit.streaming.inputs import parse_envelope
from etlkit.streaming.sinks import to_kafka_value

_CLEAN_SQL = r"trim(regexp_replace(lower(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g')), '\s+', ' ', 'g'))"


def _documents(t):
    """Whole texts; regular expressions over them are the work, so all cores should share it."""
    return t.documents.select("doc_id", "text")


@query(f"SELECT doc_id, {_CLEAN_SQL} AS cleaned FROM documents")
def clean_texts(t):
    return _documents(t).select("doc_id", fn.clean_text(F.col("text")).alias("cleaned"))


@query(f"""
    SELECT doc_id, parts[1] AS first_token, parts[-1] AS last_token, CAST(len(parts) AS INTEGER) AS tokens
    FROM (SELECT doc_id, string_split({_CLEAN_SQL}, ' ') AS parts FROM documents)
""")
def text_parts(t):
    text = F.col("text")
    return _documents(t).select(
        "doc_id", fn.first_token(text).alias("first_token"), fn.last_token(text).alias("last_token"),
        F.size(fn.name_parts(text)).alias("tokens"),
    )


@query("""
    SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS name_length, upper(p_name) AS name_upper,
           array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS name_title,
           p_brand || '/' || p_type AS joined, concat_ws('-', p_brand, p_type, p_name) AS tagged
    FROM part
""")
def string_basics(t):
    return t.part.select(
        "p_partkey", F.length("p_name").alias("name_length"), F.upper("p_name").alias("name_upper"),
        F.initcap("p_name").alias("name_title"), F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.concat_ws("-", "p_brand", "p_type", "p_name").alias("tagged"),
    )


@query("SELECT doc_id, true AS same_for_copies FROM documents")
def murmur_hash(t):
    """Hashes of texts: a copy of a text, made by splitting and joining it, has the same hash."""
    copy = F.concat(F.substring("text", 1, 7), F.expr("substring(text, 8)"))
    return t.documents.select("doc_id", ((F.hash("text") == F.hash(copy)) & (F.hash("text") != F.hash(F.concat("text", F.lit("x"))))).alias("same_for_copies"))


@query("SELECT doc_id, base64(encode(text)) AS text_base64, md5(text) AS text_md5 FROM documents")
def base64_and_md5(t):
    # Spark breaks long base64 into lines of 76 characters.
    encoded = F.replace(F.base64(F.col("text").cast("binary")), F.lit("\r\n"), F.lit(""))
    return _documents(t).select("doc_id", encoded.alias("text_base64"), F.md5("text").alias("text_md5"))


# Letters to digits, H and W (7) left out, runs of one digit joined, vowels (0) left out, three digits.
_SOUNDEX_RUNS = "c1[1] || replace(c1[2:], '7', '')"
for _digit in "0123456":
    _SOUNDEX_RUNS = f"regexp_replace({_SOUNDEX_RUNS}, '{_digit}+', '{_digit}', 'g')"


@query(f"""
    SELECT p_partkey, upper(p_name)[1] || substr(replace(({_SOUNDEX_RUNS})[2:], '0', '') || '000', 1, 3) AS name_soundex
    FROM (SELECT p_partkey, p_name,
                 translate(upper(p_name), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ ', '012301270224550126230172020') AS c1 FROM part)
""")
def soundex_codes(t):
    return t.part.select("p_partkey", F.soundex("p_name").alias("name_soundex"))


@query("""
    SELECT p_partkey, levenshtein(lower(p_type), string_split(p_name, ' ')[1]) AS distance,
           levenshtein(lower(p_type), string_split(p_name, ' ')[1]) < 3 AS names_similar
    FROM part
""")
def edit_distance(t):
    kind, word = F.lower("p_type"), F.element_at(F.split("p_name", " "), 1)
    return t.part.select(
        "p_partkey", F.levenshtein(kind, word).cast("bigint").alias("distance"), fn.similar(kind, word).alias("names_similar")
    )


@query(r"""
    SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS protocol, regexp_extract(url, '://([^/]+)', 1) AS domain,
           regexp_extract(url, '://[^/]+(/.*)', 1) AS path
    FROM pages
""")
def url_components(t):
    return t.pages.select("page_id", fn.url_parts(F.col("url")).alias("u")).select("page_id", "u.*")


@query("""
    SELECT c_custkey, lower(c_mktsegment) || '.com' AS domain,
           lpad(CAST(c_nationkey + 200 AS VARCHAR), 3, '0') AS area,
           CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_nationkey + 200 AS VARCHAR), 3, '0') ELSE '' END AS area_code,
           '(' || (c_nationkey + 200) || ') 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone
    FROM customer
""")
def contact_details(t):
    """E-mail and phone texts are built from each customer, then taken apart again."""
    area = (F.col("c_nationkey") + 200).cast("string")
    number = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    phone = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("("), area, F.lit(") 555 "), number)).otherwise(
        F.concat_ws(".", area, F.lit("555"), number)
    )
    rows = t.customer.select(
        "c_custkey", phone.alias("p"), F.concat("c_name", F.lit("@"), "c_mktsegment", F.lit(".COM")).alias("email"), area.alias("area")
    )
    return rows.select(
        "c_custkey", fn.email_domain(F.col("email")).alias("domain"), "area",
        fn.area_code(F.col("p")).alias("area_code"), fn.format_phone(F.col("p")).alias("phone"),
    )


@query(r"""
    SELECT doc_id, CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS words,
           CAST(length(regexp_replace(text, '\s', '', 'g')) AS INTEGER) AS characters
    FROM documents
""")
def text_counts(t):
    text = F.col("text")
    return _documents(t).select(
        "doc_id", fn.word_count(text).alias("words"), fn.no_space_length(text).alias("characters")
    )


@query("""
    SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS processing_timestamp, CAST(o_orderdate AS DATE) AS processing_date,
           strftime(o_orderdate, '%Y-%m-%d') AS processing_date_text, '01:30:00' AS processing_time_text,
           CAST(epoch(o_orderdate + INTERVAL 90 MINUTE) AS BIGINT) AS processing_unix
    FROM orders
""")
def processing_stamps(t):
    at = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 90 MINUTES")
    return fn.stamp(t.orders.select("o_orderkey", "o_orderdate"), at).drop("o_orderdate")


@query("""
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, DATE '2002-01-31' AS ref FROM orders)
    SELECT o_orderkey, CAST(day + 30 AS DATE) AS date_plus_30, CAST(day - 7 AS DATE) AS date_minus_7,
           CAST(date_diff('day', day, ref) AS INTEGER) AS days_since,
           round((year(ref) - year(day)) * 12 + month(ref) - month(day)
             + CASE WHEN day(ref) = day(day) OR (day = last_day(day) AND ref = last_day(ref)) THEN 0
                    ELSE (day(ref) - day(day)) / 31.0 END, 8)::DOUBLE AS months_since
    FROM d
""")
def date_arithmetic(t):
    day, at = F.to_date("o_orderdate"), F.lit("2002-01-31").cast("date")
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in fn.date_math(day, at).items()])


@query("""
    SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) + INTERVAL 7 DAY AS DATE) AS next_monday,
           last_day(o_orderdate) AS month_end
    FROM orders
""")
def next_and_last_day(t):
    return t.orders.select(
        "o_orderkey", F.next_day("o_orderdate", "Mon").alias("next_monday"), F.last_day("o_orderdate").alias("month_end")
    )


_PARTS_SQL = ", ".join(f"CAST({f} AS INTEGER) AS {n}" for n, f in {
    "year": "year(ts)", "quarter": "quarter(ts)", "month": "month(ts)", "day": "day(ts)", "week_of_year": "week(ts)",
    "day_of_week": "dayofweek(ts) + 1", "day_of_year": "dayofyear(ts)", "hour": "hour(ts)", "minute": "minute(ts)",
    "second": "second(ts)",
}.items())


@query(f"SELECT event_id, {_PARTS_SQL} FROM events")
def calendar_parts(t):
    parts = fn.date_parts(F.col("ts")) | fn.time_parts(F.col("ts"))
    return t.events.select("event_id", *[c.alias(n) for n, c in parts.items()])


_ZONES_SQL = "CASE event_type WHEN 'view' THEN 'America/Los_Angeles' WHEN 'click' THEN 'Europe/Paris' ELSE 'UTC' END"


@query(f"""
    SELECT event_id, (ts AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS utc_ts,
           (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS eastern_ts,
           (ts AT TIME ZONE {_ZONES_SQL}) AT TIME ZONE 'UTC' AS per_row_utc
    FROM events
""")
def time_zones(t):
    zone = (
        F.when(F.col("event_type") == "view", "America/Los_Angeles").when(F.col("event_type") == "click", "Europe/Paris")
        .otherwise("UTC")
    )
    made = {
        "utc_ts": fn.to_utc("ts", "America/Los_Angeles"), "eastern_ts": fn.from_utc("ts", "America/New_York"),
        "per_row_utc": fn.to_utc("ts", zone),
    }
    return t.events.select("event_id", *[c.cast("timestamp_ntz").alias(n) for n, c in made.items()])


@query("""
    SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS weekend,
           CAST(o_orderdate + INTERVAL (CASE dayofweek(o_orderdate) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END) DAY AS DATE)
             AS business_day,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start
    FROM orders
""")
def business_days(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", fn.is_weekend(day).alias("weekend"), fn.next_business_day(day).alias("business_day"),
        fn.quarter_start(day).alias("quarter_start"),
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_iso, strftime(o_orderdate, '%m/%d/%Y') AS date_us,
           strftime(o_orderdate, '%B %d, %Y') AS date_verbose,
           CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed
    FROM orders
""")
def date_formats(t):
    """Every tenth date text is unreadable and parses to NULL."""
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 10 == 0, "not a date").otherwise(fn.format_date(day, "us"))
    return t.orders.select(
        "o_orderkey", *[fn.format_date(day, s).alias(f"date_{s}") for s in ("iso", "us", "verbose")],
        fn.parse_date(text).alias("parsed"),
    )


@query("""
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           date_trunc('month', ts)::TIMESTAMP AS month_start
    FROM events
""")
def layout_date_parts(t):
    month = F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month_start")
    return fn.with_date_parts(t.events.select("event_id", "ts"), "ts").select("event_id", "year", "month", "day", month)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * l_quantity AS squared,
           round(ln(l_extendedprice + 1), 8) AS log_value, abs(l_discount - 0.05) AS gap,
           round(l_tax * 100.0 / nullif(l_discount, 0), 4) AS tax_pct_of_discount
    FROM lineitem
""")
def math_functions(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_quantity") * F.col("l_quantity")).alias("squared"),
        F.round(F.log1p("l_extendedprice"), 8).alias("log_value"), F.abs(F.col("l_discount") - 0.05).alias("gap"),
        fn.pct(F.col("l_tax"), F.col("l_discount"), 4).alias("tax_pct_of_discount"),
    )


@query("SELECT l_returnflag, count(*) AS rows, 8::BIGINT AS salts, true AS even FROM lineitem GROUP BY 1")
def row_salts(t):
    """Rows of a flag spread over all eight salts, none with half as many again as its share."""
    keys = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    salted = t.lineitem.groupBy("l_returnflag", fn.salt(keys, 8).alias("salt")).agg(F.count(F.lit(1)).alias("n"))
    return salted.groupBy("l_returnflag").agg(
        F.sum("n").alias("rows"), F.count_if(F.col("salt").between(0, 7)).alias("salts"), (F.max("n") * 8 <= 1.5 * F.sum("n")).alias("even"))


@query("""
    SELECT p_partkey, 3 AS tag_count, p_brand AS first_tag, p_brand || ',' || p_type || ',' || p_name AS tags_string
    FROM part
""")
def array_basics(t):
    tags = fn.tag_array([F.col("p_brand"), F.col("p_type"), F.col("p_name")])
    return t.part.select(
        "p_partkey", F.size(tags).alias("tag_count"), F.get(tags, F.lit(0)).alias("first_tag"),
        F.concat_ws(",", tags).alias("tags_string"),
    )


@query("""
    SELECT vec_id, list_contains(embedding, embedding[3]) AS has_third, list_min(embedding) AS smallest,
           list_sort(embedding)[-1] AS largest, embedding[-1] AS last_value, list_reverse(embedding)[1] AS reversed_first,
           CAST(len(list_distinct(embedding || embedding)) AS INTEGER) AS distinct_values
    FROM embeddings
""")
def array_functions(t):
    e = F.col("embedding")
    ordered = F.array_sort(e)
    return t.embeddings.select(
        "vec_id", F.array_contains(e, F.get(e, F.lit(2))).alias("has_third"), F.get(ordered, F.lit(0)).alias("smallest"),
        F.element_at(ordered, -1).alias("largest"), F.element_at(e, -1).alias("last_value"),
        F.get(F.reverse(e), F.lit(0)).alias("reversed_first"), F.size(F.array_distinct(F.concat(e, e))).alias("distinct_values"),
    )


@query("""
    SELECT word, count(*) AS rows FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1
""")
def explode_words(t):
    words = _documents(t).select(F.split("text", " ").alias("words"))
    return fn.explode_rows(words, "words", "word").groupBy("word").agg(F.count(F.lit(1)).alias("rows"))


@query("""
    SELECT conv_id, turn, unnest(string_split(text, '. ')) AS sentence,
           CAST(generate_subscripts(string_split(text, '. '), 1) - 1 AS INTEGER) AS position
    FROM conversations
""")
def explode_with_position(t):
    rows = t.conversations.select("conv_id", "turn", F.split("text", r"\. ").alias("sentences"))
    return fn.explode_rows(rows, "sentences", "sentence", position="position")


@query("""
    SELECT o_orderkey, o_orderstatus AS looked_up, CAST(NULL AS VARCHAR) AS absent, 'priority,status' AS keys,
           o_orderpriority || ',' || o_orderstatus AS values, 2 AS size
    FROM orders
""")
def map_functions(t):
    m = fn.build_map({"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")})
    return t.orders.select("o_orderkey", m.alias("m")).select(
        "o_orderkey", F.try_element_at("m", F.lit("status")).alias("looked_up"),
        F.try_element_at("m", F.lit("none")).alias("absent"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"),
        F.array_join(F.array_sort(F.map_values("m")), ",").alias("values"), F.size("m").alias("size"),
    )


@query("""
    SELECT o_orderkey, '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' AS details FROM orders
""")
def map_to_json(t):
    keys, values = F.array(F.lit("status"), F.lit("priority")), F.array("o_orderstatus", "o_orderpriority")
    return t.orders.select("o_orderkey", fn.arrays_to_json(keys, values).alias("details"))


@query("""
    SELECT c_custkey, c_name AS full_name, c_mktsegment AS segment, c_name AS nested_name, c_nationkey AS nation
    FROM customer
""")
def struct_functions(t):
    inner = fn.nest(t.customer.select("c_custkey", F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("segment"),
                                      F.col("c_nationkey").alias("nation")), "customer", ["full_name", "segment"])
    outer = fn.nest(inner, "contact", ["customer", "nation"])
    named = outer.withColumn("nested_name", F.col("contact.customer.full_name"))
    return fn.flatten(fn.flatten(named, "contact"), "customer")


@query("""
    SELECT p_partkey, to_json({'id': p_partkey, 'name': p_name, 'brand': p_brand}) AS json_data, p_partkey AS id, p_name AS name
    FROM part
""")
def json_round_trip(t):
    text = fn.to_json_row([F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")])
    rows = t.part.select("p_partkey", text.alias("json_data"))
    return rows.withColumn("j", fn.parse_json(F.col("json_data"), "id BIGINT, name STRING")).select(
        "p_partkey", "json_data", "j.*"
    )


@query(r"""
    SELECT 'conv_' || conv_id AS customer_id, role AS name, conv_id || '_' || turn AS order_id, sentence AS order_date,
           word AS item_id, CAST(length(word) AS INTEGER) AS quantity, length(word) * 1.5::DOUBLE AS price
    FROM (SELECT *, unnest(string_split(sentence, ' ')) AS word
          FROM (SELECT *, unnest(string_split(text, '. ')) AS sentence FROM conversations))
""")
def nested_json_to_rows(t):
    """Each turn becomes a customer document whose sentences are orders and whose words are items."""
    def items(sentence):
        return F.transform(F.split(sentence, " "), lambda w: F.struct(
            w.alias("item_id"), F.length(w).alias("quantity"), (F.length(w) * F.lit(1.5)).alias("price")
        ))

    orders = F.transform(F.split("text", r"\. "), lambda s: F.struct(
        F.concat_ws("_", "conv_id", "turn").alias("order_id"), s.alias("date"), items(s).alias("items")
    ))
    document = F.struct(
        F.concat(F.lit("conv_"), "conv_id").alias("customer_id"), F.struct(F.col("role").alias("name")).alias("personal_info"),
        orders.alias("orders"),
    )
    parsed = fn.parse_json(F.to_json(document), fn.CUSTOMER_SCHEMA)
    return fn.flatten_nested(t.conversations.select(parsed.alias("customer_data")))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS key, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS offset,
           ts AS timestamp, CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS INTEGER) END AS id,
           CASE WHEN event_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
           CASE WHEN event_id % 50 <> 0 THEN value END AS amount,
           CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS transaction_time,
           CASE WHEN event_id % 50 <> 0 THEN event_type END AS category
    FROM events
""")
def message_envelope(t):
    """Events as messages; every fiftieth payload is not JSON and parses to NULLs."""
    payload = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("customer_id"), F.col("value").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"), F.col("event_type").alias("category"),
    ))
    messages = t.events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 50 == 0, "not json").otherwise(payload).cast("binary").alias("value"),
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    return parse_envelope(messages)


@query("""
    SELECT to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS value FROM events
""")
def rows_as_messages(t):
    return to_kafka_value(t.events.select("event_id", "user_id", "event_type"))


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def parsed_properties(t):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return t.events.select("event_id", fn.parse_json(F.col("props"), schema).alias("p")).select("event_id", "p.k")
