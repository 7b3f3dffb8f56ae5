"""Queries of the date, text and value functions, and of joins, aggregates and limits in their translated forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.functions import dates, strings, values
from concordat.operators.ranks import numbered

from .registry import query, table


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("SELECT o_orderkey, " + ", ".join(f"strftime(o_orderdate + INTERVAL ({n}) {u}, '%Y-%m-%d %H:%M:%S') AS add_{u}" for n, u in ((1, "year"), (2, "quarter"), (-3, "month"), (4, "week"), (5, "day"), (-6, "hour"), (7, "minute"), (8, "second"))) + " FROM orders")
def dateadd_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return orders(spark, sf_dir).select("o_orderkey", *(text(dates.dateadd(u, n, d)).alias(f"add_{u}") for n, u in ((1, "year"), (2, "quarter"), (-3, "month"), (4, "week"), (5, "day"), (-6, "hour"), (7, "minute"), (8, "second"))))


@query("WITH o AS (SELECT o_orderkey, o_orderdate AS a, o_orderdate + INTERVAL (o_orderkey % 1000) HOUR AS b FROM orders) SELECT o_orderkey, " + ", ".join(f"datediff('{u}', a, b)::INT AS d_{u}" for u in ("year", "quarter", "month", "day", "hour", "minute")) + ", ((datediff('day', DATE '1970-01-01', b::DATE) + 4) // 7 - (datediff('day', DATE '1970-01-01', a::DATE) + 4) // 7)::INT AS d_week FROM o")
def datediff_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir).select("o_orderkey", F.col("o_orderdate").alias("a"), F.expr("timestampadd(HOUR, cast(o_orderkey % 1000 AS int), o_orderdate)").alias("b"))
    return o.select("o_orderkey", *(dates.datediff_boundary(u, F.col("a"), F.col("b")).alias(f"d_{u}") for u in ("year", "quarter", "month", "week", "day", "hour", "minute")))


@query("WITH o AS (SELECT o_orderkey, (o_orderkey % 50000) * 3600 AS s FROM orders) SELECT o_orderkey, trunc(s / (365.25 * 86400))::INT AS e_year, trunc(s / (30.4375 * 86400))::INT AS e_month, trunc(s / 604800)::INT AS e_week, trunc(s / 86400)::INT AS e_day, s / 86400.0::DOUBLE AS days FROM o")
def datediff_elapsed_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir).select("o_orderkey", F.col("o_orderdate").alias("a"), F.expr("timestampadd(HOUR, cast(o_orderkey % 50000 AS int), o_orderdate)").alias("b"))
    return o.select("o_orderkey", *(dates.datediff_elapsed(u, F.col("a"), F.col("b")).alias(f"e_{u}") for u in ("year", "month", "week", "day")), dates.days_between(F.col("b"), F.col("a")).alias("days"))


@query("SELECT event_id, year(ts)::INT AS p_yy, quarter(ts)::INT AS p_qq, month(ts)::INT AS p_mm, dayofyear(ts)::INT AS p_dy, day(ts)::INT AS p_dd, weekofyear(ts)::INT AS p_wk, (dayofweek(ts) + 1)::INT AS p_dw, hour(ts)::INT AS p_hh, minute(ts)::INT AS p_mi, second(ts)::INT AS p_ss, (extract('microseconds' FROM ts) // 1000)::INT AS p_ms FROM events")
def datepart_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", *(dates.datepart(u, F.col("ts")).cast("int").alias(f"p_{u}") for u in ("yy", "qq", "mm", "dy", "dd", "wk", "dw", "hh", "mi", "ss", "ms")))


@query("SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S') AS m, strftime(date_trunc('year', ts) - INTERVAL 1 YEAR, '%Y-%m-%d %H:%M:%S') AS y, strftime(date_trunc('day', ts) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS d FROM events")
def datetrunc_idiom(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", text(dates.truncated("month", ts)).alias("m"), text(dates.truncated("year", ts, -1)).alias("y"), text(dates.truncated("day", ts, 2)).alias("d"))


@query("SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS e0, strftime(last_day(o_orderdate + INTERVAL 1 MONTH), '%Y-%m-%d') AS e1 FROM orders")
def eomonth(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return orders(spark, sf_dir).select("o_orderkey", dates.eomonth(d).cast("string").alias("e0"), dates.eomonth(d, 1).cast("string").alias("e1"))


@query("SELECT event_id, epoch_us(ts) // 1000000 AS seconds, strftime(make_timestamp(1000000 * (epoch_us(ts) // 1000000)), '%Y-%m-%d %H:%M:%S') AS back, strftime(TIMESTAMP '1970-01-01' + INTERVAL (event_id) SECOND, '%Y-%m-%d %H:%M:%S') AS plus FROM events")
def epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"), text(F.timestamp_seconds(seconds)).alias("back"), text(F.timestamp_seconds("event_id")).alias("plus"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d %H-%M') AS f, strftime(strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d') AS p FROM orders")
def date_format_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    dotted = F.date_format(d, dates.date_pattern("%d.%m.%Y"))
    return orders(spark, sf_dir).select("o_orderkey", F.date_format(d, dates.date_pattern("%Y/%m/%d %H-%i")).alias("f"), F.to_date(dotted, dates.date_pattern("%d.%m.%Y")).cast("string").alias("p"))


@query("SELECT p_partkey, len(rtrim(p_name || '   ', ' '))::INT AS n, octet_length(encode(p_name || 'é'))::INT AS bytes, trim('  ' || p_brand || ' ', ' ') AS b, lpad(p_brand, 12, '*') AS l, rpad(p_brand, 12, '-') AS r, substr(p_name, 2, 3) AS m FROM part")
def str_len_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, b = F.col("p_name"), F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        strings.length(F.concat(n, F.lit("   "))).alias("n"),
        strings.datalength(F.concat(n, F.lit("é"))).alias("bytes"),
        F.btrim(F.concat(F.lit("  "), b, F.lit(" "))).alias("b"),
        F.lpad(b, 12, "*").alias("l"),
        F.rpad(b, 12, "-").alias("r"),
        strings.mid(n, 2, 3).alias("m"),
    )


@query("SELECT p_partkey, strpos(p_name, 'a')::INT AS c, CASE WHEN strpos(substr(p_name, 4), 'a') > 0 THEN strpos(substr(p_name, 4), 'a') + 3 ELSE 0 END::INT AS c4, CASE WHEN regexp_matches(p_name, '[0-9]') THEN len(regexp_extract(p_name, '^(.*?)[0-9]', 1)) + 1 ELSE 0 END::INT AS digit FROM part")
def charindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", strings.charindex(F.lit("a"), n).alias("c"), strings.charindex(F.lit("a"), n, 4).alias("c4"), strings.patindex("%[0-9]%", n).alias("digit"))


@query("SELECT c_custkey, CASE WHEN len(c_name) >= 2 THEN substr(c_name, 1, 1) || '##' || substr(c_name, 5) END AS s, array_to_string(list_slice(string_split(c_name, '#'), 1, 1), '#') AS i, array_to_string(list_slice(string_split(c_name, '#'), -1, -1), '#') AS j FROM customer")
def stuff_and_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", strings.stuff(n, 2, 3, F.lit("##")).alias("s"), F.substring_index(n, "#", 1).alias("i"), F.substring_index(n, "#", -1).alias("j"))


@query("SELECT c_custkey, coalesce(list_position(['BUILDING', 'MACHINERY', 'FURNITURE'], c_mktsegment), 0)::INT AS f, c_name || '/' || c_mktsegment AS p, concat_ws('-', c_name, NULL, c_mktsegment) AS w, (c_custkey % 2 = 0) <> (c_custkey % 3 = 0) AS x FROM customer")
def find_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, m, k = F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.find_in_set(m, F.lit("BUILDING,MACHINERY,FURNITURE")).alias("f"), strings.plus(n, F.lit("/"), m).alias("p"), F.concat_ws("-", n, F.lit(None), m).alias("w"), strings.logical_xor(k % 2 == 0, k % 3 == 0).alias("x"))


@query("SELECT w, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY w")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.explode(strings.string_split(F.col("p_name"), " ")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


@query("SELECT event_id, coalesce(nullif(event_type, 'click'), 'none') AS c, nullif(user_id, 3) AS u, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS i, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END::INT AS d, try_cast(event_type AS INT) AS t, try_cast(user_id::VARCHAR AS INT) AS v, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def conditional_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISNULL, NULLIF, IIF, DECODE, TRY_CAST and a JSON field."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "nvl(nullif(event_type, 'click'), 'none') AS c", "nullif(user_id, 3) AS u", "if(value > 50, 'high', 'low') AS i", "decode(event_type, 'click', 1, 'view', 2, 0) AS d",
        "try_cast(event_type AS INT) AS t", "try_cast(cast(user_id AS STRING) AS INT) AS v", "cast(get_json_object(props, '$.k') AS BIGINT) AS k",
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS s101, strftime(o_orderdate, '%Y%m%d') AS s112, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS s120 FROM orders")
def convert_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select("o_orderkey", *(dates.convert_style(F.col("o_orderdate"), s).alias(f"s{s}") for s in (101, 112, 120)))


@query("SELECT user_id, round(coalesce(sum(value) FILTER (event_type = 'click'), 0), 2) AS click, round(coalesce(sum(value) FILTER (event_type = 'view'), 0), 2) AS view, round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 2) AS purchase FROM events GROUP BY 1")
def pivot_filter_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIVOT with given values: one shuffle, one pass."""
    kinds = ["click", "view", "purchase"]
    p = table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.sum("value"))
    return p.select("user_id", *(F.round(F.coalesce(F.col(k), F.lit(0.0)), 2).alias(k) for k in kinds))


@query("SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name DESC) AS names, string_agg(DISTINCT left(n_name, 1), ',' ORDER BY left(n_name, 1)) AS letters FROM nation GROUP BY 1")
def string_agg_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "nation").createOrReplaceTempView("nation_of_lists")
    return spark.sql("SELECT n_regionkey, listagg(n_name, '; ') WITHIN GROUP (ORDER BY n_name DESC) AS names, listagg(DISTINCT left(n_name, 1), ',') WITHIN GROUP (ORDER BY left(n_name, 1)) AS letters FROM nation_of_lists GROUP BY 1")


@query("""SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS j FROM nation GROUP BY 1""")
def json_agg_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.to_json(rows).alias("j"))


@query("SELECT c_custkey, o.o_orderkey, o.o_totalprice FROM customer LEFT JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) o ON true")
def outer_apply_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OUTER APPLY of the two largest orders: ranked within the join key, so that one shuffle serves rank and join."""
    top = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    o = orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_totalprice").withColumn("p", F.row_number().over(top)).where("p <= 2")
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_totalprice")


@query("SELECT c_custkey, a.n, a.t FROM customer, LATERAL (SELECT count(*)::BIGINT AS n, round(coalesce(sum(o_totalprice), 0), 2) AS t FROM orders WHERE o_custkey = c_custkey) a")
def cross_apply_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_of_apply")
    orders(spark, sf_dir).createOrReplaceTempView("orders_of_apply")
    return spark.sql("SELECT c_custkey, a.n, a.t FROM customer_of_apply, LATERAL (SELECT count(*) AS n, round(coalesce(sum(o_totalprice), 0), 2) AS t FROM orders_of_apply WHERE o_custkey = c_custkey) a")


@query("SELECT l_returnflag, count(DISTINCT l_partkey)::BIGINT AS parts, count(*)::BIGINT AS n FROM lineitem GROUP BY 1")
def approx_to_exact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("n"))


@query("SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median, quantile_disc(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem_of_percentiles")
    return spark.sql("SELECT l_returnflag, percentile_cont(0.5) WITHIN GROUP (ORDER BY l_quantity) AS median, percentile_disc(0.9) WITHIN GROUP (ORDER BY l_quantity) AS p90 FROM lineitem_of_percentiles GROUP BY 1")


@query("SELECT event_type, bit_and(user_id) AS a, bit_or(user_id) AS o, max(user_id) + 1 AS next_id, min(user_id) AS first_id FROM events GROUP BY 1")
def bit_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.bit_and(u).alias("a"), F.bit_or(u).alias("o"), (F.max(u) + 1).alias("next_id"), F.min(u).alias("first_id"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25")
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber").limit(25)


@query("SELECT c_custkey, c_acctbal FROM (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS p, count(*) OVER () AS n FROM customer) WHERE p <= ceil(n * 0.1)")
def top_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP 10 PERCENT by places that are counted within ranges, so that neither the count nor the sort is one task."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return numbered(c, F.col("c_acctbal").desc(), F.col("c_custkey"), total="total").where("place <= ceil(total * 0.1)").select("c_custkey", "c_acctbal")


@query("SELECT l_suppkey, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS p FROM lineitem) WHERE p <= 3")
def limit_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber")
    return table(spark, sf_dir, "lineitem").withColumn("p", F.row_number().over(w)).where("p <= 3").select("l_suppkey", "l_orderkey", "l_extendedprice")


@query("SELECT c_custkey FROM customer ORDER BY md5(c_custkey::VARCHAR), c_custkey LIMIT 10")
def sample_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey").orderBy(F.md5(F.col("c_custkey").cast("string").cast("binary")), "c_custkey").limit(10)


@query("SELECT o_custkey AS k FROM orders WHERE o_orderkey % 3 = 0 EXCEPT ALL SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0")
def except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).where("o_orderkey % 3 = 0").selectExpr("o_custkey AS k").exceptAll(table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").selectExpr("c_custkey AS k"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS k").intersect(orders(spark, sf_dir).selectExpr("o_custkey AS k"))


@query("SELECT c_mktsegment, c_nationkey, count(*)::BIGINT AS n, round(sum(c_acctbal), 2) AS t FROM customer GROUP BY c_mktsegment, c_nationkey")
def group_by_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_of_groups")
    return spark.sql("SELECT c_mktsegment, c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS t FROM customer_of_groups GROUP BY ALL")


FIELDS = [(1, "12", "", "t", "/1/2/"), (2, "", "x", "0", "/"), (3, "a", "y\tz", "", "/10/3/4/"), (4, None, None, None, None)]
FIELD_VALUES = ", ".join("(" + ", ".join("NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("\t", "' || chr(9) || '") + "'" for x in r) + ")" for r in FIELDS)


@query(f"""WITH f(id, n, s, b, h) AS (VALUES {FIELD_VALUES}) SELECT id, try_cast(nullif(trim(n), '') AS INT) AS n, s, CASE WHEN lower(trim(b)) IN ('1', 't', 'true', 'y') THEN true WHEN lower(trim(b)) IN ('0', 'f', 'false', 'n') THEN false END AS b,
 array_to_string(list_filter(string_split(h, '/'), lambda x: x <> ''), '.') AS h, coalesce(replace(s, chr(9), '\\t'), '\\N') AS c FROM f""")
def value_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = spark.createDataFrame(FIELDS, "id int, n string, s string, b string, h string")
    return f.select("id", values.from_field(F.col("n"), "int").alias("n"), values.from_field(F.col("s"), "string").alias("s"), values.from_field(F.col("b"), "boolean").alias("b"), values.tree_path(F.col("h")).alias("h"), values.copy_field(F.col("s")).alias("c"))


@query("SELECT s_suppkey, 'SRID=4326;POINT(' || (-s_suppkey / 7.0::DOUBLE) || ' ' || (s_suppkey / 3.0::DOUBLE) || ')' AS ewkt FROM supplier")
def spatial_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of suppliers as 22-byte blobs, decoded again."""
    import struct

    blob = F.pandas_udf(lambda keys: keys.map(lambda k: struct.pack("<IBBdd", 4326, 1, 12, k / 3.0, -k / 7.0)), "binary")
    return table(spark, sf_dir, "supplier").select("s_suppkey", values.spatial_text(blob("s_suppkey")).alias("ewkt"))


@query("SELECT page_id, len(regexp_extract_all(html, '<p>'))::INT AS n_p, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1 FROM pages")
def xml_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of markup that isn't well formed, by pattern."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit("<p>")).alias("n_p"), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("h1"))


@query("SELECT n_nationkey AS k, n_name AS name, x::INT AS x FROM nation, (VALUES (1), (2)) t(x)")
def xml_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an XML document: nodes exploded, values by path."""
    doc = F.concat(F.lit("<r><n id='"), F.col("n_nationkey"), F.lit("'>"), F.col("n_name"), F.lit("</n><v>1</v><v>2</v></r>"))
    d = table(spark, sf_dir, "nation").select(doc.alias("d"))
    return d.select(F.xpath_int("d", F.lit("/r/n/@id")).alias("k"), F.xpath_string("d", F.lit("/r/n")).alias("name"), F.explode(F.xpath("d", F.lit("/r/v/text()"))).alias("x")).withColumn("x", F.col("x").cast("int"))
