"""Queries of the relational verbs that the curation steps are made of: sources and sinks, filters, joins, aggregates, windows, sets, scalars."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from sievework.functions import text
from sievework.operators import targets
from sievework.operators.scan import scanned
from sievework.sources import files, sinks
from sievework.sources.tables import dealt, read, scratch, until_exit

from .registry import query

_ROW = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)"


def _lines(spark, sf_dir):
    return dealt(read(spark, sf_dir, "lineitem"), "l_orderkey").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")))


# sources and sinks

_NOTED = "p_partkey, p_name || CASE WHEN p_size > 40 THEN ', \"new\"' || chr(10) || 'line' ELSE '' END AS p_name, CASE WHEN p_size > 10 THEN p_type END AS p_type FROM part"


def _noted(spark, sf_dir):
    return read(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, CASE WHEN p_size > 40 THEN ', \"new\"\\nline' ELSE '' END) AS p_name", "CASE WHEN p_size > 10 THEN p_type END AS p_type")


@query(f"SELECT {_NOTED}")
def csv_inferred(spark, sf_dir):
    sinks.write_csv(_noted(spark, sf_dir), path := scratch(spark, "csv"))
    return files.csv(spark, until_exit(spark, path))


@query("SELECT p_partkey::VARCHAR AS id, p_name AS name, CASE WHEN p_size > 20 THEN p_size END AS year FROM part")
def csv_text_with_comments(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("concat_ws(',', p_partkey, p_name, CASE WHEN p_size > 20 THEN string(p_size) ELSE 'n.d.' END) AS value").withColumn("value", F.concat(F.col("value"), F.lit("\n# a remark, of no use")))
    head = spark.createDataFrame([("# file of names\nid,name,year",)], "value string")
    head.union(rows).coalesce(1).write.text(path := scratch(spark, "noted"))
    return files.text_csv(spark, until_exit(spark, path), year="int")


@query(f"SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_type FROM (SELECT {_NOTED})")
def csv_sniffed(spark, sf_dir):
    sinks.write_csv(_noted(spark, sf_dir), path := scratch(spark, "sniffed"), sep=";")
    return files.sniffed_csv(spark, until_exit(spark, path), ("p_name",))


@query(f"SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_type FROM (SELECT {_NOTED})")
def tsv_quoted(spark, sf_dir):
    sinks.write_tsv(_noted(spark, sf_dir), path := scratch(spark, "tsv"), quote_all=True)
    return files.tsv(spark, until_exit(spark, path))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, CASE WHEN s_acctbal > 0 THEN s_name END AS other FROM supplier")
def tsv_nulls(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name", "CASE WHEN s_acctbal > 0 THEN s_name END AS other")
    sinks.write_tsv(rows, path := scratch(spark, "nulls"))
    return files.tsv(spark, until_exit(spark, path))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def csv_appended(spark, sf_dir):
    rows, path = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), scratch(spark, "appended")
    sinks.write_csv(rows.where("s_suppkey < 50"), path)
    sinks.append_new(rows, files.text_csv(spark, path, s_suppkey="long"), ["s_suppkey"], path)
    return files.text_csv(spark, until_exit(spark, path))


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def json_species(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).alias("r"))
    rows.agg(F.collect_list("r").alias("species")).coalesce(1).write.json(path := scratch(spark, "json"))
    return files.json_list(spark, until_exit(spark, path), "id long, name string", "species")


@query(f"""WITH s AS (SELECT row_number() OVER (ORDER BY p_partkey) + 1 AS row_no, CASE WHEN p_size < 5 THEN NULL ELSE ' ' || p_name END AS a, CASE WHEN p_size >= 5 AND p_size < 10 THEN p_brand || chr(10) || 'x' END AS col_2 FROM part) SELECT * FROM s WHERE a IS NOT NULL OR col_2 IS NOT NULL""")
def sheet_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_size >= 5 THEN concat(' ', p_name) END AS a", "CASE WHEN p_size >= 5 AND p_size < 10 THEN concat('\"', p_brand, '\\nx\"') END AS b")
    whole = rows.agg(F.concat(F.lit("a, \n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", F.concat_ws(",", F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("v")))), lambda x: x["v"]), "\n")).alias("value"))
    whole.coalesce(1).write.text(path := scratch(spark, "sheet"))
    return files.sheet(spark, until_exit(spark, path))


@query("""WITH p AS (SELECT doc_id::VARCHAR AS work_id, regexp_replace(trim(regexp_replace(text, '[\\s\\x0b]+', ' ', 'g')), '&|<|>', '+', 'g') AS t FROM documents WHERE text IS NOT NULL), u AS (SELECT work_id, 0 AS place, 'Introduction' AS section, t AS text FROM p UNION ALL SELECT work_id, 1, 'Introduction / Notes', 'Notes on ' || work_id || ', which go on for more than forty characters' FROM p)
    SELECT work_id, 'text' AS kind, section, text FROM u WHERE length(text) > 40""")
def tei_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    plain = F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), "[&<>]", "+")
    xml = F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head>Introduction</head><p>'), plain, F.lit("</p></div><div><head>Notes</head><p>Notes on "), F.col("doc_id").cast("string"), F.lit(", which go on for more than forty characters</p></div></body></text></TEI>"))
    out = files.tei_chunks(docs.select(F.col("doc_id").alias("work_id"), xml.alias("xml")))
    return out.select("work_id", "kind", "section", "text")


@query("SELECT 'c-' || conv_id || '-' || turn || '.txt' AS name, strlen(text) AS size, true AS kept FROM conversations WHERE text IS NOT NULL")
def binary_files(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").where("text IS NOT NULL").select(F.concat(F.lit("c-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit(".txt")).alias("name"), F.encode("text", "UTF-8").alias("content"))
    folder = scratch(spark, "files")
    sinks.copy_files(rows, folder).write.parquet(index := scratch(spark, "index"))
    held = files.binary(spark, until_exit(spark, folder)).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.length("content").alias("held"))
    return spark.read.parquet(until_exit(spark, index)).join(held, "name").select("name", "size", (F.col("size") == F.col("held")).alias("kept"))


# projections, filters

@query("SELECT p_partkey AS id, upper(p_name) AS name, p_retailprice * 2 AS twice FROM part")
def project_rename_compute(spark, sf_dir):
    return read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id").select("id", F.upper("p_name").alias("name"), (F.col("p_retailprice") * 2).alias("twice"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE 'large' END AS class FROM part")
def branches(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "middle").otherwise("large").alias("class"))


@query("SELECT p_partkey, CASE WHEN s IS NULL THEN NULL WHEN s > 20 THEN 'yes' ELSE 'no' END AS known, coalesce(s, 0) AS filled, nullif(p_type, 'PROMO') AS type FROM (SELECT *, CASE WHEN p_size <> 7 THEN p_size END AS s FROM part)")
def null_handling(spark, sf_dir):
    s = F.when(F.col("p_size") != 7, F.col("p_size"))
    return read(spark, sf_dir, "part").select("p_partkey", text.if_known(s > 20, F.lit("yes"), F.lit("no")).alias("known"), F.coalesce(s, F.lit(0)).alias("filled"), F.nullif("p_type", F.lit("PROMO")).alias("type"))


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'A' AND l_shipdate IS NOT NULL")
def filter_ranges(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").where(F.col("l_quantity").between(10, 20) & (F.col("l_returnflag") == "A") & F.col("l_shipdate").isNotNull()).select("l_orderkey", "l_partkey", "l_quantity")


@query("SELECT p_partkey FROM part WHERE p_type IN ('SMALL', 'LARGE') AND p_size NOT IN (1, 2, 3)")
def filter_lists(spark, sf_dir):
    return read(spark, sf_dir, "part").where(F.col("p_type").isin("SMALL", "LARGE") & ~F.col("p_size").isin(1, 2, 3)).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_name, '^(red|blue) [a-m]')")
def filter_pattern(spark, sf_dir):
    return read(spark, sf_dir, "part").where(F.col("p_name").rlike("^(red|blue) [a-m]")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_name LIKE 'red%' AND p_brand NOT LIKE '%1_'")
def filter_like(spark, sf_dir):
    return read(spark, sf_dir, "part").where("p_name LIKE 'red%' AND p_brand NOT LIKE '%1_'").select("p_partkey")


@query("SELECT doc_id FROM documents WHERE contains(text, '. The')")
def filter_substring(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(F.contains("text", F.lit(". The"))).select("doc_id")


@query("SELECT upper(r_name) AS r_name, r_regionkey FROM region")
def every_text_column(spark, sf_dir):
    d = read(spark, sf_dir, "region")
    return d.select(*[F.upper(c).alias(c) if kind == "string" else c for c, kind in d.dtypes])


@query("SELECT p_partkey, a, b FROM (SELECT p_partkey, CASE WHEN p_size > 20 THEN p_name ELSE '' END AS a, CASE WHEN p_size > 40 THEN p_brand END AS b FROM part) WHERE a <> ''")
def blank_rows_dropped(spark, sf_dir):
    d = read(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_size > 20 THEN p_name ELSE '' END AS a", "CASE WHEN p_size > 40 THEN p_brand END AS b")
    return d.where(reduce(lambda x, y: x | y, [F.col(c).isNotNull() & (F.col(c) != "") for c in ("a", "b")]))


# joins

@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def join_inner(spark, sf_dir):
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return read(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name", "n_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'")
def join_left(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b FROM (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a FULL JOIN (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.k = b.k")
def join_full(spark, sf_dir):
    side = lambda flag, name: read(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("k")).agg(F.count(F.lit(1)).alias(name))
    return side("A", "n_a").join(side("R", "n_b"), "k", "full").select("k", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def join_semi(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_anti(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT s_suppkey, a FROM supplier, (VALUES ('x'), ('y'), ('z')) t(a)")
def join_grid(spark, sf_dir):
    return read(spark, sf_dir, "supplier").withColumn("a", F.explode(F.array(F.lit("x"), F.lit("y"), F.lit("z")))).select("s_suppkey", "a")


@query("SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE o_orderstatus END AS status FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def update_from(spark, sf_dir):
    few = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("B").alias("new"))
    return read(spark, sf_dir, "orders").join(few, F.col("c_custkey") == F.col("o_custkey"), "left").select("o_orderkey", F.coalesce("new", "o_orderstatus").alias("status"))


@query("SELECT l_orderkey, l_partkey, name FROM lineitem LEFT JOIN (SELECT p_size AS k, arg_min(p_name, p_partkey) AS name FROM part GROUP BY 1) ON k = l_quantity")
def lookup_first_match(spark, sf_dir):
    first = targets.first_rows(read(spark, sf_dir, "part"), ["p_size"], ["p_partkey"]).select(F.col("p_size").cast("double").alias("k"), F.col("p_name").alias("name"))
    return read(spark, sf_dir, "lineitem").join(first, F.col("k") == F.col("l_quantity"), "left").select("l_orderkey", "l_partkey", "name")


@query("SELECT c_custkey, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS most FROM customer")
def scalar_subquery(spark, sf_dir):
    most = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("most"))
    return read(spark, sf_dir, "customer").join(most, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "most")


@query("SELECT DISTINCT c.conv_id, c.turn FROM conversations c JOIN conversations q ON q.conv_id = c.conv_id AND q.turn = c.turn + 1 WHERE contains(lower(c.text), lower(split_part(q.text, ' ', 1)))")
def containment_join(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    q = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lower(F.split_part("text", F.lit(" "), F.lit(1))).alias("word"))
    return c.join(q, ["conv_id", "turn"]).where(F.contains(F.lower("text"), F.col("word"))).select("conv_id", "turn").distinct()


# aggregates

@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_discount > 0.05) AS cheap, sum(l_quantity) AS total, max(l_tax) AS high, min(l_tax) AS low FROM lineitem GROUP BY 1, 2")
def grouped_sums(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("cheap"), F.sum("l_quantity").alias("total"), F.max("l_tax").alias("high"), F.min("l_tax").alias("low"))


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 30")
def having(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).where("n > 30")


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, round(avg((l_linestatus = 'F')::INT), 6) AS share FROM lineitem GROUP BY 1")
def distinct_and_share(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.round(F.avg((F.col("l_linestatus") == "F").cast("int")), 6).alias("share"))


@query("SELECT p_brand, median(p_retailprice) AS middle FROM part GROUP BY 1")
def medians(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(F.median("p_retailprice").alias("middle"))


@query("SELECT l_orderkey, arg_min(c, n) AS first FROM (SELECT *, CASE WHEN l_quantity > 30 THEN l_partkey END AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) GROUP BY 1")
def first_known(spark, sf_dir):
    value = F.when(F.col("l_quantity") > 30, F.col("l_partkey"))
    return _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.min_by(value, F.when(value.isNotNull(), F.col("n"))).alias("first"))


@query("SELECT p_brand, arg_min(p_name, (p_retailprice, p_partkey)) AS cheapest, arg_max(p_name, (p_retailprice, p_partkey)) AS dearest FROM part GROUP BY 1")
def extremes(spark, sf_dir):
    order = F.struct("p_retailprice", "p_partkey")
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(F.min_by("p_name", order).alias("cheapest"), F.max_by("p_name", order).alias("dearest"))


@query("SELECT p_brand, string_agg(DISTINCT p_type, '; ' ORDER BY p_type) AS types, array_to_string(list_sort(list_distinct(list(p_name)))[1:3], ', ') AS three FROM part GROUP BY 1")
def text_aggregates(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "; ").alias("types"), F.array_join(F.slice(F.array_sort(F.collect_set("p_name")), 1, 3), ", ").alias("three"))


@query("SELECT o_custkey, array_to_string(list(o_orderkey::VARCHAR ORDER BY o_orderdate, o_orderkey), ',') AS orders FROM orders GROUP BY 1")
def list_aggregates(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(rows, lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"))


@query("SELECT p_name, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2")
def distinct_first_kept(spark, sf_dir):
    return targets.first_rows(read(spark, sf_dir, "part"), ["p_name", "p_type"], ["p_partkey"]).select("p_name", "p_type", "p_partkey")


# windows

@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders")
def global_numbers(spark, sf_dir):
    """Numbers without one task for all rows."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return scanned(orders, ["o_orderdate", "o_orderkey"], number="n").select("o_orderkey", "n")


@query("SELECT l_orderkey, l_partkey, n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, max(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE n >= 4 AND l_quantity = m")
def group_predicates(spark, sf_dir):
    w = Window.partitionBy("l_orderkey")
    return dealt(read(spark, sf_dir, "lineitem"), "l_orderkey").withColumns({"n": F.count(F.lit(1)).over(w), "m": F.max("l_quantity").over(w)}).where("n >= 4 AND l_quantity = m").select("l_orderkey", "l_partkey", "n")


@query(f"SELECT l_orderkey, n, first_value(c IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS filled FROM (SELECT *, CASE WHEN l_quantity > 30 THEN l_partkey END AS c, {_ROW} AS n FROM lineitem)")
def filled_from_first(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _lines(spark, sf_dir).select("l_orderkey", "n", F.first(F.when(F.col("l_quantity") > 30, F.col("l_partkey")), ignorenulls=True).over(w).alias("filled"))


@query(f"SELECT l_orderkey, n, sum((l_returnflag = 'A')::INT) OVER (PARTITION BY l_orderkey ORDER BY n) AS segment, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY n) AS step, last_value(CASE WHEN l_discount > 0.05 THEN l_partkey END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY n) AS carried FROM (SELECT *, {_ROW} AS n FROM lineitem)")
def running_windows(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("n")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return _lines(spark, sf_dir).select("l_orderkey", "n", F.sum((F.col("l_returnflag") == "A").cast("int")).over(upto).alias("segment"), (F.col("l_quantity") - F.lag("l_quantity").over(w)).alias("step"), F.last(F.when(F.col("l_discount") > 0.05, F.col("l_partkey")), ignorenulls=True).over(upto).alias("carried"))


@query(f"SELECT l_orderkey, n, l_partkey FROM (SELECT *, last_value(CASE WHEN l_returnflag = 'A' THEN 'open' WHEN l_returnflag = 'R' THEN 'shut' END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY n) AS event FROM (SELECT *, {_ROW} AS n FROM lineitem)) WHERE event = 'open'")
def segments_by_event(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    event = F.last(F.when(F.col("l_returnflag") == "A", "open").when(F.col("l_returnflag") == "R", "shut"), ignorenulls=True).over(w)
    return _lines(spark, sf_dir).withColumn("event", event).where("event = 'open'").select("l_orderkey", "n", "l_partkey")


@query("SELECT o_custkey, min(o_orderkey) AS low, count(*) AS n FROM (SELECT *, o_orderkey - row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS island FROM orders) GROUP BY o_custkey, island")
def islands(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return read(spark, sf_dir, "orders").withColumn("island", F.col("o_orderkey") - place).groupBy("o_custkey", "island").agg(F.min("o_orderkey").alias("low"), F.count(F.lit(1)).alias("n")).drop("island")


# order, limits, sets

@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def sorted_limit(spark, sf_dir):
    return read(spark, sf_dir, "orders").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k <= 3")
def topk_in_group(spark, sf_dir):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return read(spark, sf_dir, "part").withColumn("k", F.row_number().over(w)).where("k <= 3").select("p_brand", "p_partkey", "p_retailprice")


@query("SELECT c_custkey AS id, c_name AS name, NULL AS price FROM customer UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def union_by_name(spark, sf_dir):
    a, b = read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name"), read(spark, sf_dir, "part").selectExpr("p_retailprice AS price", "p_name AS name", "p_partkey AS id")
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT p_type AS v FROM part UNION SELECT p_brand FROM part")
def union_distinct(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.selectExpr("p_type AS v").union(part.selectExpr("p_brand")).distinct()


_FLAGS = "a AS (SELECT l_orderkey, list_sort(list_distinct(list(l_partkey) FILTER (l_returnflag = 'A'))) AS a, list_sort(list_distinct(list(l_partkey) FILTER (l_linestatus = 'F'))) AS f FROM lineitem GROUP BY 1)"


@query(f"WITH {_FLAGS} SELECT l_orderkey, len(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(f, []), x))) AS only_a, len(list_filter(coalesce(a, []), lambda x: list_contains(coalesce(f, []), x))) AS both, coalesce(a, []) = coalesce(f, []) AS same FROM a")
def value_sets(spark, sf_dir):
    sets = {"a": "l_returnflag = 'A'", "f": "l_linestatus = 'F'"}
    d = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.array_sort(F.collect_set(F.when(F.expr(c), F.col("l_partkey")))).alias(n) for n, c in sets.items()])
    return d.select("l_orderkey", F.size(F.array_except("a", "f")).alias("only_a"), F.size(F.array_intersect("a", "f")).alias("both"), (F.col("a") == F.col("f")).alias("same"))


# scalars

@query(r"SELECT doc_id, trim(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g')) AS squished, lower(text) AS low, length(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS key_length FROM documents WHERE text IS NOT NULL")
def text_normal_forms(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", text.squish("text").alias("squished"), F.lower("text").alias("low"), F.length(text.coverage_key("text")).alias("key_length"))


@query(r"SELECT doc_id, len(w) AS n, w[1] AS first, w[2] AS second, array_to_string(w[-3:], '+') AS last FROM (SELECT doc_id, regexp_split_to_array(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL)")
def text_words(spark, sf_dir):
    w = text.words("text")
    return read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.size(w).alias("n"), F.get(w, F.lit(0)).alias("first"), F.get(w, F.lit(1)).alias("second"), F.array_join(F.slice(w, F.greatest(F.size(w) - 2, F.lit(1)), F.lit(3)), "+").alias("last"))


@query(r"SELECT doc_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 57) || '...' ELSE text END AS short, regexp_replace(text, '(\p{Ll})- (\p{Ll})', '\1\2', 'g') AS joined, strip_accents(replace(text, 'ß', 'ss')) AS plain FROM documents WHERE text IS NOT NULL")
def text_repairs(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", text.truncated("text", 60).alias("short"), text.dehyphenated("text").alias("joined"), text.unaccented("text").alias("plain"))


@query(r"SELECT page_id, nullif(regexp_extract(url, '://([^/?#]+)', 1), '') AS host, length(html) - length(replace(html, '<p', 'p')) AS paragraphs, regexp_replace(url, '([.?])', '[\1]', 'g') AS escaped FROM pages")
def text_patterns(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.nullif(F.regexp_extract("url", "://([^/?#]+)", 1), F.lit("")).alias("host"), F.regexp_count("html", F.lit("<p")).alias("paragraphs"), F.regexp_replace("url", r"([.?])", "[$1]").alias("escaped"))


@query("SELECT p_partkey, levenshtein(p_name, p_type || ' bolt') AS distance, CASE WHEN length(p_name) > 1 THEN [substr(p_name, 1, k - 1) || substr(p_name, k + 1, 1) || substr(p_name, k, 1) || substr(p_name, k + 2) FOR k IN range(1, length(p_name))][2] END AS swapped FROM part")
def edit_distances(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.levenshtein("p_name", F.concat("p_type", F.lit(" bolt"))).alias("distance"), F.get(text.swapped_neighbours("p_name"), F.lit(1)).alias("swapped"))


@query("SELECT p_partkey, substr(sha256(p_name || chr(1) || coalesce(CASE WHEN p_size > 10 THEN p_type END, '') || chr(1) || p_size), 1, 16) AS id FROM part")
def content_ids(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.content_id("p_name", F.when(F.col("p_size") > 10, F.col("p_type")), "p_size").alias("id"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN p_size + 0.5 WHEN p_size < 20 THEN p_size END::DOUBLE AS number FROM part")
def tolerant_numbers(spark, sf_dir):
    raw = F.expr("CASE WHEN p_size < 10 THEN concat(' ', p_size, ',5') WHEN p_size < 20 THEN string(p_size) WHEN p_size < 30 THEN 'about 3' END")
    return read(spark, sf_dir, "part").select("p_partkey", text.number(raw).alias("number"))


@query("SELECT l_orderkey, l_partkey, abs(l_discount - l_tax) AS gap, floor(l_quantity * 0.3)::BIGINT AS floored, round_even(l_quantity / 4, 0) AS even, greatest(l_quantity, 25.0) AS most, round(ln(l_quantity), 9) AS log FROM lineitem")
def arithmetic(spark, sf_dir):
    q = F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"), F.floor(q * 0.3).alias("floored"), F.bround(q / 4).alias("even"), F.greatest(q, F.lit(25.0)).alias("most"), F.round(F.log(q), 9).alias("log"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) AS days, year(o_orderdate) AS year FROM orders")
def dates(spark, sf_dir):
    d = F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("day"), F.datediff(F.to_date(d), F.to_date(F.lit("1990-01-01"))).alias("days"), F.year(d).alias("year"))


@query("SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS red, len(list_distinct(string_split(p_name || ' ' || p_name, ' '))) AS kinds, string_split(p_name, ' ')[1] AS head, {'SMALL': 's', 'LARGE': 'l'}[p_type] AS short FROM (SELECT * REPLACE (p_type::VARCHAR AS p_type) FROM part)".replace("{'SMALL': 's', 'LARGE': 'l'}[p_type]", "CASE p_type WHEN 'SMALL' THEN 's' WHEN 'LARGE' THEN 'l' END"))
def arrays_and_maps(spark, sf_dir):
    w = F.split("p_name", " ")
    short = F.create_map(F.lit("SMALL"), F.lit("s"), F.lit("LARGE"), F.lit("l"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_contains(w, "red").alias("red"), F.size(F.array_distinct(F.concat(w, w))).alias("kinds"), F.get(w, F.lit(0)).alias("head"), F.try_element_at(short, F.col("p_type")).alias("short"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string(props, '$.none.deep') AS none FROM events")
def json_paths(spark, sf_dir):
    j = F.from_json("props", "k int, none struct<deep:string>")
    return read(spark, sf_dir, "events").select("event_id", j["k"].alias("k"), j["none"]["deep"].alias("none"))


# extras: not part of the curation steps

@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def extra_cube(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def extra_hourly_windows(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("user_id", F.date_format(F.window("ts", "1 hour")["start"], "yyyy-MM-dd HH").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
