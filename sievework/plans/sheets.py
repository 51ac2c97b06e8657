"""Queries of the correction rules, the audit and the Darwin Core shapes: parts, lineitems and orders as spreadsheet rows."""

from pyspark.sql import functions as F

from sievework.operators import correction, darwin_core
from sievework.sources.tables import read

from .registry import query

MINUS, DASH = "−", "–"


def _log(before, after, columns, rule="r"):
    return correction.logged(before, after, "S", rule, columns).select("column", "row_no", "value_before", "value_after")


def _changed(sql_before: str, sql_after: str, column: str, row: str, source: str) -> str:
    """The log of one column, from the values before and after."""
    return f"""SELECT '{column}' AS "column", row_no, coalesce(a, '(empty)') AS value_before, coalesce(b, '(empty)') AS value_after FROM (SELECT {row} AS row_no, {sql_before} AS a, {sql_after} AS b FROM {source}) WHERE coalesce(a, '') <> coalesce(b, '')"""


# R1

def _series(spark, sf_dir):
    return read(spark, sf_dir, "orders").selectExpr("o_orderkey AS row_no", "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority WHEN o_custkey < 300 THEN concat('MZ ', o_orderpriority, ' ', 3 + o_custkey % 5) ELSE concat('10.1/', o_custkey, '.', (o_orderkey % 3) * 2) END AS eventID")


_SERIES = """s AS (SELECT o_orderkey AS row_no, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority WHEN o_custkey < 300 THEN 'MZ ' || o_orderpriority || ' ' || (3 + o_custkey % 5) ELSE '10.1/' || o_custkey || '.' || (o_orderkey % 3) * 2 END AS v FROM orders),
    p AS (SELECT *, regexp_extract(v, '^(.*?)(\\d+)\\s*$', 1) AS prefix, TRY_CAST(regexp_extract(v, '^(.*?)(\\d+)\\s*$', 2) AS INT) AS n FROM s),
    g AS (SELECT prefix, min(n) AS low, max(n) AS high, count(DISTINCT n) AS k, arg_min(v, (n, row_no)) AS base FROM p WHERE prefix <> '' AND n IS NOT NULL GROUP BY prefix HAVING k >= 3 AND high - low + 1 = k)"""


@query(f"WITH {_SERIES} SELECT row_no, coalesce(base, v) AS eventID FROM p LEFT JOIN g ON g.prefix = p.prefix AND n IS NOT NULL")
def r1_autofill(spark, sf_dir):
    return correction.collapse_autofill(_series(spark, sf_dir))


@query(f"""WITH {_SERIES}, c AS (SELECT row_no, v, coalesce(base, v) AS b FROM p LEFT JOIN g ON g.prefix = p.prefix AND n IS NOT NULL) SELECT 'eventID' AS "column", row_no, v AS value_before, b AS value_after FROM c WHERE v <> b""")
def r1_autofill_log(spark, sf_dir):
    d = _series(spark, sf_dir)
    return _log(d, correction.collapse_autofill(d), ["eventID"])


@query(f"WITH {_SERIES} SELECT row_no, v AS value FROM p JOIN g USING (prefix) WHERE n <> low")
def audit_autofill(spark, sf_dir):
    return correction.autofill_findings(_series(spark, sf_dir), "eventID")


# R2 to R7

def _parts(spark, sf_dir, *columns):
    return read(spark, sf_dir, "part").selectExpr("p_partkey AS row_no", *columns)


@query(f"SELECT p_partkey AS row_no, CASE WHEN p_size < 25 THEN '10.9/' || p_size ELSE p_brand || ' ' || p_size || '{DASH}' || p_size END AS eventID FROM part")
def r2_identifiers(spark, sf_dir):
    mapping = read(spark, sf_dir, "part").where("p_size < 25").selectExpr(f"concat(p_brand, '  ', p_size, '-', p_size) AS old", "concat('10.9/', p_size) AS new", "p_partkey AS ord")
    return correction.stable_ids(_parts(spark, sf_dir, f"concat(p_brand, ' ', p_size, '{DASH}', p_size) AS eventID"), mapping)


@query(f"SELECT p_partkey AS row_no, '1-2 {DASH}' || p_name || ' -' || p_size || '-' || p_size AS t FROM part")
def r3_dashes(spark, sf_dir):
    return correction.plain_dashes(_parts(spark, sf_dir, f"concat('1{DASH}2 {DASH}', p_name, ' {MINUS}', p_size, '{DASH}', p_size) AS t"))


@query("SELECT p_partkey AS row_no, p_name || ' x ' || p_brand AS t FROM part")
def r4_spaces(spark, sf_dir):
    return correction.single_spaces(_parts(spark, sf_dir, "concat('  ', p_name, '\\n\\t x \\u00a0', p_brand, ' ') AS t"))


@query("""SELECT p_partkey AS row_no, p_name AS scientificName, CASE WHEN p_size > 20 THEN '(' || p_type || ')' || CASE WHEN p_size > 40 THEN ' Lutz, 1925' ELSE '' END END AS scientificNameAuthorship FROM part""")
def r5_authorship(spark, sf_dir):
    return correction.authorship_split(_parts(spark, sf_dir, "concat(p_name, ' ', CASE WHEN p_size > 20 THEN concat('(', p_type, ') (', p_type, ')') ELSE '' END, CASE WHEN p_size > 40 THEN ' Lutz, 1925' ELSE '' END) AS scientificName"))


@query("SELECT p_partkey AS row_no, CASE WHEN p_size < 25 THEN replace(p_name, ' ', '') || p_size ELSE p_name || p_size END AS taxonID FROM part")
def r6_id_spaces(spark, sf_dir):
    valid = read(spark, sf_dir, "part").where("p_size < 25").selectExpr("concat(replace(p_name, ' ', ''), p_size) AS taxonID")
    return correction.ids_without_spaces(_parts(spark, sf_dir, "concat(p_name, p_size) AS taxonID"), valid)


@query("SELECT p_partkey AS row_no, CASE WHEN p_size >= 30 THEN p_name END AS measurementUnit FROM part")
def r7_remarks(spark, sf_dir):
    words = "CASE WHEN p_size < 10 THEN concat('Acho que ', p_name) WHEN p_size < 20 THEN concat('NÃO se aplica ', p_name) WHEN p_size < 30 THEN concat(p_name, ' ver com X') ELSE p_name END AS measurementUnit"
    return correction.remarks_emptied(_parts(spark, sf_dir, words.replace("NÃO", "não")))


# R8 to R10

def _valid(spark, sf_dir):
    return read(spark, sf_dir, "supplier").selectExpr("concat('id', lpad(string(s_suppkey * 7919), 7, '0')) AS taxonID", "concat('Genus', s_suppkey, ' species (x)') AS scientificName")


def _ids(spark, sf_dir):
    """Ids of suppliers with a slip: swapped digits, a wrong digit, letters added, or only the name right."""
    good = "concat('id', lpad(string(l_suppkey * 7919), 7, '0'))"
    slip = f"CASE l_linenumber WHEN 1 THEN {good} WHEN 2 THEN concat(substring({good}, 1, 4), substring({good}, 6, 1), substring({good}, 5, 1), substring({good}, 7)) WHEN 3 THEN concat('iq', substring({good}, 3)) WHEN 4 THEN concat({good}, 'ab') WHEN 5 THEN 'unknown' WHEN 6 THEN 'far away' END"
    return read(spark, sf_dir, "lineitem").selectExpr(f"{slip} AS taxonID", "CASE WHEN l_linenumber = 5 THEN concat('Genus', l_suppkey, ' species') WHEN l_quantity > 25 THEN 'Other name' END AS scientificName").distinct()


_VALID = "v AS (SELECT 'id' || lpad((s_suppkey * 7919)::VARCHAR, 7, '0') AS good, 'Genus' || s_suppkey || ' species' AS name FROM supplier)"
_SLIP = """i AS (SELECT DISTINCT CASE l_linenumber WHEN 1 THEN g WHEN 2 THEN substr(g, 1, 4) || substr(g, 6, 1) || substr(g, 5, 1) || substr(g, 7) WHEN 3 THEN 'iq' || substr(g, 3) WHEN 4 THEN g || 'ab' WHEN 5 THEN 'unknown' WHEN 6 THEN 'far away' END AS bad,
    CASE WHEN l_linenumber = 5 THEN 'Genus' || l_suppkey || ' species' WHEN l_quantity > 25 THEN 'Other name' END AS name FROM (SELECT *, 'id' || lpad((l_suppkey * 7919)::VARCHAR, 7, '0') AS g FROM lineitem))"""
_FIXED = f"""{_VALID}, {_SLIP}, b AS (SELECT * FROM i WHERE bad IS NOT NULL AND bad NOT IN (SELECT good FROM v)), u AS (SELECT DISTINCT bad FROM b),
    n AS (SELECT name, min(good) AS good FROM v GROUP BY name HAVING count(DISTINCT good) = 1),
    t AS (SELECT bad, min(good) AS good FROM u JOIN v ON good IN (SELECT unnest([substr(bad, 1, k - 1) || substr(bad, k + 1, 1) || substr(bad, k, 1) || substr(bad, k + 2) FOR k IN range(1, length(bad))])) GROUP BY bad HAVING count(DISTINCT good) = 1),
    e AS (SELECT bad, min(good) AS good FROM u JOIN v ON levenshtein(bad, good) <= 2 GROUP BY bad HAVING count(DISTINCT good) = 1)"""


@query(f"WITH {_FIXED} SELECT b.bad AS taxonID, b.name AS scientificName, coalesce(n.good, t.good, e.good) AS repaired FROM b LEFT JOIN n ON n.name = b.name LEFT JOIN t ON t.bad = b.bad LEFT JOIN e ON e.bad = b.bad")
def r8_repaired_ids(spark, sf_dir):
    return correction.repaired_ids(_ids(spark, sf_dir), _valid(spark, sf_dir))


@query(f"WITH {_FIXED}, r AS (SELECT b.bad, b.name, coalesce(n.good, t.good, e.good) AS fixed FROM b LEFT JOIN n ON n.name = b.name LEFT JOIN t ON t.bad = b.bad LEFT JOIN e ON e.bad = b.bad) SELECT coalesce(fixed, i.bad) AS taxonID, i.name AS scientificName FROM i LEFT JOIN r ON r.bad = i.bad AND r.name IS NOT DISTINCT FROM i.name")
def r8_malformed_ids(spark, sf_dir):
    return correction.ids_repaired(_ids(spark, sf_dir), _valid(spark, sf_dir))



@query("""SELECT p_partkey AS row_no, p_brand AS taxonID, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'New ' || p_brand ELSE p_name END AS scientificName, CASE WHEN p_brand = 'Brand#1' THEN 'Lutz' ELSE p_type END AS scientificNameAuthorship FROM part""")
def r9_names(spark, sf_dir):
    decisions = spark.createDataFrame([(" Brand#1", "New Brand#1", "Lutz"), ("Brand#2", "New Brand#2", None)], "taxonID string, accepted_name string, accepted_authorship string")
    return correction.accepted_names(_parts(spark, sf_dir, "p_brand AS taxonID", "p_name AS scientificName", "p_type AS scientificNameAuthorship"), decisions)


@query("SELECT p_partkey AS row_no, CASE WHEN p_size < 20 AND p_type = 'SMALL' THEN 'moved' ELSE p_brand END AS taxonID FROM part")
def r10_moves(spark, sf_dir):
    d = _parts(spark, sf_dir, "p_brand AS taxonID", "concat(p_name, ' (x)') AS scientificName", "concat(p_type, ' ', p_size) AS eventID")
    moves = read(spark, sf_dir, "part").where("p_size < 20 AND p_type = 'SMALL'").selectExpr("'S' AS sheet", "concat(p_brand, ' ') AS taxonID_now", "p_name AS scientificName", "concat(p_type, '  ', p_size) AS eventID", "'moved' AS taxonID_new")
    return correction.repointed(d, moves.union(moves.withColumns({"sheet": F.lit("T"), "taxonID_new": F.lit("no")})), "S").select("row_no", "taxonID")


# R11 to R17

@query("""WITH d AS (SELECT p_partkey AS row_no, CASE WHEN p_size > 40 THEN p_brand WHEN p_size > 30 THEN '  ' END AS e, CASE WHEN p_type <> 'PROMO' THEN p_type END AS c FROM part),
    f AS (SELECT *, last_value(CASE WHEN trim(e) <> '' THEN e END IGNORE NULLS) OVER (ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM d)
    SELECT row_no, CASE WHEN coalesce(trim(e), '') = '' AND c IS NOT NULL THEN coalesce(above, e) ELSE e END AS eventID FROM f""")
def r11_continuation(spark, sf_dir):
    d = _parts(spark, sf_dir, "CASE WHEN p_size > 40 THEN p_brand WHEN p_size > 30 THEN '  ' END AS eventID", "CASE WHEN p_type <> 'PROMO' THEN p_type END AS collectionCode")
    return correction.continued(d, "GeneralInformation").select("row_no", "eventID")


@query("SELECT p_partkey AS row_no, CASE WHEN p_size < 30 THEN 'percentage_of_items' ELSE p_name END AS measurementValue FROM part")
def r12_diet_metric(spark, sf_dir):
    return correction.diet_metric(_parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN ' number_itens' WHEN p_size < 20 THEN 'number_of_itens' WHEN p_size < 30 THEN 'percentage_of_itens ' ELSE p_name END AS measurementValue"), "Diet_DWC")


@query("""SELECT p_partkey AS row_no, CASE WHEN p_size >= 30 THEN p_name END AS MeasurementOrFact, CASE WHEN p_type <> 'PROMO' THEN p_brand || CASE WHEN p_size < 10 THEN ':permanent' WHEN p_size < 30 THEN ':temporary' ELSE '' END END AS eventID FROM part""")
def r13_water_period(spark, sf_dir):
    d = _parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN 'Perm' WHEN p_size < 20 THEN ' Temp' WHEN p_size < 30 THEN 'temporary  pond' ELSE p_name END AS MeasurementOrFact", "CASE WHEN p_type <> 'PROMO' THEN p_brand END AS eventID")
    return correction.water_period(d, "Diet_DWC")


@query("""SELECT 'dietItens' AS "column", p_partkey AS row_no, p_name AS value_before, '(empty)' AS value_after FROM part WHERE p_size > 5""")
def r14_diet_items_log(spark, sf_dir):
    d = _parts(spark, sf_dir, "CASE WHEN p_size > 5 THEN p_name END AS dietItens")
    return _log(d, correction.diet_items_emptied(d, "Diet_DWC"), ["dietItens"])


_WORDS = [("SMALL", "red bolt", "crimson bolt"), ("LARGE", "blue ring", "azure ring"), ("SMALL", "blue ring", "small blue ring")]


def _spelling(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "trait string, wrong string, right string, ord int")


@query("""SELECT p_partkey AS row_no, p_type AS measurementType, CASE WHEN p_type = 'SMALL' AND p_name = 'red bolt' THEN 'crimson bolt' WHEN p_type = 'LARGE' AND p_name = 'blue ring' THEN 'azure ring' WHEN p_type = 'SMALL' AND p_name = 'blue ring' THEN 'small blue ring' ELSE p_name END AS measurementValue FROM part""")
def r15_spelling(spark, sf_dir):
    return correction.spelled(_parts(spark, sf_dir, "p_type AS measurementType", "p_name AS measurementValue"), _spelling(spark, _WORDS), "Morphology_DWC")


@query("""SELECT p_partkey AS row_no, CASE p_type WHEN 'SMALL' THEN 'tiny' ELSE p_type END AS Habitat_type, CASE WHEN p_name = 'red bolt' THEN 'moved' ELSE p_name END AS behavior FROM part""")
def r15_spelling_habitat(spark, sf_dir):
    words = _spelling(spark, [("Habitat_type", "SMALL", "tiny"), ("behavior", "red bolt", "moved"), ("no_such_column", "x", "y")])
    return correction.spelled(_parts(spark, sf_dir, "p_type AS Habitat_type", "p_name AS behavior"), words, "Habitat")


@query("""SELECT p_partkey AS row_no, CASE WHEN p_type = 'SMALL' THEN 'tooth_row_formulae' ELSE p_type END AS measurementType, CASE WHEN p_type = 'SMALL' AND p_size IN (7, 9) THEN '2(2)/3' ELSE p_size::VARCHAR END AS measurementValue FROM part""")
def r16_formulae(spark, sf_dir):
    d = _parts(spark, sf_dir, "CASE WHEN p_type = 'SMALL' THEN 'tooth_row_formulae' ELSE p_type END AS measurementType", "string(p_size) AS measurementValue")
    return correction.formulae(d, spark.createDataFrame([(" 7", "2(2)/3"), ("9 ", "2(2)/3")], "sheet_value string, formula string"))


@query("SELECT p_partkey AS row_no, CASE p_partkey WHEN 0 THEN 'fixed' WHEN 3 THEN NULL ELSE p_name END AS t FROM part")
def r17_single_cells(spark, sf_dir):
    d = _parts(spark, sf_dir, "p_name AS t")
    now = {r.row_no: r.t for r in d.where("row_no IN (0, 3)").collect()}
    return correction.single_cells(d, [(0, "t", f" {now[0]} ", "wrong"), (3, "t", now[3], None), (0, "t", "wrong", "fixed")])


_RULES = [("t", None, "a", "b"), ("t", "Brand#1", "b", "c"), ("t", "  ", "d", None), ("u", None, "a", "x")]
_VOCABULARY = "CASE WHEN p_size < 10 THEN 'a' WHEN p_size < 20 THEN 'b' WHEN p_size < 30 THEN 'd' ELSE 'e' END"


@query(f"""WITH d AS (SELECT p_partkey AS row_no, p_brand AS taxonID, CASE WHEN p_type = 'PROMO' THEN 'u' ELSE 't' END AS measurementType, {_VOCABULARY} AS v FROM part),
    n AS (SELECT *, CASE WHEN measurementType = 'u' THEN CASE v WHEN 'a' THEN 'x' ELSE v END WHEN v IN ('a', 'b') THEN CASE WHEN taxonID = 'Brand#1' THEN 'c' ELSE 'b' END WHEN v = 'd' THEN NULL ELSE v END AS w FROM d)
    SELECT row_no, w AS measurementValue, CASE WHEN w IS DISTINCT FROM v THEN v END AS measurementValue_original FROM n""")
def r18_vocabulary(spark, sf_dir):
    d = _parts(spark, sf_dir, "p_brand AS taxonID", "CASE WHEN p_type = 'PROMO' THEN 'u' ELSE 't' END AS measurementType", f"{_VOCABULARY} AS measurementValue")
    return correction.vocabulary(d, _RULES, "Morphology_DWC").select("row_no", "measurementValue", "measurementValue_original")


@query(f"""SELECT p_partkey AS row_no, CASE WHEN p_size < 20 THEN CASE WHEN p_brand = 'Brand#1' THEN 'c' ELSE 'b' END WHEN p_size < 30 THEN NULL ELSE 'e' END AS t,
    CASE WHEN p_size < 10 OR (p_size < 20 AND p_brand = 'Brand#1') OR p_size BETWEEN 20 AND 29 THEN {_VOCABULARY} END AS t_original FROM part""")
def r18_vocabulary_habitat(spark, sf_dir):
    return correction.vocabulary(_parts(spark, sf_dir, "p_brand AS taxonID", f"{_VOCABULARY} AS t"), _RULES, "Habitat").select("row_no", "t", "t_original")


_LINE = f"concat(p_name, '  ', p_size, '{DASH}', p_size, ' ')"


@query(f"""SELECT 'R3' AS rule, p_partkey AS row_no, p_name || '  ' || p_size || '{DASH}' || p_size || ' ' AS value_before, p_name || '  ' || p_size || '-' || p_size || ' ' AS value_after FROM part
    UNION ALL SELECT 'R4', p_partkey, p_name || '  ' || p_size || '-' || p_size || ' ', p_name || ' ' || p_size || '-' || p_size FROM part""")
def correction_pipeline_log(spark, sf_dir):
    rules = [("R3", correction.plain_dashes), ("R4", correction.single_spaces), ("R7", correction.remarks_emptied)]
    _, log = correction.corrected(_parts(spark, sf_dir, f"{_LINE} AS t"), "S", rules)
    return log.select("rule", "row_no", "value_before", "value_after")


@query("SELECT p_partkey AS row_no, p_name || ' ' || p_size || '-' || p_size AS t FROM part")
def correction_pipeline(spark, sf_dir):
    rules = [("R3", correction.plain_dashes), ("R4", correction.single_spaces), ("R7", correction.remarks_emptied)]
    return correction.corrected(_parts(spark, sf_dir, f"{_LINE} AS t"), "S", rules)[0]


# audit

def _dirty(spark, sf_dir):
    return _parts(spark, sf_dir, f"CASE WHEN p_size < 10 THEN concat(p_name, '  x') WHEN p_size < 20 THEN concat(' ', p_name) WHEN p_size < 30 THEN concat(p_name, '{DASH}') WHEN p_size < 35 THEN concat(p_name, '{MINUS} ') ELSE p_name END AS t", "CASE WHEN p_size = 1 THEN concat('a\\n', p_name) WHEN p_size = 2 THEN 'b\\tc' END AS u")


_DIRTY = f"""d AS (SELECT p_partkey AS row_no, CASE WHEN p_size < 10 THEN p_name || '  x' WHEN p_size < 20 THEN ' ' || p_name WHEN p_size < 30 THEN p_name || '{DASH}' WHEN p_size < 35 THEN p_name || '{MINUS} ' ELSE p_name END AS t FROM part),
    f AS (SELECT row_no, t AS value, 'double space' AS problem FROM d WHERE contains(t, '  ') UNION ALL SELECT row_no, t, 'space at an end' FROM d WHERE t <> trim(t) UNION ALL SELECT row_no, t, 'typographic dash' FROM d WHERE regexp_matches(t, '{MINUS}|{DASH}'))"""


@query(f"WITH {_DIRTY} SELECT * FROM f")
def audit_text(spark, sf_dir):
    return darwin_core.text_findings(_dirty(spark, sf_dir), "S", ["t", "no_such_column"]).select("row_no", "value", "problem")


@query(f"WITH {_DIRTY} SELECT problem, value, count(*) AS n_cells, min(row_no) AS example_row FROM f GROUP BY 1, 2")
def audit_summary(spark, sf_dir):
    return darwin_core.summed_findings(darwin_core.text_findings(_dirty(spark, sf_dir), "S", ["t"])).select("problem", "value", "n_cells", "example_row")


@query("SELECT p_partkey AS row_no, CASE p_size WHEN 1 THEN 'a<break>' || p_name ELSE 'b<break>c' END AS value FROM part WHERE p_size IN (1, 2)")
def audit_control(spark, sf_dir):
    return darwin_core.control_findings(_dirty(spark, sf_dir), "S").select("row_no", "value")


@query("""WITH p AS (SELECT p_type AS sheet, p_partkey AS row_no, p_brand AS id, p_name AS name FROM part), u AS (SELECT *, row_number() OVER (PARTITION BY id, name ORDER BY sheet, row_no) AS k FROM p),
    f AS (SELECT *, count(*) OVER (PARTITION BY id) AS names, count(*) OVER (PARTITION BY name) AS ids FROM u WHERE k = 1)
    SELECT row_no, 'scientificName' AS "column", id || ' -> ' || name AS value FROM f WHERE names > 1 UNION ALL SELECT row_no, 'taxonID', name || ' -> ' || id FROM f WHERE ids > 1""")
def audit_id_names(spark, sf_dir):
    pairs = read(spark, sf_dir, "part").selectExpr("p_type AS sheet", "p_partkey AS row_no", "p_brand AS taxonID", "concat(' ', p_name) AS name")
    return darwin_core.id_name_findings(pairs).select("row_no", "column", "value")


@query("SELECT p_type AS sheet, min(p_partkey) AS row_no, p_brand AS value FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 1) GROUP BY 1, 3")
def audit_orphans(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_type AS sheet", "p_partkey AS row_no", "p_brand AS taxonID")
    return darwin_core.orphan_findings(rows, read(spark, sf_dir, "part").where("p_size = 1").select(F.col("p_brand").alias("taxonID"))).select("sheet", "row_no", "value")


@query("SELECT p_partkey AS row_no, p_name || ': acho que sim' AS value FROM part WHERE p_size < 10")
def audit_remarks(spark, sf_dir):
    return darwin_core.remark_findings(_parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN concat(p_name, ': acho que sim') WHEN p_size < 20 THEN 'ver com X' END AS measurementUnit"), "S").select("row_no", "value")


@query("SELECT p_partkey AS row_no, p_name AS value FROM part WHERE p_size >= 30")
def audit_fragile_ids(spark, sf_dir):
    return darwin_core.fragile_id_findings(_parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN concat('10.', p_size) WHEN p_size < 15 THEN 'https://x' WHEN p_size < 20 THEN '9781' WHEN p_size >= 30 THEN p_name END AS eventID"), "S").select("row_no", "value")


@query("SELECT p_partkey AS row_no, p_name AS value FROM part WHERE p_size < 20 AND p_type <> 'PROMO'")
def audit_values_without_id(spark, sf_dir):
    return darwin_core.value_without_id_findings(_parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN ' ' WHEN p_size >= 20 THEN p_brand END AS taxonID", "CASE WHEN p_type = 'PROMO' THEN '  ' ELSE p_name END AS measurementValue"), "S").select("row_no", "value")


@query("SELECT p_partkey AS row_no, p_size || ' m' AS value FROM part WHERE p_size BETWEEN 20 AND 29")
def audit_text_in_numbers(spark, sf_dir):
    return darwin_core.text_in_number_findings(_parts(spark, sf_dir, "CASE WHEN p_size < 10 THEN concat(p_size, ',5') WHEN p_size < 20 THEN string(p_size) WHEN p_size < 30 THEN concat(p_size, '  m') WHEN p_size < 40 THEN ' ' END AS depth"), "S", "depth").select("row_no", "value")


# Darwin Core

@query("""SELECT p_brand AS taxonID, arg_min(p_name, p_partkey) AS scientificName, (arg_min({'v': CASE WHEN p_size > 9 THEN 'Author, ' || p_size END}, p_partkey)).v AS scientificNameAuthorship, arg_min(p_type, p_partkey) AS family, split_part(arg_min(p_name, p_partkey), ' ', 1) AS genus,
    'Animalia' AS kingdom, 'Chordata' AS phylum, 'Amphibia' AS class, 'Anura' AS "order", 'species' AS taxonRank, 'list ' || arg_min(p_size, p_partkey) AS nameAccordingTo, 'ICZN' AS nomenclaturalCode, (arg_min({'v': CASE WHEN p_size % 2 = 0 THEN 'in ' || p_type END}, p_partkey)).v AS taxonRemarks FROM part GROUP BY p_brand""")
def dwc_taxa(spark, sf_dir):
    return darwin_core.taxa(_parts(spark, sf_dir, "p_brand AS taxonID", "p_name AS scientificName", "CASE WHEN p_size > 9 THEN concat('Author, ', p_size) END AS scientificNameAuthorship", "p_type AS family", "split_part(p_name, ' ', 1) AS genus",
        "concat('list ', p_size) AS nameAccordingToID", "CASE WHEN p_size % 2 = 0 THEN concat('in ', p_type) END AS `FIRST TADPOLE-DESCRIPTION`"))


@query("""SELECT CASE WHEN p_size > 2 THEN p_brand ELSE 'NA' END || '|' || row_number() OVER (ORDER BY p_partkey) AS occurrenceID, CASE WHEN p_size > 2 THEN p_brand END AS taxonID, p_name AS catalogNumber, 'tadpole' AS lifeStage, 'Brazil' AS country, p_type AS stateProvince,
    CASE WHEN p_size > 9 THEN 'town ' || p_size END AS municipality, NULL::VARCHAR AS locality, 'biome ' || p_type AS higherGeography, 'cited ' || p_size AS bibliographicCitation, p_type AS eventID, NULL::VARCHAR AS occurrenceRemarks FROM part""")
def dwc_occurrences(spark, sf_dir):
    return darwin_core.occurrences(_parts(spark, sf_dir, "CASE WHEN p_size > 2 THEN p_brand END AS taxonID", "p_name AS collectionCode", "'Brazil' AS country", "p_type AS stateProvince", "CASE WHEN p_size > 9 THEN concat('town ', p_size) END AS municipality",
        "CAST(NULL AS STRING) AS locality", "concat('biome ', p_type) AS `higherGeography (biome)`", "concat('cited ', p_size) AS bibliographicCitation", "p_type AS eventID"))


def _habitat(spark, sf_dir):
    return _parts(spark, sf_dir, "p_brand AS taxonID", "CASE WHEN p_size < 40 THEN p_type END AS Habitat_type", "CASE WHEN p_size > 20 THEN string(p_size) END AS maximumDephInMeters", "CASE WHEN p_size < 5 THEN 'old \"x\"' END AS Habitat_type_original", "CASE WHEN p_size < 30 THEN p_name END AS biome", "CAST(NULL AS STRING) AS LocationID", "p_type AS eventID")


_HABITAT = """h AS (SELECT p_partkey AS row_no, 'maximumDephInMeters' AS t, p_size::VARCHAR AS v, 'm' AS u, 'origin=Habitat; biome=' || CASE WHEN p_size < 30 THEN p_name ELSE 'NA' END || '; locationID=NA' AS r FROM part WHERE p_size > 20
    UNION ALL SELECT p_partkey, 'Habitat_type', p_type, NULL, 'origin=Habitat; biome=' || CASE WHEN p_size < 30 THEN p_name ELSE 'NA' END || '; locationID=NA' || CASE WHEN p_size < 5 THEN '; verbatim="old ''x''"' ELSE '' END FROM part WHERE p_size < 40)"""


@query(f"WITH {_HABITAT} SELECT row_no, t AS measurementType, v AS measurementValue, u AS measurementUnit, r AS measurementRemarks FROM h")
def dwc_habitat(spark, sf_dir):
    return darwin_core.habitat_measurements(_habitat(spark, sf_dir)).select("row_no", "measurementType", "measurementValue", "measurementUnit", "measurementRemarks")


def _morphology(spark, sf_dir):
    return _parts(spark, sf_dir, "p_brand AS taxonID", "p_type AS measurementType", "CASE WHEN p_size > 10 THEN p_name END AS measurementValue", "CASE WHEN p_size > 40 THEN 'old' END AS measurementValue_original", "p_name AS definition", "CASE WHEN p_size > 30 THEN '25' END AS stage", "p_type AS eventID")


_MORPHOLOGY = "m AS (SELECT p_partkey AS row_no, p_type AS t, p_name AS v, 'origin=Morphology; definition=' || p_name || '; stage=' || CASE WHEN p_size > 30 THEN '25' ELSE 'NA' END || CASE WHEN p_size > 40 THEN '; verbatim=\"old\"' ELSE '' END AS r FROM part WHERE p_size > 10)"


@query(f"WITH {_MORPHOLOGY} SELECT row_no, t AS measurementType, v AS measurementValue, r AS measurementRemarks FROM m")
def dwc_morphology(spark, sf_dir):
    return darwin_core.morphology_measurements(_morphology(spark, sf_dir)).select("row_no", "measurementType", "measurementValue", "measurementRemarks")


def _diet(spark, sf_dir):
    return _parts(spark, sf_dir, "p_brand AS taxonID", "CASE WHEN p_size > 5 THEN p_name END AS measurementType", "CASE WHEN p_size < 45 THEN string(p_size) END AS measurementAccuracy", "'%' AS organismQuantity", "CASE WHEN p_size > 20 THEN '12' END AS organismQuantityType", "p_type AS eventID")


@query("SELECT p_partkey AS row_no, 'diet_item:' || CASE WHEN p_size > 5 THEN p_name ELSE 'NA' END AS measurementType, p_size::VARCHAR AS measurementValue, '%' AS measurementUnit, 'origin=Diet; examined=' || CASE WHEN p_size > 20 THEN '12' ELSE 'NA' END || '; stage=NA' AS measurementRemarks FROM part WHERE p_size < 45")
def dwc_diet(spark, sf_dir):
    return darwin_core.diet_measurements(_diet(spark, sf_dir)).select("row_no", "measurementType", "measurementValue", "measurementUnit", "measurementRemarks")


@query(f"""WITH {_HABITAT}, {_MORPHOLOGY}, a AS (SELECT 0 AS part, row_no, t, v, r FROM h UNION ALL SELECT 1, row_no, t, v, r FROM m UNION ALL SELECT 2, p_partkey, 'diet_item:' || CASE WHEN p_size > 5 THEN p_name ELSE 'NA' END, p_size::VARCHAR, 'origin=Diet; examined=' || CASE WHEN p_size > 20 THEN '12' ELSE 'NA' END FROM part WHERE p_size < 45)
    SELECT 'mof' || row_number() OVER (ORDER BY part, row_no, t) AS measurementID, t AS measurementType, v AS measurementValue FROM a""")
def dwc_measurements(spark, sf_dir):
    parts = darwin_core.habitat_measurements(_habitat(spark, sf_dir)), darwin_core.morphology_measurements(_morphology(spark, sf_dir)), darwin_core.diet_measurements(_diet(spark, sf_dir))
    return darwin_core.measurements(*parts).select("measurementID", "measurementType", "measurementValue")


@query("SELECT p_partkey AS k, 'r' || CASE WHEN p_size < 20 AND p_type = 'SMALL' THEN '; note=n' || p_brand ELSE '' END AS measurementRemarks FROM part")
def dwc_notes(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey AS k", "p_brand AS taxonID", "concat(p_type, p_size) AS eventID", "'r' AS measurementRemarks")
    notes = read(spark, sf_dir, "part").where("p_size < 20 AND p_type = 'SMALL'").selectExpr("p_brand AS taxonID", "concat(p_type, p_size) AS eventID", "concat('n', p_brand) AS note")
    return darwin_core.with_notes(rows, notes).select("k", "measurementRemarks")


@query("SELECT p_partkey AS k, p_name AS definition, CASE WHEN p_size > 20 THEN p_type END AS origin FROM part")
def remark_values(spark, sf_dir):
    r = read(spark, sf_dir, "part").selectExpr("p_partkey AS k", "concat('definition=', p_name, '; x=', p_brand, CASE WHEN p_size > 20 THEN concat('; origin=', p_type, '; y=1') ELSE '' END) AS r")
    return r.select("k", darwin_core.remark_value("r", "definition").alias("definition"), darwin_core.remark_value("r", "origin").alias("origin"))


_MOF = """SELECT 0 AS part, p_partkey AS row_no, 0 AS place, p_brand AS taxonID, 'Habitat_type' AS measurementType, p_type AS measurementValue, NULL AS measurementUnit, NULL AS organismQuantity, NULL AS organismQuantityType, NULL AS measurementMethod,
      'origin=Habitat; biome=' || CASE WHEN p_size < 30 THEN p_name ELSE 'NA' END || '; locationID=L' || p_size || CASE WHEN p_size < 5 THEN '; verbatim="old ''x''"' ELSE '' END AS measurementRemarks, 'source ' || p_size AS bibliographicCitation, p_type AS eventID FROM part WHERE p_size < 40
    UNION ALL SELECT 0, p_partkey, 1, p_brand, 'maximumDephInMeters', p_size::VARCHAR, 'm', NULL, NULL, NULL, 'origin=Habitat; biome=' || CASE WHEN p_size < 30 THEN p_name ELSE 'NA' END || '; locationID=L' || p_size, 'source ' || p_size, p_type FROM part WHERE p_size > 20
    UNION ALL SELECT 1, p_partkey, 0, p_brand, 'code ' || p_type, p_name, NULL, CASE WHEN p_size > 30 THEN '7' END, 'individuals', 'measured', 'origin=Morphology; definition=' || p_name || '; stage=' || CASE WHEN p_size > 30 THEN '25' ELSE 'NA' END || CASE WHEN p_size > 40 THEN '; verbatim="old"' ELSE '' END, 'source ' || p_size, p_type FROM part WHERE p_size > 10
    UNION ALL SELECT 2, p_partkey, 0, p_brand, 'diet_item:' || CASE WHEN p_size > 5 THEN p_name ELSE 'NA' END, p_size::VARCHAR, '%', CASE WHEN p_size > 20 THEN '12' END, CASE WHEN p_size > 20 THEN 'individuals' END, 'percentage_of_items', 'origin=Diet; examined=' || CASE WHEN p_size > 20 THEN '12' ELSE 'NA' END || '; stage=' || CASE WHEN p_size > 15 THEN '30' ELSE 'NA' END, NULL, p_type FROM part WHERE p_size < 45"""


@query(f"SELECT 'mof' || row_number() OVER (ORDER BY part, row_no, place) AS measurementID, * EXCLUDE (part, row_no, place) FROM ({_MOF})")
def dwc_measurements_whole(spark, sf_dir):
    """All sheets of a workbook, with their own column names, in all columns of the archive."""
    habitat = _parts(spark, sf_dir, "p_brand AS taxonID", "CASE WHEN p_size < 40 THEN p_type END AS Habitat_type", "CASE WHEN p_size > 20 THEN string(p_size) END AS maximumDephInMeters", "CASE WHEN p_size < 5 THEN 'old \"x\"' END AS Habitat_type_original", "CASE WHEN p_size < 30 THEN p_name END AS `HigherGeography (biome)`", "concat('L', p_size) AS LocationID", "concat('source ', p_size) AS `Source of information`", "p_type AS eventID")
    morphology = _parts(spark, sf_dir, "p_brand AS taxonID", "p_name AS MeasurementOrFact", "concat('code ', p_type) AS `...8`", "CASE WHEN p_size > 10 THEN p_name END AS measurementValue", "CASE WHEN p_size > 40 THEN 'old' END AS measurementValue_original", "CASE WHEN p_size > 30 THEN '25' END AS DevelopmentalStages", "CASE WHEN p_size > 30 THEN '7' END AS organismQuantity", "'individuals' AS organismQuantityType", "'measured' AS measurementMethod", "concat('source ', p_size) AS `Source of information`", "p_type AS eventID")
    diet = _parts(spark, sf_dir, "p_brand AS taxonID", "CASE WHEN p_size > 5 THEN p_name END AS measurementType", "'percentage_of_items' AS measurementValue", "CASE WHEN p_size < 45 THEN string(p_size) END AS measurementAccuracy", "'%' AS organismQuantity", "CASE WHEN p_size > 20 THEN '12' END AS organismQuantityType", "CASE WHEN p_size > 15 THEN '30' END AS DevelopmentalStage", "p_type AS eventID")
    return darwin_core.measurements(darwin_core.habitat_measurements(habitat), darwin_core.morphology_measurements(morphology), darwin_core.diet_measurements(diet))


@query(r"""SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS measurementID, o_custkey AS taxonID, CASE l_returnflag WHEN 'A' THEN 'Number' WHEN 'N' THEN 'Word' END AS measurementType, l_returnflag AS measurementTypeID, CASE WHEN l_returnflag = 'N' THEN p_type ELSE regexp_replace(l_quantity::DOUBLE::VARCHAR, '\.0$', '') END AS measurementValue,
      CASE WHEN l_returnflag = 'A' THEN 'mm' END AS measurementUnit, CASE WHEN l_quantity > 40 THEN '0.5' END AS measurementAccuracy, strftime(l_shipdate, '%Y-%m-%d') AS measurementDeterminedDate,
      'x' || l_linenumber || CASE WHEN l_quantity > 10 THEN ' (m1; prompt ' || CASE WHEN l_quantity > 20 THEN 'p2' ELSE 'NA' END || ')' ELSE '' END AS measurementDeterminedBy, 'assisted extraction from the literature; origin of the value: ' || CASE WHEN l_quantity > 30 THEN 'table' ELSE 'NA' END AS measurementMethod,
      'stage=' || CASE WHEN l_quantity > 12 THEN '25' ELSE 'NA' END || '; temperature_C=' || CASE WHEN l_quantity > 25 THEN regexp_replace((l_quantity / 2)::DOUBLE::VARCHAR, '\.0$', '') ELSE 'NA' END || '; setting=NA; n=' || l_linenumber || '; name_in_article=' || p_name || '; confidence=' || CASE WHEN l_discount = 0 THEN '0.0' ELSE round(l_discount, 3)::VARCHAR END
      || '; source=' || CASE WHEN o_orderstatus = 'F' THEN 'NA' ELSE o_orderpriority END || ' p.' || CASE WHEN l_quantity > 5 THEN l_linenumber::VARCHAR ELSE 'NA' END || '; primary_source=' || CASE WHEN l_quantity > 45 THEN '10.9/p' WHEN o_orderstatus = 'F' THEN 'NA' ELSE o_orderpriority END || '; verbatim="a ' || chr(39) || l_returnflag || chr(39) || '"' AS measurementRemarks
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE l_linestatus = 'F'""")
def dwc_published(spark, sf_dir):
    o, p = read(spark, sf_dir, "orders"), read(spark, sf_dir, "part")
    works = o.selectExpr("o_orderkey AS work_id", "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS doi")
    e = read(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("p_partkey") == F.col("l_partkey")).selectExpr(
        "o_orderkey AS work_id", "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS extraction_id", "o_custkey AS entity_id", "l_returnflag AS attribute_id", "double(l_quantity) AS value_num", "CASE l_returnflag WHEN 'N' THEN p_type END AS value_cat", "CASE l_returnflag WHEN 'A' THEN 'mm' END AS unit",
        "CASE WHEN l_quantity > 12 THEN '25' END AS stage", "CASE WHEN l_quantity > 25 THEN double(l_quantity / 2) END AS temperature", "CAST(NULL AS STRING) AS setting", "l_linenumber AS n", "CASE WHEN l_quantity > 40 THEN '0.5' END AS dispersion", "concat('a \"', l_returnflag, '\"') AS evidence", "l_discount AS confidence",
        "concat('x', l_linenumber) AS extractor", "CASE WHEN l_quantity > 10 THEN 'm1' END AS model_version", "CASE WHEN l_quantity > 20 THEN 'p2' END AS prompt_version", "CASE WHEN l_quantity > 30 THEN 'table' END AS origin", "CASE WHEN l_quantity > 45 THEN '10.9/p' END AS primary_doi", "CASE WHEN l_quantity > 5 THEN l_linenumber END AS page",
        "p_name AS name_in_article", "l_shipdate AS at", "CASE l_linestatus WHEN 'F' THEN 'approved' ELSE 'raw' END AS status")
    names = spark.createDataFrame([("A", "Number"), ("N", "Word")], "attribute_id string, name string")
    return darwin_core.published(e, works, names)


@query("""SELECT c_custkey AS taxonID, c_name AS scientificName, c_mktsegment AS family, 'Animalia' AS kingdom, 'Chordata' AS phylum, 'Amphibia' AS class, 'Anura' AS "order", 'species' AS taxonRank, 'A list, 5.0' AS nameAccordingTo FROM customer""")
def dwc_published_taxa(spark, sf_dir):
    return darwin_core.published_taxa(read(spark, sf_dir, "customer").selectExpr("c_custkey AS entity_id", "c_name AS entity", "c_mktsegment AS family"), "A list, 5.0")


@query("SELECT c_name AS entity, o_orderpriority AS attribute_id, CASE o_orderstatus WHEN 'O' THEN 'not_searched' ELSE 'searched_without_data' END AS state FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'")
def dwc_gaps(spark, sf_dir):
    pairs = read(spark, sf_dir, "orders").selectExpr("o_custkey AS entity_id", "o_orderpriority AS attribute_id", "CASE o_orderstatus WHEN 'O' THEN 'not_searched' WHEN 'P' THEN 'searched_without_data' ELSE 'extracted' END AS state")
    return darwin_core.gaps(pairs, read(spark, sf_dir, "customer").selectExpr("c_custkey AS entity_id", "c_name AS entity"))


def _workbook(spark, sf_dir):
    d = _parts(spark, sf_dir, "CASE WHEN p_size < 45 THEN p_brand ELSE concat(p_brand, '  x') END AS taxonID", "p_name AS scientificName", "CASE WHEN p_size < 3 THEN ' ' ELSE p_type END AS measurementValue", "p_brand AS family", "p_type AS genus")
    return {"Taxonomy": d.where("row_no < 300"), "Morphology_DWC": d.drop("family", "genus")}


@query("""WITH d AS (SELECT p_partkey AS row_no, CASE WHEN p_size < 45 THEN p_brand ELSE p_brand || '  x' END AS id, p_name AS name, CASE WHEN p_size < 3 THEN ' ' ELSE p_type END AS v FROM part),
    b AS (SELECT 'Taxonomy' AS sheet, * FROM d WHERE row_no < 300 UNION ALL SELECT 'Morphology_DWC', * FROM d), c AS (SELECT *, replace(id, '  ', ' ') AS sid FROM b),
    u AS (SELECT *, row_number() OVER (PARTITION BY sid, name ORDER BY sheet, row_no) AS k FROM c), f AS (SELECT *, count(*) OVER (PARTITION BY sid) AS names, count(*) OVER (PARTITION BY name) AS ids FROM u WHERE k = 1),
    o AS (SELECT sid, min(row_no) AS row_no FROM c WHERE sheet = 'Morphology_DWC' AND sid NOT IN (SELECT sid FROM c WHERE sheet = 'Taxonomy') GROUP BY 1),
    a AS (SELECT sheet, row_no, 'taxonID' AS col, id AS value, 'double space' AS problem FROM b WHERE contains(id, '  ') UNION ALL SELECT sheet, row_no, 'measurementValue', v, 'space at an end' FROM b WHERE v = ' '
      UNION ALL SELECT sheet, row_no, 'scientificName', sid || ' -> ' || name, 'id with several names' FROM f WHERE names > 1 UNION ALL SELECT sheet, row_no, 'taxonID', name || ' -> ' || sid, 'name with several ids' FROM f WHERE ids > 1
      UNION ALL SELECT 'Morphology_DWC', row_no, 'taxonID', sid, 'unknown id' FROM o)
    SELECT sheet, col AS "column", problem, value, count(*) AS n_cells, min(row_no) AS example_row FROM a GROUP BY 1, 2, 3, 4""")
def audit_workbook(spark, sf_dir):
    return darwin_core.audited(_workbook(spark, sf_dir))
