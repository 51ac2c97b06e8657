"""Queries of target lists, names, search, triage and bibliographic matching: parts as references, suppliers and nations as entities."""

from pyspark.sql import functions as F

from sievework.functions import text
from sievework.operators import bibliography, names, retrieval, search, targets
from sievework.sources.tables import read

from .registry import query

_KEY = "trim(regexp_replace(regexp_replace(lower(strip_accents(regexp_replace(regexp_replace(regexp_replace({0}, '&amp;(amp;)*', '&', 'g'), '&lt;', '<', 'g'), '<[^>]+>', ' ', 'g'))), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_ID = "substr(sha256({0}), 1, 16)"
_REF = """r AS (SELECT p_partkey AS ord, p_brand AS entity_id, CASE WHEN p_size = 50 THEN NULL WHEN p_size > 25 THEN '<i>' || upper(p_name) || '</i>: an &amp; B' ELSE p_name || ' an b' END AS title,
    1990 + p_size AS year, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN upper('10.1/' || p_size || '-' || replace(p_name, ' ', '-')) WHEN p_type = 'PROMO' THEN '' END AS doi,
    CASE WHEN p_retailprice < 950 THEN 'http://w/' || p_partkey END AS url FROM part)"""
_GROUP = f"""{_REF}, d AS (SELECT * REPLACE (lower(nullif(doi, '')) AS doi), CASE WHEN title IS NULL THEN 'doi:' || coalesce(lower(nullif(doi, '')), 'NA') ELSE {_KEY.format('title')} || ' ' || year END AS k FROM r WHERE doi IS NOT NULL OR title IS NOT NULL),
    g AS (SELECT k, arg_min(doi, ord) AS doi, arg_min(url, ord) AS url, arg_min(coalesce(lower(title), chr(1)), ord) AS title FROM d GROUP BY k),
    w AS (SELECT d.ord, d.entity_id, d.title, d.year, g.doi, g.url, {_ID.format("coalesce(g.doi, nullif(g.title, chr(1)), '')")} AS work_id FROM d JOIN g USING (k)),
    u AS (SELECT work_id, arg_min(url, ord) AS url FROM w GROUP BY work_id)"""


def references(spark, sf_dir):
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ord", "p_brand AS entity_id", "CASE WHEN p_size = 50 THEN NULL WHEN p_size > 25 THEN concat('<i>', upper(p_name), '</i>: an &amp; B') ELSE concat(p_name, ' an b') END AS title",
        "1990 + p_size AS year", "CASE WHEN p_type IN ('SMALL', 'LARGE') THEN upper(concat('10.1/', p_size, '-', replace(p_name, ' ', '-'))) WHEN p_type = 'PROMO' THEN '' END AS doi",
        "CASE WHEN p_retailprice < 950 THEN concat('http://w/', p_partkey) END AS url",
    )


@query(f"WITH {_GROUP} SELECT ord, work_id, doi, u.url FROM w JOIN u USING (work_id)")
def group_works(spark, sf_dir):
    return targets.grouped_works(references(spark, sf_dir), "ord").select("ord", "work_id", "doi", "url")


@query(f"WITH {_GROUP} SELECT DISTINCT work_id, entity_id FROM w")
def seed_links(spark, sf_dir):
    return targets.seeded(references(spark, sf_dir), "ord")[0]


@query(f"WITH {_GROUP}, f AS (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY ord) AS n FROM w) SELECT work_id, doi, title, year, u.url, 'found' AS status FROM f JOIN u USING (work_id) WHERE n = 1")
def seed_works(spark, sf_dir):
    return targets.seeded(references(spark, sf_dir), "ord")[1]


@query(f"WITH {_GROUP} SELECT DISTINCT work_id, true AS relevant, 1.0::DOUBLE AS prob, 'seed' AS decided_by FROM w")
def seed_triage(spark, sf_dir):
    return targets.seeded(references(spark, sf_dir), "ord")[2]


def _species(spark, sf_dir):
    """Suppliers as nested species: a status and references for each character."""
    ref = "named_struct('author', s_name, 'year', CASE WHEN s_acctbal < 0 THEN 'n.d.' ELSE string(1900 + s_nationkey) END, 'title', concat('On ', s_name), 'doi', CAST(NULL AS STRING), 'url', CAST(NULL AS STRING))"
    part = lambda low: f"named_struct('status', CASE WHEN s_acctbal > {low} THEN 'described' WHEN s_acctbal > 0 THEN 'unknown' END, 'refs', CASE WHEN s_acctbal > {low} THEN array({ref}, {ref}) WHEN s_acctbal > 0 THEN array({ref}) END)"
    return read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", f"{part(9000)} AS external", f"{part(8000)} AS oral", f"{part(7000)} AS cartilage")


@query("""SELECT s_suppkey AS entity_id, s_name AS entity, CASE WHEN s_acctbal > 9000 THEN 'described' WHEN s_acctbal > 0 THEN 'unknown' END AS status_external,
    CASE WHEN s_acctbal > 8000 THEN 'described' WHEN s_acctbal > 0 THEN 'unknown' END AS status_oral, CASE WHEN s_acctbal > 7000 THEN 'described' WHEN s_acctbal > 0 THEN 'unknown' END AS status_cartilage, s_acctbal > 7000 AS described FROM supplier""")
def target_list(spark, sf_dir):
    return targets.target_list(_species(spark, sf_dir))


@query("SELECT s_suppkey AS entity_id, s_name AS entity FROM supplier WHERE s_acctbal > 7000")
def target_list_described(spark, sf_dir):
    return targets.target_list(_species(spark, sf_dir), only_described=True).select("entity_id", "entity")


@query("""WITH c(character, low) AS (VALUES ('external', 9000), ('oral', 8000), ('cartilage', 7000)), n AS (SELECT *, CASE WHEN s_acctbal > low THEN 2 WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS k FROM supplier, c)
    SELECT s_suppkey AS entity_id, character, s_name AS author, CASE WHEN s_acctbal >= 0 THEN 1900 + s_nationkey END AS year, 'On ' || s_name AS title FROM n, range(2) t(i) WHERE i < k""")
def target_references(spark, sf_dir):
    return targets.references_of(_species(spark, sf_dir)).select("entity_id", "character", "author", "year", "title")


def _states(spark, sf_dir):
    state = "CASE o_orderstatus WHEN 'F' THEN 'extracted' WHEN 'P' THEN 'reviewed' ELSE 'not_searched' END AS state"
    return targets.first_rows(read(spark, sf_dir, "orders").selectExpr("o_custkey AS entity_id", "o_orderpriority AS attribute_id", state, "o_orderkey"), ["entity_id", "attribute_id"], ["o_orderkey"]).drop("o_orderkey")


_P = """p AS (SELECT o_custkey AS entity_id, o_orderpriority AS attribute_id, CASE arg_min(o_orderstatus, o_orderkey) WHEN 'F' THEN 'extracted' WHEN 'P' THEN 'reviewed' ELSE 'not_searched' END AS state FROM orders GROUP BY 1, 2)"""


@query(f"WITH {_P} SELECT c_custkey AS entity_id, a.attribute_id, 'not_searched' AS state FROM customer, (SELECT DISTINCT o_orderpriority AS attribute_id FROM orders) a WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.entity_id = c_custkey AND p.attribute_id = a.attribute_id)")
def new_pairs(spark, sf_dir):
    attributes = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("attribute_id"))
    return targets.new_pairs(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id")), attributes, _states(spark, sf_dir).drop("state"))


@query(f"WITH {_P}, s AS (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0) SELECT entity_id, attribute_id, CASE WHEN state = 'not_searched' AND c_custkey IS NOT NULL THEN 'searched_without_data' ELSE state END AS state FROM p LEFT JOIN s ON entity_id = c_custkey")
def close_round(spark, sf_dir):
    return targets.close_round(_states(spark, sf_dir), read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("entity_id")))


@query(f"WITH {_P}, c AS (SELECT c_custkey AS entity_id, '5-LOW' AS attribute_id, 'extracted' AS state FROM customer WHERE c_mktsegment = 'BUILDING') SELECT * FROM c UNION ALL SELECT p.* FROM p LEFT JOIN c USING (entity_id, attribute_id) WHERE c.state IS NULL")
def set_pair_states(spark, sf_dir):
    changes = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS entity_id", "'5-LOW' AS attribute_id", "'extracted' AS state")
    return targets.set_states(_states(spark, sf_dir), changes)


@query(f"WITH {_P} SELECT entity_id, count(*) FILTER (state IN ('extracted', 'reviewed')) AS covered, count(*) FILTER (state = 'not_searched') AS open FROM p GROUP BY entity_id HAVING open > 0 ORDER BY covered, open DESC, entity_id LIMIT 20")
def priorities(spark, sf_dir):
    return targets.priorities(_states(spark, sf_dir), 20)


# names

_NAME = "split_part(p_name, ' ', 1) || 'us ' || split_part(p_name, ' ', 2) || CASE WHEN p_size < 20 THEN 'us' WHEN p_size < 30 THEN 'a' ELSE 'e' END"


def _targets(spark, sf_dir):
    return read(spark, sf_dir, "part").where("p_type <> 'PROMO'").selectExpr("p_partkey AS entity_id", f"{_NAME} AS entity")


def _valid(spark, sf_dir):
    return read(spark, sf_dir, "part").where("p_type = 'PROMO' AND p_retailprice < 920 OR p_size = 19").selectExpr(f"{_NAME} AS name").distinct()


def _synonyms(spark, sf_dir):
    return read(spark, sf_dir, "part").where("p_size > 45").selectExpr(f"{_NAME} AS name", "concat(p_brand, ' ', p_type, CASE WHEN p_size > 48 THEN ' var' ELSE '' END) AS synonym").distinct()


_MATCH = f"""t AS (SELECT p_partkey AS entity_id, {_NAME} AS entity FROM part WHERE p_type <> 'PROMO'), v AS (SELECT DISTINCT {_NAME} AS name FROM part WHERE p_type = 'PROMO' AND p_retailprice < 920 OR p_size = 19),
    st AS (SELECT regexp_replace(name, '(us|a|um|is|e)$', '') AS stem, min(name) AS name FROM v GROUP BY 1 HAVING count(*) = 1),
    m AS (SELECT entity_id, entity, coalesce(v.name, st.name) AS matched FROM t LEFT JOIN v ON v.name = entity LEFT JOIN st ON st.stem = regexp_replace(entity, '(us|a|um|is|e)$', ''))"""


@query(f"WITH {_MATCH} SELECT * FROM m")
def matched_names(spark, sf_dir):
    return names.matched_targets(_targets(spark, sf_dir), _valid(spark, sf_dir))


_DERIVED = f"""{_MATCH}, sy AS (SELECT DISTINCT {_NAME} AS name, p_brand || ' ' || p_type || CASE WHEN p_size > 48 THEN ' var' ELSE '' END AS synonym FROM part WHERE p_size > 45),
    l AS (SELECT DISTINCT entity_id, entity, matched, alias FROM (SELECT entity_id, entity, matched, synonym AS alias FROM m JOIN sy ON matched = name UNION ALL SELECT entity_id, entity, matched, matched FROM m WHERE matched <> entity) WHERE alias <> entity),
    b AS (SELECT *, array_to_string(string_split(alias, ' ')[1:2], ' ') AS two, len(string_split(alias, ' ')) - 1 AS spaces, count(*) OVER (PARTITION BY alias) AS n FROM l),
    own AS (SELECT entity_id, entity AS two FROM m UNION SELECT entity_id, matched FROM m UNION SELECT entity_id, alias FROM b WHERE spaces = 1),
    x AS (SELECT entity_id, entity, alias, CASE WHEN two IN (SELECT name FROM v) AND two <> entity AND two <> matched THEN 'two words are another valid name' WHEN spaces >= 2 AND (entity_id, two) NOT IN (SELECT entity_id, two FROM own WHERE two IS NOT NULL) THEN 'three words of another name'
          WHEN n > 1 THEN 'alias of several entities' END AS reason FROM b UNION ALL SELECT entity_id, entity, NULL, 'name not found' FROM m WHERE matched IS NULL)"""


def _derived(spark, sf_dir):
    return names.derived_aliases(_targets(spark, sf_dir), _synonyms(spark, sf_dir), _valid(spark, sf_dir))


@query(f"WITH {_DERIVED} SELECT * FROM x")
def derived_aliases(spark, sf_dir):
    return _derived(spark, sf_dir)


_CURATED = f"SELECT p_partkey AS entity_id, p_brand || ' of old' AS alias, coalesce(CASE WHEN p_size > 20 THEN p_type END, 'curated') AS source, nullif(lower(CASE WHEN p_size < 10 THEN '10.1/A' WHEN p_size < 15 THEN '' END), '') AS work_doi FROM part WHERE p_type <> 'PROMO' AND p_retailprice > 910"


def _curated(spark, sf_dir):
    listed = read(spark, sf_dir, "part").where("p_retailprice > 910").selectExpr(f"concat({_NAME.replace(' || ', ', ')}, p_partkey) AS entity", "concat(p_brand, ' of old') AS alias", "CASE WHEN p_size > 20 THEN p_type END AS source", "CASE WHEN p_size < 10 THEN ' 10.1/A ' WHEN p_size < 15 THEN '  ' END AS work_doi")
    return names.curated_aliases(listed, _targets(spark, sf_dir).withColumn("entity", F.concat("entity", F.col("entity_id").cast("string"))))


@query(_CURATED)
def curated_aliases(spark, sf_dir):
    return _curated(spark, sf_dir)


@query(f"""WITH {_DERIVED}, c AS ({_CURATED}), a AS (SELECT *, 0 AS o FROM c UNION ALL SELECT entity_id, alias, 'authority', NULL, 1 FROM x WHERE reason IS NULL),
    k AS (SELECT *, row_number() OVER (PARTITION BY entity_id, alias ORDER BY o, source, work_doi NULLS FIRST) AS n FROM a)
    SELECT entity_id, alias, source, work_doi FROM k WHERE n = 1 AND entity_id NOT IN (SELECT p_partkey FROM part WHERE p_size = 7)""")
def all_aliases(spark, sf_dir):
    present = read(spark, sf_dir, "part").where("p_size = 7").select(F.col("p_partkey").alias("entity_id"))
    both = names.all_aliases(_curated(spark, sf_dir), _derived(spark, sf_dir), _curated(spark, sf_dir).limit(0).select("entity_id", "alias"))
    return names.new_aliases(both, present.join(both.select("entity_id", "alias"), "entity_id"))


@query(f"""WITH c AS ({_CURATED}), t AS (SELECT p_partkey AS entity_id, {_NAME} AS entity FROM part WHERE p_type <> 'PROMO'), w AS (SELECT l_orderkey AS work_id, l_partkey AS entity_id, CASE WHEN l_returnflag = 'A' THEN '10.1/a' END AS doi FROM lineitem),
    n AS (SELECT work_id, entity_id, entity AS name FROM w JOIN t USING (entity_id) UNION SELECT work_id, entity_id, alias FROM w JOIN c USING (entity_id) WHERE work_doi IS NULL OR work_doi = doi)
    SELECT work_id, entity_id, string_agg(name, '|' ORDER BY name) AS names FROM n GROUP BY 1, 2""")
def names_of_works(spark, sf_dir):
    works = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS work_id", "l_partkey AS entity_id", "CASE WHEN l_returnflag = 'A' THEN '10.1/A' END AS doi").distinct()
    out = names.names_of(_targets(spark, sf_dir), _curated(spark, sf_dir), works)
    return out.select("work_id", "entity_id", F.array_join("names", "|").alias("names"))


@query(f"WITH t AS (SELECT p_partkey AS entity_id, split_part(p_name, ' ', 1) AS g, {_NAME} AS entity FROM part WHERE p_type <> 'PROMO') SELECT entity_id, '\\b(' || entity || '|' || substr(g, 1, 1) || '\\.?\\s+' || split_part(entity, ' ', 2) || ')' AS pattern FROM t")
def name_patterns(spark, sf_dir):
    return _targets(spark, sf_dir).select("entity_id", names.pattern_of(F.array("entity")).alias("pattern"))


_ALIAS = ("thonti", "esque la", "pour le", "of the", "nowhere at all")


def _doubtful(spark):
    return spark.createDataFrame([(i, f"E{i}", a) for i, a in enumerate((*_ALIAS, "of the", None))], "entity_id int, entity string, alias string")


@query(f"""WITH a(entity_id, entity, alias) AS (VALUES {", ".join(f"({i}, 'E{i}', '{a}')" for i, a in enumerate((*_ALIAS, "of the")))}, (6, 'E6', NULL)),
    h AS (SELECT DISTINCT a.alias, doc_id, source FROM a JOIN documents ON regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])' || alias || '($|[^\\p{{L}}\\p{{N}}_])')),
    n AS (SELECT entity_id, count(*) AS n_works, count(*) FILTER (source = 'src' || entity_id) AS n_works_of_entity FROM a JOIN h USING (alias) GROUP BY entity_id)
    SELECT entity_id, alias, coalesce(n_works, 0) AS n_works, coalesce(n_works_of_entity, 0) AS n_works_of_entity,
    CASE alias WHEN 'of the' THEN CASE entity WHEN 'E3' THEN 'E5' ELSE 'E3' END END AS other_entities FROM a LEFT JOIN n USING (entity_id)""")
def alias_evidence(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    links = docs.selectExpr("CAST(substring(source, 4) AS INT) AS entity_id", "doc_id AS work_id")
    out = names.alias_evidence(_doubtful(spark), docs.selectExpr("doc_id AS work_id", "source AS title", "text"), links)
    return out.select("entity_id", "alias", "n_works", "n_works_of_entity", "other_entities")


@query("""SELECT p_name AS entity, p_brand AS alias, CASE WHEN p_size < 20 THEN '10.1/' || p_size END AS work_doi, 'R, 1: review of doubtful aliases' || CASE WHEN p_size > 5 THEN '; n' ELSE '' END AS source FROM part WHERE p_size < 35""")
def decided_aliases(spark, sf_dir):
    sheet = read(spark, sf_dir, "part").selectExpr("p_name AS entity", "p_brand AS alias", "CASE WHEN p_size < 20 THEN ' this_work_only' WHEN p_size < 35 THEN 'global' WHEN p_size < 40 THEN ' ' ELSE 'never' END AS decision", "concat('10.1/', p_size) AS work_doi", "CASE WHEN p_size > 5 THEN 'n' END AS note")
    return names.decided_aliases(sheet, "R", "1")


def _name_rows(spark, sf_dir):
    return read(spark, sf_dir, "part").selectExpr("p_type AS sheet", "concat(' ', p_brand) AS entity_id", "concat(p_name, '  (Author, ', p_size, ')') AS name").where("entity_id <> ' Brand#1'").union(read(spark, sf_dir, "part").where("p_brand = 'Brand#1'").selectExpr("p_type", "p_brand", "'one name'"))


_CASES = """p AS (SELECT p_type AS sheet, p_brand AS entity_id, CASE WHEN p_brand = 'Brand#1' THEN 'one name' ELSE p_name END AS name FROM part),
    c AS (SELECT entity_id, name, count(*) AS n_lines, string_agg(DISTINCT sheet, '|' ORDER BY sheet) AS sheets FROM p GROUP BY 1, 2),
    k AS (SELECT *, count(*) OVER (PARTITION BY entity_id) AS names, count(*) OVER (PARTITION BY name) AS ids FROM c),
    f AS (SELECT entity_id, name, n_lines, sheets, CASE WHEN names > 1 AND ids > 1 THEN 'id and name' WHEN names > 1 THEN 'one id, several names' ELSE 'one name, several ids' END AS conflict FROM k WHERE names > 1 OR ids > 1)"""


@query(f"WITH {_CASES} SELECT * FROM f")
def name_conflicts(spark, sf_dir):
    return names.name_conflicts(_name_rows(spark, sf_dir))


@query(f"WITH {_CASES}, a AS (SELECT name, min(CASE WHEN starts_with(name, 'red') THEN name ELSE 'blue bolt' END) AS accepted FROM f WHERE name < 's' GROUP BY name) SELECT entity_id, name, accepted, accepted IS NOT NULL AND accepted = name AS is_accepted FROM f LEFT JOIN a USING (name)")
def names_against_authority(spark, sf_dir):
    cases = names.name_conflicts(_name_rows(spark, sf_dir))
    authority = cases.where("name < 's'").select("name", F.when(F.col("name").startswith("red"), F.col("name")).otherwise("blue bolt").alias("accepted")).distinct()
    return names.against_authority(cases, authority).select("entity_id", "name", "accepted", "is_accepted")


@query(f"WITH {_CASES} SELECT entity_id, string_agg(name || ' (' || n_lines || ' lines, ' || sheets || ')', ' | ' ORDER BY n_lines DESC, name) AS spellings FROM f GROUP BY entity_id")
def name_decisions(spark, sf_dir):
    return names.decision_template(names.name_conflicts(_name_rows(spark, sf_dir))).select("entity_id", "spellings")


# search, triage, acquisition

@query("""SELECT s_suppkey AS entity_id, l.language, '"' || s_name || '" AND (' || l.terms || ')' AS query FROM supplier, (VALUES ('pt', 'girino OR larva OR "desenvolvimento larval"'), ('en', 'tadpole OR larva OR "larval development"')) l(language, terms)""")
def search_queries(spark, sf_dir):
    return search.queries_for(read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS entity_id", "s_name AS entity"), ["pt", "en"]).select("entity_id", "language", "query")


@query("SELECT conv_id, string_agg(w, ' ' ORDER BY turn, i) AS abstract FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM conversations WHERE text IS NOT NULL) GROUP BY conv_id")
def inverted_abstracts(spark, sf_dir):
    w = read(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("i", "w"))
    place = w.groupBy("conv_id", "w").agg(F.collect_list((F.col("turn") * 1_000_000 + F.col("i")).cast("int")).alias("p"))
    index = place.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "p"))).alias("m"))
    return index.select("conv_id", search.abstract_of(F.col("m")).alias("abstract"))


@query(r"SELECT page_id, nullif(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')), '') AS abstract FROM pages")
def clean_abstracts(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", search.clean_abstract("html").alias("abstract"))


@query("SELECT event_id, 'a.b/' || user_id AS doi, event_type AS title, CASE WHEN user_id > 20 THEN 2000 + user_id END AS year, CASE WHEN user_id > 30 THEN 'http://x' END AS pdf_url, 'a b a' AS abstract FROM events WHERE event_type IN ('view', 'click')")
def open_records(spark, sf_dir):
    raw = """concat('{"doi": "https://doi.org/A.B/', user_id, '", "title": "', event_type, '"', CASE WHEN user_id > 20 THEN concat(', "publication_year": ', 2000 + user_id) ELSE '' END,
        CASE WHEN event_type IN ('view', 'click') THEN ', "type": "article"' ELSE ', "type": "paratext"' END, CASE WHEN user_id > 30 THEN ', "locations": [{"pdf_url": "http://x"}]' ELSE ', "locations": []' END, ', "abstract_inverted_index": {"b": [1], "a": [0, 2]}}')"""
    rows = read(spark, sf_dir, "events").selectExpr("event_id", f"{raw} AS raw").select("event_id", search.open_record("raw").alias("r")).select("event_id", "r.*")
    return search.allowed(rows).drop("type")


_REC = """x AS (SELECT l_suppkey AS entity_id, CASE WHEN l_returnflag = 'A' THEN upper('10.1/x' || l_partkey) END AS doi, 'Part ' || l_partkey AS title, CASE WHEN l_quantity > 40 THEN 'abs ' || l_quantity::INT END AS abstract,
    CASE WHEN l_linenumber = 1 THEN 'https://f1000research.com/' || CASE WHEN l_discount > 0.05 THEN 'posters' ELSE 'slides' END || '/' || l_partkey WHEN l_linenumber = 2 THEN 'http://other' END AS page_url, l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord FROM lineitem),
    k AS (SELECT *, substr(sha256(coalesce(lower(doi), lower(title))), 1, 16) AS work_id FROM x)"""


def _records(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS entity_id", "CASE WHEN l_returnflag = 'A' THEN upper(concat('10.1/x', l_partkey)) END AS doi", "concat('Part ', l_partkey) AS title", "CASE WHEN l_quantity > 40 THEN concat('abs ', CAST(l_quantity AS INT)) END AS abstract",
        "CASE WHEN l_linenumber = 1 THEN concat('https://f1000research.com/', CASE WHEN l_discount > 0.05 THEN 'posters' ELSE 'slides' END, '/', l_partkey) WHEN l_linenumber = 2 THEN 'http://other' END AS page_url",
        "l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ord", "1990 + l_linenumber AS year")
    return search.found_works(rows, ["ord"])


@query(f"WITH {_REC}, f AS (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY ord) AS n FROM k), a AS (SELECT work_id, arg_min(abstract, ord) AS abstract, arg_min(page_url, ord) AS page_url FROM k GROUP BY 1) SELECT work_id, lower(doi) AS doi, title, a.page_url, a.abstract FROM f JOIN a USING (work_id) WHERE n = 1")
def search_works(spark, sf_dir):
    return _records(spark, sf_dir)[1].select("work_id", "doi", "title", "page_url", "abstract")


@query(f"WITH {_REC} SELECT DISTINCT work_id, entity_id FROM k")
def search_links(spark, sf_dir):
    return _records(spark, sf_dir)[0]


@query(f"WITH {_REC}, l AS (SELECT entity_id, count(DISTINCT work_id) AS n FROM k GROUP BY 1) SELECT s_suppkey AS entity_id, coalesce(n, 0) AS n_results, substr(sha256(concat_ws(chr(1), s_suppkey, 'en', '\"' || s_name || '\" AND (tadpole OR larva OR \"larval development\")')), 1, 16) AS search_id FROM supplier LEFT JOIN l ON entity_id = s_suppkey")
def search_log(spark, sf_dir):
    queries = search.queries_for(read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS entity_id", "s_name AS entity"), ["en"])
    return search.search_log(queries, _records(spark, sf_dir)[0]).select("entity_id", "n_results", "search_id")


@query(f"WITH {_REC}, a AS (SELECT work_id, arg_min(page_url, ord) AS u FROM k GROUP BY 1) SELECT work_id, CASE WHEN u LIKE '%/posters/%' THEN 'poster' WHEN u LIKE '%/slides/%' THEN 'conference_abstract' END AS document_type FROM a")
def document_type_by_url(spark, sf_dir):
    return search.typed_by_url(_records(spark, sf_dir)[1].withColumn("document_type", F.lit(None).cast("string"))).select("work_id", "document_type")


_TITLED = """w AS (SELECT o_orderkey AS work_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'The <i>' || o_orderpriority || '</i>  Nation ' || o_custkey || 'x' END AS title FROM orders), l AS (SELECT o_orderkey AS work_id, c_nationkey AS entity_id FROM orders JOIN customer ON c_custkey = o_custkey),
    n AS (SELECT n_nationkey AS entity_id, CASE WHEN n_regionkey = 0 THEN '1-URGENT' WHEN n_regionkey = 1 THEN 'HIGH nation' ELSE n_name END AS name FROM nation),
    h AS (SELECT work_id, bool_or(title IS NOT NULL AND ((name = '1-URGENT' AND title LIKE '%1-URGENT%') OR (name = 'HIGH nation' AND title LIKE '%2-HIGH%'))) AS named FROM l JOIN n USING (entity_id) JOIN w USING (work_id) GROUP BY work_id)"""


def _titled(spark, sf_dir):
    works = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS work_id", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat('The <i>', o_orderpriority, '</i>  Nation ', o_custkey, 'x') END AS title")
    links = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("work_id"), F.col("c_nationkey").alias("entity_id"))
    known = read(spark, sf_dir, "nation").selectExpr("n_nationkey AS entity_id", "array(CASE WHEN n_regionkey = 0 THEN '1-URGENT' WHEN n_regionkey = 1 THEN 'HIGH nation' ELSE n_name END) AS names")
    return works, links, known


@query(f"WITH {_TITLED} SELECT work_id, coalesce(named, false) AS named FROM w LEFT JOIN h USING (work_id)")
def named_in_title(spark, sf_dir):
    return search.named_in_title(*_titled(spark, sf_dir)).select("work_id", "named")


def _answers(works):
    prob = F.when(F.col("work_id") < 900, (F.col("work_id") / 1000).cast("double"))
    return works.select("work_id", F.when(F.length("title") > 27, F.col("work_id") > 300).alias("relevant"), prob.alias("prob"), F.lit("because").alias("why"), F.when(F.length("title") == 29, "timeout").alias("error"))


@query(f"""WITH {_TITLED}, a AS (SELECT work_id, title, CASE WHEN length(title) > 27 THEN work_id > 300 END AS relevant, CASE WHEN work_id < 900 THEN work_id / 1000 END AS prob, CASE WHEN length(title) = 29 THEN 'timeout' END AS error FROM w),
    t AS (SELECT *, error IS NOT NULL OR relevant IS NULL AS none FROM a JOIN h USING (work_id))
    SELECT work_id, CASE WHEN named THEN true WHEN NOT none THEN relevant END AS relevant, CASE WHEN named THEN 1.0 WHEN NOT none THEN prob END::DOUBLE AS prob,
    CASE WHEN named THEN 'name in title' WHEN none THEN 'no answer: ' || coalesce(error, 'empty') ELSE 'because' END AS why,
    CASE WHEN named THEN 'rule:name_in_title' WHEN none OR coalesce(prob BETWEEN 0.35 AND 0.75, true) THEN 'human_queue' ELSE 'agent:m' END AS decided_by FROM t""")
def triage(spark, sf_dir):
    return search.triaged(*_titled(spark, sf_dir), _answers, "m")


@query(f"""WITH {_TITLED} SELECT work_id, title, work_id / 1000 AS prob FROM w WHERE length(title) > 27 AND length(title) <> 29 AND work_id BETWEEN 350 AND 750""")
def human_queue(spark, sf_dir):
    works, _, _ = _titled(spark, sf_dir)
    return search.human_queue(search.triage_decision(_answers(works), "m"), works).where("relevant IS NOT NULL AND prob IS NOT NULL").select("work_id", "title", "prob")


@query("SELECT o_orderkey AS work_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS relevant, CASE WHEN o_orderstatus = 'P' THEN 'human_queue' ELSE 'R' END AS decided_by FROM orders")
def human_answers(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    before = o.selectExpr("o_orderkey AS work_id", "CAST(NULL AS BOOLEAN) AS relevant", "0.5D AS prob", "'w' AS why", "'human_queue' AS decided_by")
    sheet = o.selectExpr("o_orderkey AS work_id", "CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE '?' END AS decision", "0.5D AS prob", "'w' AS why")
    return search.human_answers(before, sheet, "R").select("work_id", "relevant", "decided_by")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 10 THEN CASE WHEN l_returnflag = 'A' THEN 'error' ELSE 'no_pdf' END WHEN l_discount > 0.05 AND l_linestatus = 'F' THEN 'needs_ocr' WHEN l_linestatus = 'O' THEN 'pdf_ocr' ELSE 'pdf_ok' END AS status FROM lineitem""")
def acquisition_status(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", search.acquisition_status(F.when(F.col("l_quantity") >= 10, "p"), F.when(F.col("l_returnflag") == "A", "e"), F.col("l_discount") > 0.05, F.col("l_linestatus") == "O").alias("status"))


@query("SELECT o_orderkey AS work_id FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F' AND c_acctbal > 0")
def works_to_acquire(spark, sf_dir):
    works = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS work_id", "o_custkey", "CASE WHEN o_orderstatus = 'F' THEN 'x.pdf' END AS path")
    rated = works.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr("work_id", "c_acctbal > 0 AS relevant")
    return search.to_acquire(works, rated).select("work_id")


@query("SELECT p_partkey AS work_id, p_name AS title, p_size AS year, coalesce(CASE WHEN p_size < 10 THEN 'u' END, CASE WHEN p_size < 20 THEN 's' END) AS open_link, CASE WHEN p_type = 'SMALL' THEN p_brand END AS full_text_link FROM part WHERE p_retailprice < 950")
def works_without_pdf(spark, sf_dir):
    works = read(spark, sf_dir, "part").selectExpr("p_partkey AS work_id", "p_name AS title", "p_size AS year", "CASE WHEN p_size < 10 THEN 'u' END AS pdf_url", "CASE WHEN p_size < 20 THEN 's' END AS supplement_url", "CASE WHEN p_type = 'SMALL' THEN 'seed' ELSE 'search' END AS source", "p_brand AS page_url", "CASE WHEN p_retailprice < 950 THEN 'no_pdf' ELSE 'pdf_ok' END AS status")
    return search.without_pdf(works)


def _manual(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    works = part.selectExpr("CAST(p_partkey AS STRING) AS work_id", "concat('10.1/', p_partkey) AS doi", "CAST(NULL AS STRING) AS path", "'no_pdf' AS status")
    sheet = part.selectExpr("CASE WHEN p_size < 20 THEN CAST(p_partkey AS STRING) ELSE '?' END AS work_id", "CASE WHEN p_size < 40 THEN upper(concat(' 10.1/', p_partkey)) END AS doi", "CASE WHEN p_type = 'PROMO' THEN ' ' ELSE concat(p_brand, '.pdf ') END AS file")
    files = part.select(F.concat("p_brand", F.lit(".pdf")).alias("file"), (F.col("p_brand") != "Brand#3").alias("is_pdf")).distinct().where("file <> 'Brand#4.pdf'")
    return works, search.manual_files(sheet, works, files)


_MANUAL = """m AS (SELECT CASE WHEN p_size < 40 THEN p_partkey::VARCHAR ELSE '?' END AS work_id, p_brand || '.pdf' AS file,
    CASE WHEN p_size >= 40 THEN 'unknown work' WHEN p_brand = 'Brand#4' THEN 'file not found' WHEN p_brand = 'Brand#3' THEN 'no pdf' END AS problem FROM part WHERE p_type <> 'PROMO')"""


@query(f"WITH {_MANUAL} SELECT * FROM m")
def manual_files(spark, sf_dir):
    return _manual(spark, sf_dir)[1]


@query(f"WITH {_MANUAL} SELECT p_partkey::VARCHAR AS work_id, file AS path, CASE WHEN file IS NULL THEN 'no_pdf' ELSE 'pdf_manual' END AS status FROM part LEFT JOIN (SELECT * FROM m WHERE problem IS NULL) g ON work_id = p_partkey::VARCHAR")
def manual_files_placed(spark, sf_dir):
    return search.placed(*_manual(spark, sf_dir)).select("work_id", "path", "status")


@query("SELECT doc_id, length(regexp_replace(coalesce(text, ''), '\\s', '', 'g')) < 2000 AS needs_ocr FROM documents")
def needs_ocr(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", search.needs_ocr("text").alias("needs_ocr"))


@query("SELECT doc_id, contains(substr(text, 1, 300), '%PDF-') OR doc_id < 100 AS is_pdf FROM documents WHERE text IS NOT NULL")
def is_pdf(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", search.is_pdf(F.encode(F.concat(F.when(F.col("doc_id") < 100, " %PDF-1.4").otherwise(""), "text"), "UTF-8")).alias("is_pdf"))


# bibliographic matching

def _pairs(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    refs = part.selectExpr("p_partkey AS ref_id", "concat('The larval development of the ', p_name, ' in ', p_brand) AS title", "1990 + p_size AS year", "concat('Silva, ', p_type, '; ', split_part(p_name, ' ', 1)) AS authors", "p_brand AS entity_id", "CASE WHEN p_size < 5 THEN 'X' END AS doi")
    cands = read(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS ref_id", "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey) AS cand_id", "l_quantity", "l_suppkey", "l_returnflag", "l_discount").join(part, F.col("ref_id") == F.col("p_partkey")).selectExpr(
        "ref_id", "cand_id", "CASE WHEN l_quantity < 15 THEN concat('<i>The larval</i> development of the ', p_name, ' in ', p_brand) WHEN l_quantity < 30 THEN concat('The larval development of the ', p_name, ' in ', p_brand, ': part two of a series') "
        "WHEN l_quantity < 40 THEN concat('The larval developmemt of ', p_name) WHEN l_quantity < 45 THEN p_type END AS cand_title",
        "CASE WHEN l_returnflag <> 'N' THEN 1990 + p_size + CAST(l_discount * 30 AS INT) END AS cand_year", "CASE WHEN l_suppkey > 5 THEN concat('de ', split_part(p_name, ' ', 1)) WHEN l_suppkey > 2 THEN 'Other' END AS surname", "CASE WHEN l_discount < 0.05 THEN cand_id END AS cand_doi")
    return refs, cands


_SIM = f"""c AS (SELECT l_partkey AS ref_id, l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS cand_id, 'The larval development of the ' || p_name || ' in ' || p_brand AS title, 1990 + p_size AS year,
    CASE WHEN l_quantity < 15 THEN '<i>The larval</i> development of the ' || p_name || ' in ' || p_brand WHEN l_quantity < 30 THEN 'The larval development of the ' || p_name || ' in ' || p_brand || ': part two of a series' WHEN l_quantity < 40 THEN 'The larval developmemt of ' || p_name WHEN l_quantity < 45 THEN p_type END AS cand_title,
    CASE WHEN l_returnflag <> 'N' THEN 1990 + p_size + CAST(trunc(l_discount * 30) AS INT) END AS cand_year, CASE WHEN l_suppkey > 5 THEN true WHEN l_suppkey > 2 THEN false END AS author_ok, CASE WHEN l_discount < 0.05 THEN l_orderkey || '-' || l_linenumber || '-' || l_suppkey END AS cand_doi FROM lineitem JOIN part ON p_partkey = l_partkey),
    k AS (SELECT *, {_KEY.format('title')} AS a, {_KEY.format('cand_title')} AS b FROM c),
    s AS (SELECT *, coalesce(greatest(1 - levenshtein(a, b) / greatest(length(a), length(b)), CASE WHEN least(length(a), length(b)) >= 40 AND (contains(a, b) OR contains(b, a)) THEN 0.89 ELSE 0 END), 0)::DOUBLE AS similarity, abs(year - cand_year) AS year_gap FROM k),
    o AS (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY similarity DESC, year_gap NULLS LAST, cand_id) AS n FROM s),
    v AS (SELECT *, CASE WHEN similarity >= 0.9 AND year_gap = 0 AND author_ok THEN 'accepted' WHEN similarity >= 0.9 AND (year_gap IS NULL OR year_gap <= 1) AND author_ok IS NOT FALSE THEN 'review' WHEN similarity >= 0.75 THEN 'review' ELSE 'none' END AS verdict FROM o WHERE n = 1)"""


@query(f"WITH {_SIM} SELECT cand_id, ref_id, round(similarity, 6) AS similarity FROM s")
def title_similarity(spark, sf_dir):
    refs, cands = _pairs(spark, sf_dir)
    return bibliography.title_similarities(refs, cands).select("cand_id", "ref_id", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_SIM} SELECT cand_id, ref_id, author_ok FROM c")
def author_agrees(spark, sf_dir):
    refs, cands = _pairs(spark, sf_dir)
    return refs.join(cands, "ref_id").select("cand_id", "ref_id", bibliography.author_agrees("authors", "surname").alias("author_ok"))


@query(f"WITH {_SIM} SELECT ref_id, cand_id, round(similarity, 6) AS similarity, year_gap, author_ok, verdict FROM v")
def best_candidates(spark, sf_dir):
    out = bibliography.best_candidates(*_pairs(spark, sf_dir))
    return out.select("ref_id", "cand_id", F.round("similarity", 6).alias("similarity"), "year_gap", "author_ok", "verdict")


@query(f"WITH {_SIM}, t AS (SELECT ref_id, arg_min(cand_doi, (-similarity, cand_id)) AS doi FROM s WHERE similarity >= 0.95 AND year = cand_year AND cand_doi IS NOT NULL GROUP BY 1) SELECT ref_id, cand_id, coalesce(cand_doi, doi) AS cand_doi FROM v LEFT JOIN t USING (ref_id)")
def resolved_references(spark, sf_dir):
    return bibliography.enriched(*_pairs(spark, sf_dir)).select("ref_id", "cand_id", "cand_doi")


@query(f"WITH {_REF} SELECT {_KEY.format('title')} || ' ' || year AS key, arg_min(title, ord) AS title, any_value(year) AS year, arg_min(lower(nullif(doi, '')), ord) AS doi, count(DISTINCT entity_id) AS n_entities FROM r WHERE title IS NOT NULL GROUP BY 1")
def distinct_references(spark, sf_dir):
    return bibliography.distinct_references(references(spark, sf_dir).withColumnRenamed("ord", "ref_id"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity / 50 >= 0.6 AND abs(1995 - year(l_shipdate)) <= 1 THEN 'probable_volume' ELSE 'none' END AS verdict FROM lineitem")
def volume_verdict(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", bibliography.volume_verdict(F.col("l_quantity") / 50, F.lit(1995), F.col("l_shipdate").cast("string")).alias("verdict"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, ['accepted', 'review', 'none'][1 + l_linenumber % 3] AS a, CASE WHEN l_quantity > 10 THEN 'd1' END AS da, ['accepted', 'review', 'none'][1 + l_partkey % 3] AS b, CASE WHEN l_discount > 0.05 THEN 'd2' ELSE 'd1' END AS db,
    CASE WHEN l_tax > 0.06 THEN 'accepted' WHEN l_tax > 0.04 THEN 'probable_volume' WHEN l_tax > 0.02 THEN 'review' END AS c, l_returnflag = 'A' AS e FROM lineitem), f AS (SELECT *, coalesce(b = 'accepted' AND a = 'review' AND da <> db, false) AS conflict FROM x)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN a = 'accepted' THEN 'accepted:first' WHEN b = 'accepted' AND NOT conflict THEN 'accepted:second' WHEN c = 'accepted' THEN 'accepted:third' WHEN conflict OR 'review' IN (a, b, coalesce(c, '')) THEN 'review'
    WHEN c = 'probable_volume' THEN c WHEN e THEN 'error' ELSE 'none' END AS verdict FROM f""")
def consolidated_verdict(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "array('accepted', 'review', 'none')[l_linenumber % 3] AS a", "CASE WHEN l_quantity > 10 THEN 'd1' END AS da", "array('accepted', 'review', 'none')[CAST(l_partkey % 3 AS INT)] AS b", "CASE WHEN l_discount > 0.05 THEN 'd2' ELSE 'd1' END AS db",
        "CASE WHEN l_tax > 0.06 THEN 'accepted' WHEN l_tax > 0.04 THEN 'probable_volume' WHEN l_tax > 0.02 THEN 'review' END AS c", "l_returnflag = 'A' AS e")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", bibliography.consolidated("a", "da", "b", "db", "c", "e").alias("verdict"))


@query(f"SELECT doc_id, {_KEY.format("replace(text, 'ß', 'ss')")} AS key FROM documents WHERE text IS NOT NULL")
def title_keys(spark, sf_dir):
    return read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", text.title_key("text").alias("key"))


@query(f"""SELECT DISTINCT p_partkey AS entity_id, p_type AS alias, 'A 1' AS source FROM (SELECT p_partkey, p_name FROM part) t JOIN (SELECT p_name, CASE WHEN p_size > 10 THEN p_type ELSE '' END AS p_type FROM part) s USING (p_name) WHERE p_type <> ''""")
def synchronised_aliases(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    cache = part.selectExpr("p_name AS name", "CASE WHEN p_size > 10 THEN concat(' ', p_type) ELSE ' ' END AS synonym").union(part.selectExpr("p_name", "p_name")).distinct()
    return names.synchronised_aliases(cache, part.selectExpr("p_partkey AS entity_id", "p_name AS entity"), "A 1").select("entity_id", "alias", "source")
