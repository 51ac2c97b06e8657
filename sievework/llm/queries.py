"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, automaton, divergence, fastsketch, hostrules, htmlmain, intervals, jaccard, ordinal, packing, toxicity, urlcascade, wavelet
from .common import table

#: The url rules of op6.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrules.judge(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlcascade.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.digest_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fastsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.join(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"), table(spark, sf_dir, "clicks"))


def queries() -> dict:
    return {n: f for n, f in globals().items() if n.startswith("op")}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Links on full shingle sets, and components by the smallest id that is carried along links.
MINHASH_SQL = rf"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \t-\r]+'), lambda x: x <> '') AS words FROM documents),
    sh AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END)) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS MATERIALIZED (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
    r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id WHERE r.root < e.y),
    c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
    SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""

#: Every kept term in every group, whether it occurs there or not.
DIVERGENCE_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS k, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    t AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT k) >= 10),
    v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
    c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
    g AS (SELECT DISTINCT lang, source FROM d),
    full_c AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
    p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM full_c JOIN v USING (lang)),
    l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2),
    q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM l JOIN v USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM every UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 10"""

#: Every pair of a sale and a session of its client, with crc32 by a table of its 256 steps.
INTERVAL_SQL = """
    WITH k AS (SELECT client_id, ts, coalesce(kind = 'purchase', false) AS bought FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
    m AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY client_id ORDER BY ts) > INTERVAL 10 MINUTE, true) AS began FROM k),
    o AS (SELECT *, sum(began::INT) OVER (PARTITION BY client_id ORDER BY ts) AS session FROM m),
    se AS (SELECT client_id, min(ts) AS first, max(ts) AS last, max(CASE WHEN bought THEN ts END) AS last_bought FROM o GROUP BY client_id, session),
    steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c // 2, (c % 2) * 3988292384))) AS t),
    c AS (SELECT client_id, epoch_us(first) // 3600000000 AS a, CASE WHEN last_bought = last THEN 2147483647 ELSE epoch_us(last) // 3600000000 END AS b,
                 xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(epoch_us(first)::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda r, x: xor(r // 256, t[xor(r, x) % 256 + 1]))) AS crc FROM se, steps),
    li AS (SELECT sale_id, max(shipped_at) AS sent, bool_or(shipped_at IS NULL) AS waits FROM sale_lines GROUP BY 1),
    s AS (SELECT sales.sale_id, client_id, epoch_us(sold_at) // 3600000000 AS a, CASE WHEN waits THEN 2147483647 ELSE epoch_us(greatest(sold_at, sent)) // 3600000000 END AS b
          FROM sales LEFT JOIN li ON li.sale_id = sales.sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
    p AS (SELECT sale_id, CASE WHEN s.a < c.a THEN CASE WHEN s.b < c.b THEN 'overlaps' WHEN s.b = c.b THEN 'finished_by' ELSE 'contains' END
                               WHEN s.a = c.a THEN CASE WHEN s.b < c.b THEN 'starts' WHEN s.b = c.b THEN 'equals' ELSE 'started_by' END
                               ELSE CASE WHEN s.b < c.b THEN 'during' WHEN s.b = c.b THEN 'finishes' ELSE 'overlapped_by' END END AS relation,
                 CASE WHEN s.b < 2147483647 OR c.b < 2147483647 THEN least(s.b, c.b) - greatest(s.a, c.a) + 1 END AS slots, crc
          FROM s JOIN c ON s.client_id = c.client_id AND s.a <= c.b AND c.a <= s.b)
    SELECT sale_id, relation, count(*) AS n_pairs, sum(slots)::BIGINT AS overlap_slots, sum(crc)::BIGINT AS sessions_crc FROM p GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    host, path = "regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)", "regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    rules = ", ".join(f"('{a}', '{k[: k.index('/')]}', '{k[k.index('/') :]}')" for a, k in URL_RULES)
    return {
        "op11_minhash": MINHASH_SQL,
        "op12_source_divergence": DIVERGENCE_SQL,
        "op13_interval_join": INTERVAL_SQL,
        "op6_url_filters": f"""
            WITH rules(action, rule_host, rule_path) AS (VALUES {rules}),
            p AS (SELECT page_id, coalesce(translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                         coalesce({path}, '') AS path FROM pages),
            hit AS (SELECT page_id, rule_host || rule_path AS rule, action,
                           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) + length(rule_path) DESC) AS n
                    FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
            SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
            FROM p LEFT JOIN hit ON p.page_id = hit.page_id AND n = 1"""
    }
