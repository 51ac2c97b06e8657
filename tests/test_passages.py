import random

from sievework.operators import mentions as m
from sievework.operators import passages, retrieval

ENTITIES = {"E1": ["Hyla alba", "Scinax ruber"], "E2": ["Bufo marinus"], "E3": ["Scinax ruber", "Rana parva"], "E4": ["Physalaemus"]}
TERMS = {"A1": ["snout", "eyes"], "A2": ["diet"]}
WORDS = ["the", "larva", "snout", "eyes", "diet", "rounded", "of", "is", "H. alba", "Hyla alba", "S.  ruber", "Bufo marinus", "bufo marinusx", "Rana parva", "R parva", "Physalaemus", "Hyla", "..........", *["leaf", "pond", "snout", "eyes", "diet"] * 12]


def works(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = []
    for w in range(12):
        for i in range(rng.randrange(1, 40)):
            kind = rng.choices(["text", "table", "account"], [8, 2, 1 if w % 3 == 0 else 0])[0]
            section = rng.choice([None, *["Results", "Notes"] * 6, "Hyla alba", "On Bufo marinus", "Rana parva", "Scinax ruber"])
            text = rng.choice([None, "", say(3), say(6), say(9)])
            if kind == "account":
                section, text = rng.choice(ENTITIES[rng.choice(list(ENTITIES))]), say(12) + " External morphology. " + say(60)
            rows.append((f"w{w}", f"w{w}-{i:02}", i, kind, section, text))
    return rows


def test_all_pairs_equal_the_operator_for_one_entity(spark):
    for seed in (1,):
        rows = works(seed)
        chunks = spark.createDataFrame(rows, "work_id string, chunk_id string, ord int, kind string, section string, text string")
        ids = sorted({r[0] for r in rows})
        names = spark.createDataFrame([(w, e, n) for w in ids for e, ns in ENTITIES.items() for n in ns], "work_id string, entity_id string, name string")
        pairs = spark.createDataFrame([(w, e, a) for w in ids for e in ENTITIES for a in TERMS], "work_id string, entity_id string, attribute_id string")
        terms = spark.createDataFrame([(a, t) for a, ts in TERMS.items() for t in ts], "attribute_id string, term string")
        got = {tuple(r) for r in passages.candidates_of_pairs(chunks, names, pairs, terms).collect()}
        want = set()
        for e in ENTITIES:
            for a in TERMS:
                others = [ENTITIES[x] for x in ENTITIES if x != e]
                want |= {(r.work_id, e, a, r.chunk_id, r.kind, r.anchor, r.score, r["rank"]) for r in retrieval.candidates(chunks, ENTITIES[e], others, TERMS[a]).collect()}
        assert {x[:6] for x in got} == {x[:6] for x in want}
        assert {(*x[:4], round(x[6], 5)) for x in got} == {(*x[:4], round(x[6], 5)) for x in want}
        assert len(got) > 50 and any(x[5] for x in got)


def test_empty_tables(spark):
    chunks = spark.createDataFrame(works(1), "work_id string, chunk_id string, ord int, kind string, section string, text string")
    names = spark.createDataFrame([("w0", "E1", "Hyla alba")], "work_id string, entity_id string, name string")
    pairs = spark.createDataFrame([("w0", "E1", "A1")], "work_id string, entity_id string, attribute_id string")
    terms = spark.createDataFrame([("A1", "snout")], "attribute_id string, term string")
    none = lambda df: df.where("false")
    for given in ((none(chunks), names, pairs, terms), (chunks, none(names), pairs, terms), (chunks, names, none(pairs), terms), (chunks, names, pairs, none(terms))):
        assert [r for r in passages.candidates_of_pairs(*given).collect() if r.kind != "table"] == []


def test_unordered_works_do_not_inherit(spark):
    rows = [("w", f"c{i}", None, "text", s, t) for i, (s, t) in enumerate([(None, "Hyla alba snout"), (None, "the snout"), ("Hyla alba", "eyes"), (None, "Bufo marinus eyes")])]
    chunks = spark.createDataFrame(rows, "work_id string, chunk_id string, ord int, kind string, section string, text string")
    names = spark.createDataFrame([("w", "E1", "Hyla alba")], "work_id string, entity_id string, name string")
    pairs = spark.createDataFrame([("w", "E1", "A1")], "work_id string, entity_id string, attribute_id string")
    terms = spark.createDataFrame([("A1", "snout"), ("A1", "eyes")], "attribute_id string, term string")
    assert {r.chunk_id for r in passages.candidates_of_pairs(chunks, names, pairs, terms).collect()} == {"c0", "c2"}


def test_names_by_parts_equal_one_automaton(spark):
    rng = random.Random(4)
    names = spark.createDataFrame([(n,) for n in ["Hyla alba", "Hyla", "alba", "Rana sp.", "E. cf nigra", "ÉLAN vif", "", None] + [f"Genus{i} species{i % 7}a" for i in range(200)]], "name string")
    say = lambda: " ".join(rng.choice(["hyla", "ALBA", "H. alba", "G. species3a", "genus11 species4a,", "Genus1", "élan  VIF", "élan vif", "x", "rana sp.", "h.alba"]) for _ in range(8))
    texts = spark.createDataFrame([(i, say()) for i in range(80)] + [(90, None), (91, ""), (3, "Hyla alba")], "id long, text string")
    whole = sorted(map(tuple, m.mentions(texts, names, ["id"]).collect()), key=str)
    parts = sorted(map(tuple, m.mentions(texts, names, ["id"], most=20).collect()), key=str)
    assert whole == parts and len(whole) > 200


def test_mentions_equal_the_pattern():
    import re

    from sievework.functions.text import name_pattern

    rng = random.Random(7)
    names = ["Hyla alba", "Scinax x-signatus", "Rana sp", "Rana sp.", "Bufo", "Hyla aff. alba", "(odd) name"]
    pieces = ["Hyla", "alba", "H.", "H", " ", "  ", "\n", ".", "S.", "x-signatus", "sp", "R. sp", "Rana", "bufo", "Xbufo", "_", "(odd)", "name", "é", "Hyla alba", "S x-signatus,"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(8))
        for name in names:
            hit = re.search(name_pattern([name]), text, re.I)
            got = m.Names([name]).search(text).get(0)
            assert (hit is not None) == (got is not None and got[0] is not None), (text, name)
            if hit:
                assert got[0] == hit.start() + 1
            squeezed = " ".join(text.split())
            assert bool(re.match("^" + name_pattern([name]) + r"(?![^\W\d_])", squeezed, re.I)) == bool(got and got[2]), (text, name)
            whole = re.search(rf"\b{re.escape(name)}\b", text, re.I)
            if name.isascii() and name[0].isalpha() and name[-1].isalpha():
                assert (whole.start() + 1 if whole else None) == (min((x for x in [got[1]] if x), default=None) if got else None) or "." in text or " " in text
