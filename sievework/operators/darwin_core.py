"""Audit of spreadsheets and their shape as Darwin Core: taxa, occurrences, measurements."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import EN_DASH, MINUS, number, squish

from .correction import IDENTITY, autofill_findings, text_columns
from .scan import scanned
from .targets import first_rows

HABITAT = ("HabitatPosition", "Habitat_type", "HabitatHydroperiod", "maximumDephInMeters", "HabitatMarginalVegetation", "HabitatAquaticVegetation", "behavior", "Vegetation_cover")
STABLE_ID = r"^(10\.|https?://|97[89])"
#: Narrower than the remark pattern of the corrections.
AUDIT_REMARK = r"(?i)acho que|nao se aplica|não se aplica"


def finding(rows: DataFrame, sheet: str, column: str, value: Column, problem: str) -> DataFrame:
    return rows.select(F.lit(sheet).alias("sheet"), "row_no", F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(problem).alias("problem"))


def text_findings(d: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """Double spaces, spaces at the ends, typographic dashes, and running numbers in columns that identify."""
    tests = {"double space": lambda c: c.contains("  "), "space at an end": lambda c: c != F.trim(c), "typographic dash": lambda c: c.rlike(f"{MINUS}|{EN_DASH}")}
    out = []
    for c in (x for x in columns if x in d.columns):
        cell = F.col(f"`{c}`")
        out += [finding(d.where(test(cell)), sheet, c, cell, problem) for problem, test in tests.items()]
        if c in IDENTITY:
            out.append(finding(autofill_findings(d, c), sheet, c, F.col("value"), "running numbers"))
    return reduce(DataFrame.unionByName, out)


def control_findings(d: DataFrame, sheet: str) -> DataFrame:
    """Line breaks and tabs in any text cell; all columns in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in text_columns(d)]))
    bad = d.select("row_no", cells.alias("c")).where(F.col("c.value").rlike(r"[\r\n\t]"))
    return bad.select(F.lit(sheet).alias("sheet"), "row_no", "c.column", F.regexp_replace("c.value", r"[\r\n\t]", "<break>").alias("value"), F.lit("line break or tab in a cell").alias("problem"))


def id_name_findings(pairs: DataFrame) -> DataFrame:
    """Of pairs (sheet, row_no, taxonID, name): ids with several names, names with several ids; the first row of each pair."""
    pairs = pairs.withColumns({"taxonID": squish("taxonID"), "name": squish("name")}).where("taxonID IS NOT NULL AND name IS NOT NULL")
    first = first_rows(pairs, ["taxonID", "name"], ["sheet", "row_no"])
    both = first.withColumns({"_n": F.count(F.lit(1)).over(Window.partitionBy("taxonID")), "_i": F.count(F.lit(1)).over(Window.partitionBy("name"))})
    shape = lambda rows, column, a, b, problem: rows.select("sheet", "row_no", F.lit(column).alias("column"), F.concat(a, F.lit(" -> "), b).alias("value"), F.lit(problem).alias("problem"))
    return shape(both.where("_n > 1"), "scientificName", F.col("taxonID"), F.col("name"), "id with several names").unionByName(shape(both.where("_i > 1"), "taxonID", F.col("name"), F.col("taxonID"), "name with several ids"))


def orphan_findings(rows: DataFrame, valid: DataFrame) -> DataFrame:
    """Of rows (sheet, row_no, taxonID): ids that are not among the valid ones, the first row of each by sheet."""
    rows = rows.withColumn("value", squish("taxonID")).where("value IS NOT NULL")
    bad = rows.join(valid.select(squish("taxonID").alias("value")).where("value IS NOT NULL").distinct(), "value", "left_anti")
    return first_rows(bad, ["sheet", "value"], ["row_no"]).select("sheet", "row_no", F.lit("taxonID").alias("column"), "value", F.lit("unknown id").alias("problem"))


def remark_findings(d: DataFrame, sheet: str, columns=("measurementAccuracy", "measurementUnit", "measurementMethod")) -> DataFrame:
    return reduce(DataFrame.unionByName, [finding(d.where(F.col(c).rlike(AUDIT_REMARK)), sheet, c, F.col(c), "remark in a data cell") for c in columns if c in d.columns])


def fragile_id_findings(d: DataFrame, sheet: str, column: str = "eventID") -> DataFrame:
    return finding(d.where(~F.col(column).rlike(STABLE_ID)), sheet, column, F.col(column), "no stable identifier")


def value_without_id_findings(d: DataFrame, sheet: str) -> DataFrame:
    blank = lambda c: F.coalesce(squish(c), F.lit("")) == ""
    return finding(d.where(blank("taxonID") & ~blank("measurementValue")), sheet, "taxonID", F.col("measurementValue"), "value without an id")


def text_in_number_findings(d: DataFrame, sheet: str, column: str) -> DataFrame:
    return finding(d.where((squish(column) != "") & number(column).isNull()), sheet, column, squish(column), "text in a column of numbers")


def summed_findings(findings: DataFrame) -> DataFrame:
    return findings.where("row_no IS NOT NULL").groupBy("sheet", "column", "problem", "value").agg(F.count(F.lit(1)).alias("n_cells"), F.min("row_no").alias("example_row"))


#: What holds for every taxon of the group (fixed values).
GROUP = {"kingdom": "Animalia", "phylum": "Chordata", "class": "Amphibia", "order": "Anura", "taxonRank": "species"}


def _of(d: DataFrame, *names: str) -> Column:
    """The first of these columns that a sheet has, else null."""
    return next((F.col(f"`{n}`") for n in names if n in d.columns), F.lit(None).cast("string"))


def taxa(d: DataFrame) -> DataFrame:
    """The first row of each id, with the constants of the group, whom the name follows, and the first description as a remark."""
    first = first_rows(d, ["taxonID"], ["row_no"])
    own = {"scientificNameAuthorship": _of(d, "scientificNameAuthorship"), "family": F.col("family"), "genus": F.col("genus")}
    more = {"nameAccordingTo": _of(d, "nameAccordingToID"), "nomenclaturalCode": F.lit("ICZN"), "taxonRemarks": _of(d, "FIRST TADPOLE-DESCRIPTION")}
    columns = own | {k: F.lit(v) for k, v in GROUP.items()} | more
    return first.select("taxonID", "scientificName", *[c.alias(k) for k, c in columns.items()])


def published_taxa(targets: DataFrame, according_to: str) -> DataFrame:
    """The taxa of the published measurements, from the target list (entity_id, entity, family)."""
    constants = [F.lit(v).alias(k) for k, v in GROUP.items()]
    return targets.select(F.col("entity_id").alias("taxonID"), F.col("entity").alias("scientificName"), "family", *constants, F.lit(according_to).alias("nameAccordingTo"))


def occurrences(d: DataFrame) -> DataFrame:
    """Vouchers and where they come from. occurrenceID is the id and the row's place in its sheet, by a scan over its parts; the voucher
    stands under the sheet's collectionCode."""
    numbered = scanned(d, ["row_no"], number="place_")
    places = {c: _of(d, c) for c in ("country", "stateProvince", "municipality", "locality")} | {"higherGeography": _of(d, "higherGeography (biome)"), "bibliographicCitation": _of(d, "bibliographicCitation"), "eventID": _of(d, "eventID")}
    occurrence = F.concat(F.coalesce("taxonID", F.lit("NA")), F.lit("|"), F.col("place_").cast("string"))
    return numbered.select(occurrence.alias("occurrenceID"), "taxonID", F.col("collectionCode").alias("catalogNumber"), F.lit("tadpole").alias("lifeStage"), *[c.alias(k) for k, c in places.items()], F.lit(None).cast("string").alias("occurrenceRemarks"))


def verbatim(c: Column | str) -> Column:
    """The part of a remark that keeps an original value; empty for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), "").otherwise(F.concat(F.lit('; verbatim="'), F.replace(c, F.lit('"'), F.lit("'")), F.lit('"')))


def remarks(**values: Column) -> Column:
    """k=v; k=v with NA for nulls."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("NA"))) for k, v in values.items()])


def remark_value(c: Column | str, key: str) -> Column:
    """Read back from a remark; null if it is not there."""
    return F.nullif(F.regexp_extract(c, rf"(?:^|; ){key}=([^;]*)", 1), F.lit(""))


MEASUREMENT = ("row_no", "taxonID", "measurementType", "measurementValue", "measurementUnit", "organismQuantity", "organismQuantityType", "measurementMethod", "measurementRemarks", "bibliographicCitation", "eventID")


def _measured(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows in the columns of MEASUREMENT; those not given are null, row_no, taxonID and eventID the sheet's."""
    own = {c: F.col(c) for c in ("row_no", "taxonID", "eventID")}
    every = {c: F.lit(None).cast("string") for c in MEASUREMENT} | own | columns
    return rows.select(*[every[c].alias(c) for c in MEASUREMENT], *(["place_"] if "place_" in rows.columns else []))


def habitat_measurements(d: DataFrame, columns=HABITAT) -> DataFrame:
    """A measurement for each filled habitat cell; the column is its type, depth is in metres. place_ is the column's place."""
    columns = [c for c in columns if c in d.columns]
    original = lambda c: F.col(f"{c}_original") if f"{c}_original" in d.columns else F.lit(None).cast("string")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("t"), F.col(c).alias("v"), original(c).alias("o"), F.lit(i).alias("i")) for i, c in enumerate(columns)]))
    rows = d.withColumn("_c", cells).where("_c.v IS NOT NULL").withColumn("place_", F.col("_c.i"))
    note = F.concat(remarks(origin=F.lit("Habitat"), biome=_of(d, "biome", "HigherGeography (biome)"), locationID=_of(d, "LocationID")), verbatim(F.col("_c.o")))
    unit = F.when(F.col("_c.t") == "maximumDephInMeters", "m")
    return _measured(rows, measurementType=F.col("_c.t"), measurementValue=F.col("_c.v"), measurementUnit=unit, measurementRemarks=note, bibliographicCitation=_of(d, "Source of information"))


def character_column(d: DataFrame) -> str:
    """The column that holds a character's code: measurementType, or that right after the definition, which has no name of its own."""
    if "MeasurementOrFact" not in d.columns:
        return "measurementType"
    at = d.columns.index("MeasurementOrFact") + 1
    if at == len(d.columns):
        raise ValueError("no column with the characters' codes after MeasurementOrFact")
    return d.columns[at]


def morphology_measurements(d: DataFrame) -> DataFrame:
    """A measurement for each row with a value; definition, stage and the value before correction go to the remark."""
    note = F.concat(remarks(origin=F.lit("Morphology"), definition=_of(d, "definition", "MeasurementOrFact"), stage=_of(d, "stage", "DevelopmentalStages")), verbatim(_of(d, "measurementValue_original")))
    rows = d.where("measurementValue IS NOT NULL")
    kept = {c: _of(d, c) for c in ("organismQuantity", "organismQuantityType", "measurementMethod")}
    return _measured(rows, measurementType=F.col(f"`{character_column(d)}`"), measurementValue=F.col("measurementValue"), measurementRemarks=note, bibliographicCitation=_of(d, "Source of information"), **kept)


def diet_measurements(d: DataFrame) -> DataFrame:
    """Diet sheets hold the item as type, the figure as accuracy, its unit as quantity, how it was counted as value and the number of
    animals as type of quantity; they are turned to their places."""
    kind = F.concat(F.lit("diet_item:"), F.coalesce("measurementType", F.lit("NA")))
    note = remarks(origin=F.lit("Diet"), examined=F.col("organismQuantityType"), stage=_of(d, "DevelopmentalStage"))
    animals = F.col("organismQuantityType")
    rows = d.where("measurementAccuracy IS NOT NULL")
    return _measured(rows, measurementType=kind, measurementValue=F.col("measurementAccuracy"), measurementUnit=F.col("organismQuantity"), organismQuantity=animals, organismQuantityType=F.when(animals.isNotNull(), "individuals"), measurementMethod=_of(d, "measurementValue"), measurementRemarks=note)


def measurements(*parts: DataFrame) -> DataFrame:
    """All parts with an id by part, row and place of the cell, numbered by a scan."""
    place = lambda p: F.col("place_") if "place_" in p.columns else F.lit(0)
    rows = reduce(DataFrame.unionByName, [p.withColumns({"part_no": F.lit(i), "place_": place(p)}) for i, p in enumerate(parts)])
    out = scanned(rows, ["part_no", "row_no", "place_"], number="number_")
    return out.select(F.concat(F.lit("mof"), F.col("number_").cast("string")).alias("measurementID"), *[c for c in MEASUREMENT if c != "row_no"])


def with_notes(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes (taxonID, eventID, note) added to the remarks; the first of several (by note) counts."""
    n = notes.groupBy("taxonID", "eventID").agg(F.min("note").alias("_note"))
    out = rows.join(n, ["taxonID", "eventID"], "left")
    return out.withColumn("measurementRemarks", F.when(F.col("_note").isNull(), F.col("measurementRemarks")).otherwise(F.concat("measurementRemarks", F.lit("; note="), "_note"))).drop("_note")


def plain_number(c: Column) -> Column:
    """A number as text; whole numbers without a point."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def published(extractions: DataFrame, works: DataFrame, attributes: DataFrame) -> DataFrame:
    """Approved extractions as measurements, with where they come from in the remark.

    extractions: work_id, extraction_id, entity_id, attribute_id, value_num, value_cat, unit, stage, temperature, setting, n, dispersion,
    evidence, confidence, extractor, model_version, prompt_version, origin, primary_doi, page, name_in_article, at, status; works: work_id,
    doi; attributes: attribute_id, name. An attribute that is not listed has no name; a word goes before a number.
    """
    rows = extractions.where("status = 'approved'").join(works.select("work_id", "doi"), "work_id").join(attributes.select("attribute_id", F.col("name").alias("_name")), "attribute_id", "left")
    by = F.when(F.col("model_version").isNull(), F.col("extractor")).otherwise(F.concat("extractor", F.lit(" ("), "model_version", F.lit("; prompt "), F.coalesce("prompt_version", F.lit("NA")), F.lit(")")))
    known = lambda c: F.coalesce(c.cast("string"), F.lit("NA"))
    source = F.concat(known(F.col("doi")), F.lit(" p."), known(F.col("page")))
    note = remarks(stage=F.col("stage"), temperature_C=plain_number(F.col("temperature")), setting=F.col("setting"), n=plain_number(F.col("n")), name_in_article=F.col("name_in_article"), confidence=F.round("confidence", 3), source=source, primary_source=F.coalesce("primary_doi", "doi"))
    note = F.concat(note, F.lit('; verbatim="'), F.replace(F.coalesce("evidence", F.lit("NA")), F.lit('"'), F.lit("'")), F.lit('"'))
    return rows.select(
        F.col("extraction_id").alias("measurementID"), F.col("entity_id").alias("taxonID"), F.col("_name").alias("measurementType"), F.col("attribute_id").alias("measurementTypeID"),
        F.coalesce("value_cat", plain_number(F.col("value_num"))).alias("measurementValue"), F.col("unit").alias("measurementUnit"), F.col("dispersion").alias("measurementAccuracy"),
        F.date_format("at", "yyyy-MM-dd").alias("measurementDeterminedDate"), by.alias("measurementDeterminedBy"),
        F.concat(F.lit("assisted extraction from the literature; origin of the value: "), known(F.col("origin"))).alias("measurementMethod"), note.alias("measurementRemarks"),
    )


def gaps(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs without data, with what was done (never searched, or searched without a find), and when, if the pairs say so."""
    when = ["updated_at"] if "updated_at" in pairs.columns else []
    return pairs.where(F.col("state").isin("not_searched", "searched_without_data")).join(targets, "entity_id").select("entity", "attribute_id", "state", *when)


def descriptor(columns: dict[str, list[str]], core: str, id_column: str, term: str = "http://rs.tdwg.org/dwc/terms/") -> str:
    """The archive's meta.xml: a core file and extensions, tab separated, with a field for each column."""

    def part(name: str) -> str:
        tag, mark = ("core", "id") if name == core else ("extension", "coreid")
        fields = "".join(f'<field index="{i}" term="{term}{c}"/>' for i, c in enumerate(columns[name]) if c != id_column or name == core)
        at = columns[name].index(id_column)
        return f'<{tag} encoding="UTF-8" fieldsTerminatedBy="\\t" linesTerminatedBy="\\n" fieldsEnclosedBy="&quot;" ignoreHeaderLines="1"><files><location>{name}.txt</location></files><{mark} index="{at}"/>{fields}</{tag}>'

    order = [core, *(n for n in columns if n != core)]
    return '<?xml version="1.0" encoding="UTF-8"?><archive xmlns="http://rs.tdwg.org/dwc/text/">' + "".join(map(part, order)) + "</archive>"


def audited(sheets: dict[str, DataFrame], valid: str = "Taxonomy") -> DataFrame:
    """All findings of a workbook's sheets, summed: texts, line breaks, ids and names, unknown ids, remarks, fragile ids, values without id."""
    found = []
    for name, d in sheets.items():
        columns = [c for c in ("taxonID", "scientificName", "eventID", "collectionCode", "measurementValue") if c in d.columns]
        if columns:
            found.append(text_findings(d, name, columns))
        found.append(control_findings(d, name))
        if {"taxonID", "measurementValue"} <= set(d.columns):
            found.append(value_without_id_findings(d, name))
        if any(c in d.columns for c in ("measurementAccuracy", "measurementUnit", "measurementMethod")):
            found.append(remark_findings(d, name))
        if "eventID" in d.columns and name == "GeneralInformation":
            found.append(fragile_id_findings(d, name))
    rows = lambda need, make: [make(d, n) for n, d in sheets.items() if set(need) <= set(d.columns)]
    if pairs := rows(("taxonID", "scientificName"), lambda d, n: d.select(F.lit(n).alias("sheet"), "row_no", "taxonID", F.col("scientificName").alias("name"))):
        found.append(id_name_findings(reduce(DataFrame.unionByName, pairs)))
    others = [d.select(F.lit(n).alias("sheet"), "row_no", "taxonID") for n, d in sheets.items() if n != valid and "taxonID" in d.columns]
    if others and valid in sheets:
        found.append(orphan_findings(reduce(DataFrame.unionByName, others), sheets[valid]))
    return summed_findings(reduce(DataFrame.unionByName, found))


def migrated(sheets: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """The archive of a workbook: taxon, occurrence and mof as tab separated files, and meta.xml; gives the rows written of each."""
    from sievework.sources.sinks import write_text, write_tsv

    parts = {
        "taxon": taxa(sheets["Taxonomy"]),
        "occurrence": occurrences(sheets["GeneralInformation"]),
        "mof": measurements(habitat_measurements(sheets["Habitat"]), morphology_measurements(sheets["Morphology_DWC"]), diet_measurements(sheets["Diet_DWC"])),
    }
    for name, df in parts.items():
        write_tsv(df, f"{folder}/{name}", quote_all=name == "mof")
    write_text(f"{folder}/meta.xml", descriptor({n: df.columns for n, df in parts.items()}, "taxon", "taxonID"))
    return {n: df.count() for n, df in parts.items()}
