"""Correction rules of spreadsheet rows. Each rule is a function of a sheet that returns it changed; `logged` gives the changed cells.

A sheet is a DataFrame of text columns with `row_no`, the row's number in its file, which is unique. A rule never adds or drops rows.
Look-up tables are curated lists; where a key stands twice in one, the row with the smallest `ord` counts, if there is one.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import first_two_words, hyphens, id_key, is_blank, squish, swapped_neighbours
from sievework.sources.tables import dealt, settled

from .scan import scanned

EMPTY = "(empty)"
#: Columns that identify a record; a running number there is a slip of filling down.
IDENTITY = ("scientificName", "eventID", "collectionCode", "bibliographicCitation", "Source of information")
#: Words of a person's remark in a data cell.
REMARK = r"(?i)acho que|n[aã]o se aplica|conferir com|ver com"
DIET_SHEET, DIET_METRIC, DIET_SPELLINGS = "Diet_DWC", "percentage_of_items", ("number_itens", "number_of_itens", "percentage_of_itens")
WATER = {"Perm": "permanent", "Temp": "temporary", "temporary pond": "temporary"}
FORMULA = "tooth_row_formulae"
#: Ids up to this length are met by keys of what edits leave, of which there are some two for each pair of characters.
MOST_KEYED = 24


def logged(before: DataFrame, after: DataFrame, sheet: str, rule: str, columns: list[str]) -> DataFrame:
    """sheet, column, row_no, value_before, value_after and rule of each cell that differs. One join on row_no for all columns."""
    a = before.select("row_no", *[F.col(f"`{c}`").alias(f"a{i}") for i, c in enumerate(columns)])
    b = after.select("row_no", *[F.col(f"`{c}`").alias(f"b{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("x"), F.col(f"b{i}").alias("y")) for i, c in enumerate(columns)]
    cell = a.join(b, "row_no").select("row_no", F.explode(F.array(*cells)).alias("c"))
    changed = cell.where(F.coalesce("c.x", F.lit("")) != F.coalesce("c.y", F.lit("")))
    return changed.select(F.lit(sheet).alias("sheet"), "c.column", "row_no", F.coalesce("c.x", F.lit(EMPTY)).alias("value_before"), F.coalesce("c.y", F.lit(EMPTY)).alias("value_after"), F.lit(rule).alias("rule"))


def _present(d: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in d.columns]


def _set(d: DataFrame, column: str, value: Column) -> DataFrame:
    return d.withColumn(column, value)


def looked_up(d: DataFrame, table: DataFrame, key: Column, table_key: Column, value: str) -> DataFrame:
    """d with `_hit` and `_new`, from the first row of a curated list whose key is equal."""
    t = table.select(table_key.alias("_key"), F.col(value).alias("_new"), (F.col("ord") if "ord" in table.columns else F.lit(0)).alias("_o")).where("_key IS NOT NULL")
    t = t.groupBy("_key").agg(F.min_by(F.struct("_new"), F.struct("_o", "_new")).alias("_s")).select("_key", F.col("_s._new").alias("_new"), F.lit(True).alias("_hit"))
    return d.withColumn("_k", key).join(t, F.col("_k") == F.col("_key"), "left").drop("_k", "_key")


def _from_list(d: DataFrame, column: str, table: DataFrame, key: Column, table_key: Column, value: str, where: Column | None = None) -> DataFrame:
    hit = F.col("_hit") if where is None else F.col("_hit") & where
    return _set(looked_up(d, table, key, table_key, value), column, F.when(hit, F.col("_new")).otherwise(F.col(column))).drop("_hit", "_new")


def collapse_autofill(d: DataFrame, columns=IDENTITY) -> DataFrame:
    """Cells that are a prefix and a number take the value of the smallest, where the prefix has 3 or more numbers without a gap.

    A prefix is a group; its windows hold one row a cell. Cells without a number share no group, so that they cost nothing.
    """
    for c in _present(d, columns):
        cell = F.col(f"`{c}`")
        prefix, digits = F.regexp_extract(cell, r"(?s)^(.*?)(\d+)\s*$", 1), F.regexp_extract(cell, r"(?s)^(.*?)(\d+)\s*$", 2).try_cast("int")
        parts = d.where((prefix != "") & digits.isNotNull()).select(prefix.alias("_p"), digits.alias("_n"), cell.alias("_v"), "row_no")
        series = parts.groupBy("_p").agg(F.countDistinct("_n").alias("_k"), F.min("_n").alias("_a"), F.max("_n").alias("_b"), F.min_by("_v", F.struct("_n", "row_no")).alias("_base"))
        series = series.where("_k >= 3 AND _b - _a + 1 = _k").select("_p", "_base")
        joined = d.withColumn("_q", F.when((prefix != "") & digits.isNotNull(), prefix)).join(series, F.col("_q") == F.col("_p"), "left")
        d = joined.withColumn(c, F.coalesce("_base", cell)).drop("_p", "_q", "_base")
    return d


def autofill_findings(d: DataFrame, column: str) -> DataFrame:
    """row_no and value of the members of such series but the smallest."""
    cell = F.col(f"`{column}`")
    prefix, digits = F.regexp_extract(cell, r"(?s)^(.*?)(\d+)\s*$", 1), F.regexp_extract(cell, r"(?s)^(.*?)(\d+)\s*$", 2).try_cast("int")
    parts = d.where((prefix != "") & digits.isNotNull()).select("row_no", cell.alias("value"), prefix.alias("_p"), digits.alias("_n"))
    series = parts.groupBy("_p").agg(F.countDistinct("_n").alias("_k"), F.min("_n").alias("_a"), F.max("_n").alias("_b")).where("_k >= 3 AND _b - _a + 1 = _k")
    return parts.join(series, "_p").where("_n <> _a").select("row_no", "value")


def stable_ids(d: DataFrame, mapping: DataFrame, columns=("eventID",)) -> DataFrame:
    """Identifiers replaced by a list (old, new), whatever the dashes."""
    for c in _present(d, columns):
        d = _from_list(d, c, mapping, id_key(c), id_key("old"), "new")
    return d


def text_columns(d: DataFrame) -> list[str]:
    return [c for c, kind in d.dtypes if kind == "string"]


def plain_dashes(d: DataFrame) -> DataFrame:
    return d.withColumns({c: hyphens(F.col(f"`{c}`")) for c in text_columns(d)})


def single_spaces(d: DataFrame) -> DataFrame:
    return d.withColumns({c: squish(F.col(f"`{c}`")) for c in text_columns(d)})


def ids_without_spaces(d: DataFrame, valid: DataFrame) -> DataFrame:
    """An id with spaces loses them if it is then a valid one (valid: entity ids, column taxonID)."""
    v = valid.select(F.col("taxonID").alias("_v")).distinct()
    bare = F.replace("taxonID", F.lit(" "), F.lit(""))
    out = d.withColumn("_b", F.when(F.contains("taxonID", F.lit(" ")), bare)).join(v, F.col("_b") == F.col("_v"), "left")
    return out.withColumn("taxonID", F.coalesce("_v", "taxonID")).drop("_b", "_v")


def remarks_emptied(d: DataFrame, columns=("measurementAccuracy", "measurementUnit", "measurementMethod")) -> DataFrame:
    return d.withColumns({c: F.when(~F.coalesce(F.col(c).rlike(REMARK), F.lit(False)), F.col(c)) for c in _present(d, columns)})


def repaired_ids(ids: DataFrame, valid: DataFrame) -> DataFrame:
    """taxonID, scientificName and repaired, for distinct ids that are not valid: the only valid id of the name, else the only one that
    differs by two swapped neighbours, else the only one within two edits. valid: taxonID, scientificName.

    Valid ids have numbers, so that of the hits of an id only the least and the largest number are kept: it has one hit if they are equal.
    """
    known = settled(valid.select(F.col("taxonID").alias("good")).where("good IS NOT NULL").distinct().withColumn("g", F.monotonically_increasing_id()), "valid_ids")
    bad = settled(ids.select("taxonID", "scientificName").where("taxonID IS NOT NULL").distinct().join(known, F.col("taxonID") == F.col("good"), "left_anti"), "open_ids")
    by_name = valid.where("taxonID IS NOT NULL").select(first_two_words("scientificName").alias("_w"), "taxonID").distinct().groupBy("_w").agg(F.count(F.lit(1)).alias("_n"), F.min("taxonID").alias("_name")).where("_n = 1 AND _w IS NOT NULL").drop("_n")
    out = bad.withColumn("_w", first_two_words("scientificName")).join(by_name, "_w", "left").drop("_w")
    every = bad.select("taxonID").distinct()
    only = lambda hits, name: hits.groupBy("taxonID").agg(F.min("low").alias("g"), F.max("high").alias("_h")).where("g = _h").join(known, "g").select("taxonID", F.col("good").alias(name))
    swapped = every.withColumn("good", F.explode(swapped_neighbours("taxonID"))).join(known, "good").select("taxonID", F.col("g").alias("low"), F.col("g").alias("high"))
    out = out.join(only(swapped, "_swap"), "taxonID", "left").join(only(_within_two_edits(every, known), "_near"), "taxonID", "left")
    return out.select("taxonID", "scientificName", F.coalesce("_name", "_swap", "_near").alias("repaired"))


def _within_two_edits(every: DataFrame, known: DataFrame) -> DataFrame:
    """taxonID with the least and the largest number (low, high) of the known ids (good, g) within two edits, in one row or several.

    Texts are within two edits if and only if they share a key of `_edit_keys`. The known ids of a key are one row before any meets it, so
    the work grows with the ids and not with their pairs. Known ids over MOST_KEYED characters have too many keys; they are met by thirds.
    """
    short = known.where(F.length("good") <= MOST_KEYED).select("good", "g")
    held = dealt(_edit_keys(dealt(short, "good"), "good", "k", "a"), "key").groupBy("key").agg(F.min("g").alias("low"), F.max("g").alias("high"))
    asked = dealt(_edit_keys(dealt(every.where(F.length("taxonID") <= MOST_KEYED + 2), "taxonID"), "taxonID", "a", "k"), "key")
    near = asked.join(held, "key").groupBy("taxonID").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    shifts = F.array(*[F.lit(i) for i in range(-2, 3)])
    third = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    left = every.where(F.length("taxonID") > MOST_KEYED - 2).withColumn("k", third).withColumn("d", F.explode(shifts)).withColumn("shift", F.explode(shifts))
    left = left.select("taxonID", "k", _part("taxonID", F.length("taxonID") + F.col("d"), F.col("shift")).alias("s")).where("s <> ''").distinct()
    right = known.where(F.length("good") > MOST_KEYED).withColumn("k", third).select("good", "g", "k", _part("good", F.length("good"), F.lit(0)).alias("s"))
    far = left.join(right, ["k", "s"]).where(F.levenshtein("taxonID", "good") <= 2).select("taxonID", F.col("g").alias("low"), F.col("g").alias("high"))
    return near.unionByName(far)


def _edit_keys(d: DataFrame, c: str, own: str, other: str) -> DataFrame:
    """d with a row for each key of its text c; `own` and `other` name this side and the one it is compared with.

    A key is what remains of a text without some characters: up to two that the other text lacks (the other is then whole), one on each
    side, two that differ at the same places, or one of both kinds. Places that differ are told, so equal keys are two edits at most.
    """
    cut = lambda x, at: F.concat(F.substr(x, F.lit(1), F.col(at) - 1), F.substr(x, F.col(at) + 1, F.length(x)))
    key = lambda *x: F.concat_ws(",", *[F.lit(y) if y in (own, other, "lacks", "differs", "each") else F.col(y) for y in x])
    rows = d.withColumn("i_", F.explode(F.sequence(F.lit(0), F.length(c)))).withColumn("s_", F.when(F.col("i_") == 0, F.col(c)).otherwise(cut(c, "i_")))
    rows = rows.withColumn("j_", F.explode(F.when(F.col("i_") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.length("s_"))))).withColumn("t_", F.when(F.col("j_") > 0, cut("s_", "j_")))
    one = F.array(key(own, "lacks", "s_"), key(other, "differs", "i_", "s_"), key("each", "s_"))
    two = F.array(key(own, "differs", "j_", "t_"), key(own, "lacks", "t_"), key("differs", "i_", "j_", "t_"))
    keys = F.when(F.col("i_") == 0, F.array(key(other, "lacks", "s_"))).when(F.col("j_") == 0, one).when(F.col("j_") >= F.col("i_"), two).otherwise(F.slice(two, 1, 1))
    return rows.withColumn("key", F.explode(keys)).drop("i_", "j_", "s_", "t_")


def _part(c: str, n: Column, shift: Column) -> Column:
    """Part k (a column, 0 to 2) of three of a text that is n long, taken from c `shift` places further on; empty outside of it."""
    third = F.floor(n / 3).cast("int")
    start, size = third * F.col("k") + 1 + shift, F.when(F.col("k") < 2, third).otherwise(n - third * 2)
    return F.when((start >= 1) & (size > 0), F.substr(c, start, size)).otherwise("")


def ids_repaired(d: DataFrame, valid: DataFrame) -> DataFrame:
    fixed = repaired_ids(d, valid).where("repaired IS NOT NULL").select(F.col("taxonID").alias("_t"), F.col("scientificName").alias("_s"), "repaired")
    out = d.join(fixed, (F.col("taxonID") == F.col("_t")) & F.col("scientificName").eqNullSafe(F.col("_s")), "left")
    return out.withColumn("taxonID", F.coalesce("repaired", "taxonID")).drop("_t", "_s", "repaired")


def repointed(d: DataFrame, moves: DataFrame, sheet: str) -> DataFrame:
    """Declared blocks of a sheet move to another id: moves(sheet, taxonID_now, scientificName, eventID, taxonID_new)."""
    key = lambda t, s, e: F.concat_ws("\r", F.coalesce(squish(t), F.lit("NA")), F.coalesce(first_two_words(s), F.lit("NA")), F.coalesce(id_key(e), F.lit("NA")))
    mine = moves.where(F.col("sheet") == sheet)
    return _from_list(d, "taxonID", mine, key("taxonID", "scientificName", "eventID"), key("taxonID_now", "scientificName", "eventID"), "taxonID_new")


def continued(d: DataFrame, sheet: str, columns=("eventID", "taxonID", "bibliographicCitation")) -> DataFrame:
    """Blank cells of rows with a voucher take the last filled cell above, on one sheet. The sheet is scanned in parts, in the order of its rows."""
    if sheet != "GeneralInformation" or "collectionCode" not in d.columns:
        return d
    columns = _present(d, columns)
    filled = d.withColumns({f"filled_{c}": F.when(~is_blank(c), F.col(c)) for c in columns})
    above = scanned(filled, ["row_no"], carried={f"above_{c}": f"filled_{c}" for c in columns})
    fill = {c: F.when(is_blank(c) & ~is_blank("collectionCode"), F.coalesce(f"above_{c}", c)).otherwise(F.col(c)) for c in columns}
    return above.withColumns(fill).select(*d.columns)


def authorship_split(d: DataFrame) -> DataFrame:
    """scientificName keeps its first two words, the rest goes to scientificNameAuthorship; a bracket that stands twice is kept once."""
    n = F.regexp_replace(squish("scientificName"), r"(\([^)]+\))\s*\1", "$1")
    two = F.regexp_extract(n, r"^\S+\s+\S+", 0)
    rest = F.trim(F.regexp_replace(n, r"^\S+\s+\S+", ""))
    return d.withColumns({"scientificName": F.when(two != "", two).otherwise(n), "scientificNameAuthorship": F.nullif(rest, F.lit(""))})


def accepted_names(d: DataFrame, decisions: DataFrame) -> DataFrame:
    """Names, and authorships where given, by a list (taxonID, accepted_name, accepted_authorship)."""
    d = _from_list(d, "scientificName", decisions, squish("taxonID"), squish("taxonID"), "accepted_name")
    if "scientificNameAuthorship" in d.columns and "accepted_authorship" in decisions.columns:
        d = _from_list(d, "scientificNameAuthorship", decisions, squish("taxonID"), squish("taxonID"), "accepted_authorship", F.col("_new").isNotNull())
    return d


def diet_metric(d: DataFrame, sheet: str) -> DataFrame:
    if sheet != DIET_SHEET:
        return d
    return _set(d, "measurementValue", F.when(squish("measurementValue").isin(*DIET_SPELLINGS), DIET_METRIC).otherwise(F.col("measurementValue")))


def water_period(d: DataFrame, sheet: str) -> DataFrame:
    """A class of water that stands as a measurement becomes the end of the event id."""
    if sheet != DIET_SHEET:
        return d
    key = squish("MeasurementOrFact")
    period = reduce(lambda a, kv: a.when(key == kv[0], kv[1]), list(WATER.items())[1:], F.when(key == "Perm", WATER["Perm"]))
    d = d.withColumn("_w", period)
    changed = {"eventID": F.when(F.col("_w").isNotNull() & F.col("eventID").isNotNull(), F.concat("eventID", F.lit(":"), "_w")).otherwise(F.col("eventID")), "MeasurementOrFact": F.when(F.col("_w").isNull(), F.col("MeasurementOrFact"))}
    return d.withColumns(changed).drop("_w")


def diet_items_emptied(d: DataFrame, sheet: str) -> DataFrame:
    return _set(d, "dietItens", F.lit(None).cast("string")) if sheet == DIET_SHEET and "dietItens" in d.columns else d


def spelled(d: DataFrame, words: DataFrame, sheet: str) -> DataFrame:
    """Values by a list (trait, wrong, right); on sheet Habitat the trait is the column."""
    pair = lambda a, b: F.concat_ws("\r", F.coalesce(a, F.lit("NA")), F.coalesce(b, F.lit("NA")))
    if sheet == "Habitat":
        traits = sorted(r.trait for r in words.select("trait").distinct().collect())  # a vocabulary
        for c in _present(d, traits):
            d = _from_list(d, c, words.where(F.col("trait") == c), F.col(c), F.col("wrong"), "right")
        return d
    return _from_list(d, "measurementValue", words, pair(F.col("measurementType"), F.col("measurementValue")), pair(F.col("trait"), F.col("wrong")), "right")


def formulae(d: DataFrame, mapping: DataFrame) -> DataFrame:
    """Formulae that a spreadsheet took for dates or numbers, by a list (sheet_value, formula), for one trait only."""
    return _from_list(d, "measurementValue", mapping, squish("measurementValue"), squish("sheet_value"), "formula", F.col("measurementType") == FORMULA)


def single_cells(d: DataFrame, cells: list[tuple[int, str, str | None, str | None]]) -> DataFrame:
    """Declared cells (row_no, column, value_before, value_after); one that does not hold its value before is an error."""
    now = {(r.row_no, c): r[c] for r in d.where(F.col("row_no").isin([c[0] for c in cells])).collect() for c in d.columns}  # as many rows as cells
    for row, column, before, after in cells:
        if (row, column) not in now:
            raise ValueError(f"row {row} has no cell {column}")
        if " ".join((now[row, column] or "").split()) != " ".join((before or "").split()):
            raise ValueError(f"row {row}, column {column}: {before!r} expected, {now[row, column]!r} found")
        now[row, column] = after
        d = _set(d, column, F.when(F.col("row_no") == row, F.lit(after)).otherwise(F.col(column)))
    return d


def vocabulary(d: DataFrame, rules: list[tuple[str, str | None, str, str | None]], sheet: str) -> DataFrame:
    """Rules (trait, taxonID or None, old, new) in sequence, a later one seeing what an earlier one made. Where a value changes, the one
    before stays in a column named with _original (sheets Habitat and Morphology_DWC)."""

    def folded(column: str, mine: list, scope: Callable) -> Column:
        value = F.col(column)
        for trait, entity, old, new in mine:
            hit = value.eqNullSafe(F.lit(old)) & scope(trait)
            if entity and entity.strip():
                hit = hit & (F.coalesce(squish("taxonID"), F.lit("")) == " ".join(entity.split()))
            value = F.when(hit, F.lit(new)).otherwise(value)
        return value

    def with_original(d: DataFrame, column: str, new: Column, name: str | None) -> DataFrame:
        d = d.withColumn("_new", new)
        if name:
            d = d.withColumn(name, F.when(F.col(column).isNotNull() & ~F.col(column).eqNullSafe(F.col("_new")), F.col(column)))
        return d.withColumn(column, F.col("_new")).drop("_new")

    if sheet == "Habitat":
        for c in _present(d, dict.fromkeys(r[0] for r in rules)):
            d = with_original(d, c, folded(c, [r for r in rules if r[0] == c], lambda t: F.lit(True)), f"{c}_original")
        return d
    new = folded("measurementValue", rules, lambda t: F.col("measurementType").eqNullSafe(F.lit(t)))
    return with_original(d, "measurementValue", new, "measurementValue_original" if sheet == "Morphology_DWC" else None)


def corrected(d: DataFrame, sheet: str, rules: list[tuple[str, Callable]]) -> tuple[DataFrame, DataFrame]:
    """(d after all rules in order, the log of all): rules are (name, function of a sheet). Columns that a rule adds are not logged."""
    logs = []
    for name, rule in rules:
        after = rule(d)
        logs.append(logged(d, after, sheet, name, [c for c in text_columns(d) if c in after.columns]))
        d = after
    return d, reduce(DataFrame.unionByName, logs)
