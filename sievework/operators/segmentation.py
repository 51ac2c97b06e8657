"""Chunks from documents: sections, tables, lines and columns of pages, accounts of entities, paragraphs that a parser lost.

Orders are explicit: pages, lines and chunks carry their places. Windows run within one work or page, so a hot work is the largest group.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import content_id, coverage_key, dehyphenated, is_key_line, squish

MAIN_SECTION = (
    r"(?i)^\s*([0-9]+\.?\s*)?(introduc|introdu[cç][aã]o|materia|methods?\b|m[eé]todos?\b|results?\b|resultados?\b|discuss|conclus|acknowledg|agradecimento|"
    r"references\b|literature cited|refer[eê]ncias)"
)
TABLE_CAPTION = r"^\s*(Table|TABLE|Tabela|TABELA|Tabla|TABLA)\s+[0-9IVXL]+\b"
REFERENCES = (
    "^(REFERENCES|References|LITERATURE CITED|Literature [Cc]ited|Referências|REFERÊNCIAS|Referencias|REFERENCIAS|Literatura [Cc]itada|LITERATURA CITADA|"
    r"Bibliografía|BIBLIOGRAFÍA|Bibliografia|BIBLIOGRAFIA)( [Bb]ibliográficas| BIBLIOGRÁFICAS| [Cc]itadas?| CITADAS?)?\s*$"
)
SECTION_TITLE = "^[A-Z][A-Z ,&-]{7,}$|^(Discussion|Taxonomic key|Key to|Acknowledg)"
ACCOUNT_HEADER = (
    r"^[A-Z][a-z]+ (cf\. |aff\. )?([a-z-]{3,}|sp\.)(\s*$|\s*\(\s*(Figs?\b|Figur[ae]s?\b|Lám|Plate|[A-Z][\p{L}'.-]*[ ,&)])"
    r"|\s+[A-Z][\p{L}'-]+[ ,&]|\s+[A-Z][\p{L}'-]+ ?[0-9]{4}|\s+(x|×)\s)"
)
FIGURE = r"^(Figure|Fig|Table|Tabela)\b"
LEAST_CHUNK, LEAST_ACCOUNT, MOST_ACCOUNT, LEAST_LOST = 40, 400, 10_000, 150


def sections_with_main(headings: DataFrame) -> DataFrame:
    """headings (work_id, ord, title, n_paragraphs) with section: `main / title` under the last main heading.

    A heading without paragraphs, or that reads like one, is a main heading; a null title stays null.
    """
    main = F.col("title").isNotNull() & ((F.col("n_paragraphs") == 0) | F.col("title").rlike(MAIN_SECTION))
    last = F.last(F.when(main, F.col("title")), ignorenulls=True).over(Window.partitionBy("work_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    return headings.withColumn("section", F.when(main | last.isNull(), F.col("title")).otherwise(F.concat(last, F.lit(" / "), "title")))


def paragraph_chunks(works: DataFrame, kind: str = "text") -> DataFrame:
    """A chunk for each line of a work's text that is longer than LEAST_CHUNK, numbered in order; equal ids are one chunk."""
    lines = works.select("work_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    return lines.where(F.length("text") > LEAST_CHUNK).withColumns({"kind": F.lit(kind), "chunk_id": content_id("work_id", "text")})


def page_chunks(pages: DataFrame) -> DataFrame:
    """The fallback: a page is a chunk, its number the order."""
    return pages.select("work_id", F.col("page").alias("ord"), "text", F.lit("text").alias("kind"), content_id("work_id", "page", "text").alias("chunk_id")).where(F.length("text") > LEAST_CHUNK)


def tables_of_pages(pages: DataFrame) -> DataFrame:
    """Of pages (work_id, page, text): a table for each caption at the start of a line, to the next caption or the page's end.

    A page is split, cut and joined within its own row, without a shuffle.
    """
    lines = F.split("text", "\n")
    starts = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(TABLE_CAPTION), i)), lambda i: i.isNotNull())
    ends = F.transform(starts, lambda s, k: F.coalesce(F.get(starts, k + 1), F.size(lines)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda z: F.array_join(F.slice(lines, z["a"] + 1, z["b"] - z["a"]), "\n"))
    tables = pages.select("work_id", "page", F.posexplode(parts).alias("place", "text"))
    return tables.where(F.length("text") > LEAST_CHUNK).withColumn("section", F.substring(squish(F.get(F.split("text", "\n"), F.lit(0))), 1, 120))


def appended(chunks: DataFrame, more: DataFrame, order: list[str]) -> DataFrame:
    """chunks with more (work_id, kind, section, text), whose order goes on after each work's last; known ids are not added again."""
    last = chunks.groupBy("work_id").agg(F.max("ord").alias("_last"))
    place = F.row_number().over(Window.partitionBy("work_id").orderBy(*order))
    new = more.withColumn("chunk_id", content_id("work_id", "kind", "text")).join(last, "work_id", "left").withColumn("ord", (F.coalesce("_last", F.lit(0)) + place).cast(chunks.schema["ord"].dataType))
    new = new.dropDuplicates(["chunk_id"]).join(chunks.select("chunk_id"), "chunk_id", "left_anti")
    return chunks.unionByName(new.select(*[c for c in chunks.columns if c in new.columns]), allowMissingColumns=True)


def column_cut(words: DataFrame) -> DataFrame:
    """work_id, page, cut: where the second column of a page begins, null for a page of one column.

    The commonest x (smallest of several) in the middle of the page, less 3; needs 5 words there, and no more than 2 % may cross it.
    """
    width = F.max(F.col("x") + F.col("width")).over(Window.partitionBy("work_id", "page"))
    w = words.withColumn("_w", width)
    middle = w.where((F.col("x") > 0.35 * F.col("_w")) & (F.col("x") < 0.65 * F.col("_w")))
    counts = middle.groupBy("work_id", "page", "x").agg(F.count(F.lit(1)).alias("n"))
    cuts = counts.groupBy("work_id", "page").agg(F.sum("n").alias("n"), (F.max_by("x", F.struct("n", -F.col("x"))) - 3).alias("cut")).where("n >= 5")
    crossing = words.join(cuts, ["work_id", "page"]).groupBy("work_id", "page").agg(F.first("cut").alias("cut"), F.avg(((F.col("x") < F.col("cut")) & (F.col("x") + F.col("width") > F.col("cut"))).cast("int")).alias("share"))
    every = words.select("work_id", "page").distinct()
    return every.join(crossing.where("share <= 0.02").select("work_id", "page", "cut"), ["work_id", "page"], "left")


def body_font(words: DataFrame) -> DataFrame:
    """work_id, body: the commonest font size, in half points (smallest of several)."""
    counts = words.groupBy("work_id", (F.bround(F.col("font_size") * 2) / 2).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("work_id").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("body"))


def lines_of_words(words: DataFrame) -> DataFrame:
    """Lines of words (work_id, page, x, y, width, text, font_name, font_size): by page, column and y, a step of more than 2 being a new line."""
    w = words.join(column_cut(words), ["work_id", "page"]).withColumn("col", F.when(F.col("cut").isNull() | (F.col("x") < F.col("cut")), 1).otherwise(2))
    order = Window.partitionBy("work_id", "page", "col").orderBy("y", "x", "text")
    w = w.withColumn("_new", F.coalesce(F.col("y") - F.lag("y").over(order) > 2, F.lit(True)).cast("int"))
    w = w.withColumn("line", F.sum("_new").over(order))
    w = w.withColumn("_word", F.struct("x", "y", F.col("text").alias("t"), F.col("font_name").rlike("Italic|Oblique").alias("i")))
    lines = w.groupBy("work_id", "page", "col", "line").agg(F.array_sort(F.collect_list("_word")).alias("_l"), F.median("font_size").alias("font"))
    lines = lines.select("work_id", "page", "col", "line", "font", F.col("_l")[0]["x"].alias("x0"), F.array_join(F.transform("_l", lambda z: z["t"]), " ").alias("text"), (F.size("_l") >= 2).alias("_two"), F.coalesce(F.get("_l", F.lit(0))["i"] & F.get("_l", F.lit(1))["i"], F.lit(False)).alias("_i"))
    lines = lines.withColumn("italic2", F.col("_two") & F.col("_i")).drop("_two", "_i").join(body_font(words), "work_id")
    return lines.withColumn("small", F.col("font") < F.col("body") - 0.75).drop("body")


def is_account_header(text: Column | str, italic2: Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return italic2 & t.rlike(ACCOUNT_HEADER) & ~t.rlike(FIGURE)


def _reading() -> "Window":
    return Window.partitionBy("work_id").orderBy("page", "col", "line")


def accounts(lines: DataFrame) -> DataFrame:
    """Accounts of entities: from a header to the next, to a section title or to the references. Small print is left out first."""
    w = _reading()
    rows = lines.where(~F.col("small")).withColumns({
        "header": is_account_header("text", F.col("italic2")),
        "ended": F.max(F.col("text").rlike(REFERENCES).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    })
    rows = rows.where("ended = 0")
    event = F.when(F.col("header"), "open").when(F.col("text").rlike(SECTION_TITLE), "shut")
    rows = rows.withColumns({"account": F.sum(F.col("header").cast("int")).over(w), "_event": F.last(event, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))}).where("_event = 'open'")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "col", "line", "text"))), lambda x: x["text"]), " ")
    out = rows.groupBy("work_id", "account").agg(F.min_by("text", F.struct("page", "col", "line")).alias("header"), F.min("page").alias("page"), joined.alias("text"))
    return out.withColumn("text", dehyphenated("text"))


def is_useful_account(text: Column | str) -> Column:
    return (F.length(text) >= LEAST_ACCOUNT) & (F.length(text) <= MOST_ACCOUNT) & ~is_key_line(text)


def lost_paragraphs(lines: DataFrame, chunks: DataFrame, least: int = LEAST_LOST) -> DataFrame:
    """Paragraphs of lines that no chunk of their work holds, of `least` characters or more.

    A line is covered if its key stands in the work's; a line of fewer than 15 key characters is as the one before it, the first covered.
    A paragraph begins at an indent, or where covered and lost lines meet. Headings of references end the work.
    """
    w = _reading()
    whole = chunks.groupBy("work_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ").alias("_w")).select("work_id", coverage_key("_w").alias("_w"))
    rows = lines.withColumn("_end", F.max(F.col("text").rlike(REFERENCES).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_end = 0 AND NOT small")
    rows = rows.join(whole, "work_id", "left").withColumn("_key", coverage_key("text"))
    rows = rows.withColumn("_c", F.when(F.length("_key") >= 15, F.contains(F.coalesce("_w", F.lit("")), F.col("_key")))).drop("_w", "_key")
    rows = rows.withColumn("covered", F.coalesce(F.last("_c", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(True)))
    counts = rows.groupBy("work_id", "page", "col", "x0").agg(F.count(F.lit(1)).alias("n"))
    margins = counts.groupBy("work_id", "page", "col").agg(F.max_by("x0", F.struct("n", -F.col("x0"))).alias("margin"))
    rows = rows.join(margins, ["work_id", "page", "col"])
    new = (F.col("x0") > F.col("margin") + 4) | (F.col("covered") != F.coalesce(F.lag("covered").over(w), F.lit(True))) | (F.row_number().over(w) == 1)
    rows = rows.withColumn("_new", new.cast("int")).withColumn("par", F.sum("_new").over(w)).where("NOT covered")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "col", "line", "text"))), lambda x: x["text"]), " ")
    out = rows.groupBy("work_id", "par").agg(F.min("page").alias("page"), dehyphenated(joined).alias("text"))
    return out.where((F.length("text") >= least) & ~is_key_line("text"))


def predominant_language(chunks: DataFrame) -> DataFrame:
    """work_id and its commonest language (first by name of several); NA where none is known."""
    counts = chunks.where("language IS NOT NULL").groupBy("work_id", "language").agg(F.count(F.lit(1)).alias("n"))
    best = counts.withColumn("_k", F.row_number().over(Window.partitionBy("work_id").orderBy(F.desc("n"), "language"))).where("_k = 1").select("work_id", "language")
    return chunks.select("work_id").distinct().join(best, "work_id", "left").withColumn("language", F.coalesce("language", F.lit("NA")))


STOP_WORDS = {"en": ("the", "of", "and", "with", "that"), "pt": ("que", "não", "uma", "com", "dos"), "es": ("que", "los", "las", "una", "del"), "de": ("der", "die", "und", "das", "ein"), "fr": ("les", "des", "une", "est", "dans")}


def _one_of(words: tuple[str, ...]):
    return lambda x: x.isin(*words)


def language(text: Column | str, first: int = 5000) -> Column:
    """The language whose stop words are the commonest among the first characters (first by name of several); null if none occurs."""
    t = F.col(text) if isinstance(text, str) else text
    tokens = F.split(F.lower(F.substring(t, 1, first)), r"[^\p{L}]+")
    counts = [F.struct((-F.size(F.filter(tokens, _one_of(ws)))).alias("n"), F.lit(k).alias("k")) for k, ws in STOP_WORDS.items()]
    best = F.array_min(F.array(*counts))
    return F.when(best["n"] < 0, best["k"])


def pending(works: DataFrame, done: DataFrame) -> DataFrame:
    return works.join(done.select("work_id"), "work_id", "left_anti")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """By name; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def account_chunks(lines: DataFrame) -> DataFrame:
    """Accounts as chunks: the header, squished and 120 characters at most, as section; equal texts of a work are one chunk."""
    rows = accounts(lines).select("work_id", F.lit("account").alias("kind"), F.when(F.length(squish("header")) > 120, F.concat(F.substring(squish("header"), 1, 117), F.lit("..."))).otherwise(squish("header")).alias("section"), "page", "account", "text")
    first = rows.withColumn("_k", F.row_number().over(Window.partitionBy("work_id", "text").orderBy("account"))).where("_k = 1").drop("_k")
    return first.withColumn("chunk_id", content_id("work_id", F.concat(F.lit("account:"), "text")))


def with_accounts(chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """chunks with the accounts of the works that have none yet."""
    open_ = lines.join(chunks.where("kind = 'account'").select("work_id").distinct(), "work_id", "left_anti")
    return appended(chunks, account_chunks(open_).drop("chunk_id"), ["account"])


def with_lost_text(chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """chunks with the paragraphs of lines that no chunk of their work holds."""
    return appended(chunks, lost_paragraphs(lines, chunks).withColumns({"kind": F.lit("text"), "section": F.lit(None).cast("string")}), ["page", "par"])


def rebuilt(chunks: DataFrame, new: DataFrame) -> DataFrame:
    """chunks with all those of the works in `new` replaced; ids follow from work and text, so unchanged chunks keep theirs."""
    return chunks.join(new.select("work_id").distinct(), "work_id", "left_anti").select(*chunks.columns).unionByName(new.select(*chunks.columns))
