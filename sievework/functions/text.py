"""Text functions as column expressions. A null stays null unless a function says otherwise."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUS, EN_DASH, EM_DASH = "−", "–", "—"
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squish(c: Column | str) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"[\s\p{Z}\x{85}]+", " "))


def normalized(c: Column | str) -> Column:
    return squish(F.lower(_col(c)))


def is_blank(c: Column | str) -> Column:
    """True for null and for white space alone."""
    return F.coalesce(squish(c) == "", F.lit(True))


def words(c: Column | str) -> Column:
    """Lower-case runs of letters and digits; of an empty text one empty word."""
    return F.split(squish(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]+", " ")), " ")


def dehyphenated(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(\p{Ll})- (\p{Ll})", "$1$2")


def hyphens(c: Column | str) -> Column:
    """The minus sign, and an en dash between digits, as a hyphen."""
    return F.regexp_replace(F.replace(_col(c), F.lit(MINUS), F.lit("-")), f"(?<=[0-9]){EN_DASH}(?=[0-9])", "-")


def id_key(c: Column | str) -> Column:
    return hyphens(squish(c))


def unaccented(c: Column | str) -> Column:
    return F.replace(F.replace(F.translate(_col(c), ACCENTED, PLAIN), F.lit("ß"), F.lit("ss")), F.lit("œ"), F.lit("oe"))


def title_key(c: Column | str) -> Column:
    """Entities and tags undone, accents folded, only a-z, 0-9 and single spaces. Texts without any (ASCII: as long in bytes as in characters)
    are spared these steps."""
    c = _col(c)
    bare = F.regexp_replace(c, r"&amp;(amp;)*", "&")
    bare = F.regexp_replace(F.replace(F.replace(bare, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), r"<[^>]+>", " ")
    bare = F.when(F.contains(c, F.lit("<")) | F.contains(c, F.lit("&")), bare).otherwise(c)
    plain = F.when(F.octet_length(c) == F.length(c), bare).otherwise(unaccented(bare))
    return F.trim(F.regexp_replace(F.lower(plain), r"[^a-z0-9]+", " "))


def without_ligatures(c: Column | str) -> Column:
    return F.replace(F.replace(_col(c), F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))


def coverage_key(c: Column | str) -> Column:
    """What tells whether one text holds another: a-z and 0-9 alone."""
    return F.regexp_replace(F.lower(without_ligatures(c)), r"[^a-z0-9]", "")


def page_key(c: Column | str) -> Column:
    """Lower case, one kind of dash, no ligatures, then neither white space nor hyphens."""
    c = F.regexp_replace(F.lower(_col(c)), f"[{EN_DASH}{EM_DASH}{MINUS}]", "-")
    return F.regexp_replace(without_ligatures(c), r"[\s\p{Z}-]+", "")


def first_two_words(c: Column | str) -> Column:
    """Null where there are not two."""
    return F.nullif(F.regexp_extract(squish(c), r"^(\S+\s+\S+)", 1), F.lit(""))


def truncated(c: Column | str, most: int) -> Column:
    c = _col(c)
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def content_id(*parts: Column | str) -> Column:
    """16 hexadecimal digits of a hash over the parts; nulls count as empty."""
    return F.substring(F.sha2(F.concat_ws("\u0001", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]), 256), 1, 16)


def number(c: Column | str) -> Column:
    """Null for what is no number; a decimal comma counts as a point."""
    return F.replace(squish(c), F.lit(","), F.lit(".")).try_cast("double")


def if_known(condition: Column, yes, no) -> Column:
    """Null where the condition is null."""
    return F.when(condition.isNull(), F.lit(None)).when(condition, yes).otherwise(no)


def swapped_neighbours(c: Column | str) -> Column:
    """All strings that arise by swapping two neighbouring characters."""
    c = _col(c)
    at = F.when(F.length(c) >= 2, F.sequence(F.lit(1), F.length(c) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1, F.lit(1)), F.substr(c, i, F.lit(1)), F.substr(c, i + 2, F.length(c))))


def name_pattern(names: list[str]) -> str:
    """A regular expression for names, and for genus initial with epithet where the second word is a true epithet; open at its end."""
    out = [re.escape(n) for n in names]
    for n in names:
        w = n.split(" ")
        if len(w) >= 2 and re.fullmatch("[a-z-]{3,}", w[1]) and w[1] not in {"cf", "aff", "sp", "spp"}:
            out.append(rf"{re.escape(w[0][:1])}\.?\s+{w[1]}")
    return rf"\b({'|'.join(out)})"


def begins_with_name(c: Column | str, names: list[str]) -> Column:
    if not names:
        return F.lit(False)
    return squish(c).rlike("(?i)^" + name_pattern(names) + r"(?!\p{L})")


def is_key_line(c: Column | str) -> Column:
    """A line of an identification key: ten dots, or three ellipses, in a row."""
    return _col(c).rlike(r"(\.\s?){10,}|(\x{2026}\s?){3,}")
