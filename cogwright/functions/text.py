"""Column functions over strings and identifiers. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Characters that count as white space in texts: those of Unicode, and the four separators of ASCII.
WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def clean_text(c: str | Column) -> Column:
    """White space collapsed and trimmed; empty becomes null."""
    return F.nullif(F.trim(F.regexp_replace(_c(c), WHITE, " ")), F.lit(""))


def is_blank(c: str | Column) -> Column:
    return F.coalesce(F.trim(_c(c)), F.lit("")) == ""


def part_key(c: str | Column) -> Column:
    """A part number without white space and hyphens, in upper case."""
    return F.upper(F.regexp_replace(_c(c), r"[\s-]+", ""))


def alnum_key(c: str | Column) -> Column:
    """Upper case, A-Z and 0-9 only: the key by which makes, models, engines and trims are joined."""
    return F.regexp_replace(F.upper(_c(c)), "[^A-Z0-9]", "")


def header_key(c: str | Column) -> Column:
    """Runs of other characters than letters and figures as one underscore, none at the ends, in upper case."""
    return F.upper(F.regexp_replace(F.regexp_replace(_c(c), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


_ASSEMBLY = r"(?iU)\b(?:ASSY|ASSEMBLY|SUB-ASSY)\b"


def assembly_flag(c: str | Column) -> Column:
    """struct(flag, reason): whether a name says that the part is an assembly; the reason is a fixed word."""
    hit = F.coalesce(_c(c).rlike(_ASSEMBLY), F.lit(False))
    return F.struct(hit.alias("flag"), F.when(hit, F.lit("name_keyword")).alias("reason"))


def is_vin(c: str | Column) -> Column:
    """Seventeen characters without I, O and Q."""
    return F.coalesce(_c(c).rlike("^[A-HJ-NPR-Z0-9]{17}$"), F.lit(False))


def normalize_vin(c: str | Column) -> Column:
    """Trimmed and in upper case; null where that is no VIN."""
    v = F.upper(F.trim(_c(c)))
    return F.when(is_vin(v), v)


def vin_source_key(c: str | Column, prefix: str = "vin:") -> Column:
    return F.concat(F.lit(prefix), F.sha2(_c(c), 256))


def mask_vin(c: str | Column) -> Column:
    """The first three and the last four characters, with ten stars between."""
    return F.concat(F.substring(_c(c), 1, 3), F.lit("*" * 10), F.right(_c(c), F.lit(4)))


def vin_surrogate(c: str | Column) -> Column:
    """A number made of the first fifteen hex digits of the sha256."""
    return F.conv(F.substring(F.sha2(_c(c), 256), 1, 15), 16, 10).cast("long")


def tree_id(c: str | Column, level: int) -> Column:
    """Disjoint ids for two levels of one tree: twice the id, and one more on the second level."""
    return _c(c).cast("long") * 2 + level


def pair_id(a: str | Column, b: str | Column) -> Column:
    """One id for a pair: a * 2^32 + b."""
    return _c(a).cast("long") * (2**32) + _c(b).cast("long")


def non_ascii(c: str | Column) -> Column:
    return F.octet_length(_c(c)) != F.char_length(_c(c))


def matches(c: str | Column, query: str, prefix: bool = False) -> Column:
    """A literal search: as a prefix, or anywhere."""
    return _c(c).startswith(query) if prefix else _c(c).contains(query)


def split_path(c: str | Column) -> Column:
    """struct(main, middle, small) of a category path `a > b > c`."""
    parts = F.split(_c(c), " > ")
    return F.struct(F.get(parts, F.lit(0)).alias("main"), F.get(parts, F.lit(1)).alias("middle"), F.get(parts, F.lit(2)).alias("small"))


def error_codes(c: str | Column) -> Column:
    """The numbers before the first hyphen, separated by commas; what is no number is left out."""
    head = F.substring_index(F.coalesce(_c(c), F.lit("")), "-", 1)
    codes = F.transform(F.split(head, ","), lambda x: F.when(F.trim(x).rlike("^[0-9]+$"), F.trim(x)).try_cast("int"))
    return F.array_distinct(F.filter(codes, lambda x: x.isNotNull()))


def category_name(c: str | Column, names: dict[int, str]) -> Column:
    """A fixed name for a category id, or CATEGORY and the id."""
    fixed = F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), _c(c).try_cast("int"))
    return F.coalesce(fixed, F.concat(F.lit("CATEGORY "), _c(c).cast("string")))


def part_link(c: str | Column, template: str) -> Column:
    """A link made from a part number; the template has one %s."""
    return F.format_string(template, _c(c))


def csv_safe(c: str | Column) -> Column:
    """A cell that a spreadsheet would take for a formula gets an apostrophe in front."""
    return F.when(_c(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), _c(c))).otherwise(_c(c))


#: Windows-1252 characters of the bytes 0x80-0x9F, in order; the five undefined bytes stay as they are (fixed values).
_CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def cp1252_from_latin1(c: str | Column) -> Column:
    """Text that was read as ISO-8859-1 as the Windows-1252 text it is."""
    return F.translate(_c(c), "".join(map(chr, range(0x80, 0xA0))), _CP1252)
