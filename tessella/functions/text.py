"""Column functions on texts, numbers in text, tables in text and JSON in text. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Style names that make a paragraph a heading begin so.
HEADING_STYLES = ("Heading", "heading", "Title", "Título", "Encabezado")
#: Units that may follow a number in a text.
NUMBER_UNITS = ("%", "km²", "km2", "ha", "m²", "m2", "habitantes", "hab\\.?", "personas", "viviendas", "hogares", "predios", "hectáreas", "millones", "USD", "COP", "pesos", "\\$")
_WORD_CHAR = r"[\p{L}\p{N}_]"
NUMBER = rf"(?iu)(?<!{_WORD_CHAR})(\d{{1,3}}(?:[.,]\d{{3}})*(?:[.,]\d+)?)(?:\s*({'|'.join(NUMBER_UNITS)}))?(?!{_WORD_CHAR})"


def token_estimate(text: Column) -> Column:
    """About how many tokens a text has: a quarter of its characters, at least 1; null counts as empty."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4)).cast("int")


def first_tokens(text: Column, n: int) -> Column:
    """The start of a text that is about n tokens long."""
    return F.substring(text, 1, 4 * n)


def last_tokens(text: Column, n: int) -> Column:
    """The end of a text that is about n tokens long."""
    return F.when(F.length(text) <= 4 * n, text).otherwise(F.right(text, F.lit(4 * n)))


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


def slug(heading: Column, limit: int = 80) -> Column:
    """A heading as a file name: lower case, word characters and hyphens, underscores for spaces; `section` for none."""
    bare = F.regexp_replace(F.regexp_replace(F.btrim(F.lower(heading)), r"[^\p{L}\p{N}_\s-]", ""), r"[\s_]+", "_")
    return F.coalesce(F.nullif(F.substring(bare, 1, limit), F.lit("")), F.lit("section"))


def is_heading_style(style: Column) -> Column:
    """Whether a paragraph style is one of headings; false for null."""
    test = F.lit(False)
    for begin in HEADING_STYLES:
        test = test | F.startswith(style, F.lit(begin))
    return F.coalesce(test, F.lit(False))


def heading_level(style: Column) -> Column:
    """The first word of a style that is a number, else 1."""
    return F.coalesce(F.get(F.filter(F.split(style, " "), lambda w: F.regexp_like(w, F.lit("^[0-9]+$"))), 0).try_cast("int"), F.lit(1))


def excerpt(text: Column, limit: int = 500) -> Column:
    """The first `limit` characters."""
    return F.substring(text, 1, limit)


def number(text: Column, mode: str = "plain") -> Column:
    """The value of digits with separators; null if they are no number.

    `plain` reads what is a decimal number already as such, so `8.200` is 8.2, and else takes the last of comma and
    point for the decimal sign, a lone comma with up to two digits after it too, and other commas for thousands.
    `local` is for texts that write points for thousands: groups of three digits are thousands, `8.200` is 8200.
    """
    bare = F.regexp_replace(F.btrim(text), " ", "")
    drop = lambda c, what: F.replace(c, F.lit(what), F.lit(""))
    comma_last = F.instr(F.reverse(bare), ",") < F.instr(F.reverse(bare), ".")
    both = F.contains(bare, F.lit(",")) & F.contains(bare, F.lit("."))
    swapped = F.replace(drop(bare, "."), F.lit(","), F.lit("."))
    written = F.when(both & comma_last, swapped).when(both, drop(bare, ",")).when(F.regexp_like(bare, F.lit(r"^[^,]*,\d{0,2}$")), F.replace(bare, F.lit(","), F.lit("."))).otherwise(drop(bare, ","))
    is_number = F.regexp_like(bare, F.lit(r"^[+-]?\d[\d.,]*$"))
    if mode == "local":
        grouped = F.regexp_like(bare, F.lit(r"^[+-]?\d{1,3}(\.\d{3})+(,\d+)?$"))
        return F.when(is_number, F.when(grouped, swapped).otherwise(written).try_cast("double"))
    return F.when(is_number, F.coalesce(bare.try_cast("double"), written.try_cast("double")))


def numbers(text: Column, mode: str = "plain") -> Column:
    """All numbers in a text with the unit after each: array<struct<value double, unit string>>; unit '' for none.

    Only groups of up to three digits count, so plain numbers of four digits, like years, are no numbers here.
    """
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(1)).alias("digits"), F.regexp_extract_all(text, F.lit(NUMBER), F.lit(2)).alias("unit"))
    valued = F.transform(pairs, lambda p: F.struct(number(p["digits"], mode).alias("value"), F.coalesce(p["unit"], F.lit("")).alias("unit")))
    return F.filter(valued, lambda p: p["value"].isNotNull())


def table_text(rows: Column, headers: Column) -> Column:
    """A table as text: a line of headers, a line of dashes, a line for each row, cells parted by bars.

    `rows` is an array of maps from header to cell; missing cells are empty. Null for no rows.
    """
    line = lambda cells: F.array_join(cells, " | ", "")
    dashes = F.array_join(F.transform(headers, lambda h: F.repeat(F.lit("-"), F.length(h))), " | ")
    body = F.transform(rows, lambda r: line(F.transform(headers, lambda h: F.coalesce(F.try_element_at(r, h), F.lit("")))))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(headers), dashes), body), "\n"))


def table_rows(cells: Column) -> Column:
    """Rows of cells as maps by the first row: array<array<string>> to array<map<string, string>>.

    Longer rows are cut and shorter ones end early; of equal headers the last counts; a header row of blanks becomes col_0, col_1 and so on.
    """
    head = F.get(cells, 0)
    named = F.when(F.forall(head, lambda h: F.btrim(h) == ""), F.transform(head, lambda h, i: F.concat(F.lit("col_"), i.cast("string")))).otherwise(head)
    last = lambda entries: F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))
    pairs = lambda row: F.filter(F.arrays_zip(named.alias("key"), row.alias("value")), lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    return F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), lambda row: last(pairs(row)))


def json_between_braces(text: Column) -> Column:
    """What stands from the first { to the last } of a text, braces included; null if there are none."""
    first, last = F.instr(text, "{"), F.length(text) - F.instr(F.reverse(text), "}") + 1
    return F.when((first > 0) & F.contains(text, F.lit("}")) & (last > first), F.substring(text, first, last - first + 1))


def is_reviewed(text: Column) -> Column:
    """Whether a review file says that it was reviewed or approved, in any letter case."""
    upper = F.upper(text)
    return F.coalesce(F.contains(upper, F.lit("REVIEWED: YES")) | F.contains(upper, F.lit("APPROVED")), F.lit(False))


def exact_mean(value: Column) -> Column:
    """The mean of a column as an aggregate that doesn't depend on the order of rows: nine decimals are summed exactly."""
    return F.avg(value.cast("decimal(18,9)")).cast("double")


def relative_error(value: Column, against: Column) -> Column:
    """Difference in terms of the value that it is held against; null where that is 0 or null."""
    return F.try_divide(F.abs(value - against), F.abs(against))


def markers(text: Column) -> Column:
    """Ids in `[chunk:id]` markers of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"\[chunk:\s*([^\]\s]+)\s*\]"), F.lit(1))
