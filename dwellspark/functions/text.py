"""Cleaning of names, identifiers and tokens with built-in expressions only."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellspark import constants as K

# Spellings of numbers in identifiers.
_SCIENTIFIC = r"^[+-]?\d+\.?\d*[eE][+-]?\d+$"
_NUMBER_START = r"^[\x00-\x20]*[+-]?[0-9.iI]"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(c.cast("string"), F.lit(K.WHITESPACE))


def is_empty(c: Column, tokens: Sequence[str] = K.EMPTY_STAGE) -> Column:
    """Null, or one of the tokens that stand for a missing value. Never null itself."""
    return c.isNull() | F.lower(strip(c)).isin([t.lower() for t in tokens])


def blank_to_null(c: Column, tokens: Sequence[str] = K.EMPTY_STAGE) -> Column:
    return F.when(~is_empty(c, tokens), strip(c))


def number(c: Column) -> Column:
    """Number or null; text that spells a missing number is null as well."""
    text = c.cast("string")
    # Other beginnings are no number, and a failed cast throws for every row.
    value = F.when(text.rlike(_NUMBER_START), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def whole_days(c: Column) -> Column:
    """Days rounded half to even, as a long; null stays null."""
    return F.bround(c.cast("double")).cast("long")


def _plain_decimal(value: Column) -> Column:
    """A double without exponent and without trailing zeros."""
    fixed = F.bround(value, 6).try_cast("decimal(38,6)").cast("string")
    return F.regexp_replace(fixed, r"\.?0+$", "")


def double_id(c: Column) -> Column:
    """Identifier that arrived as a floating number, as text."""
    whole = c.try_cast("decimal(38,0)").cast("string")
    return F.when(
        ~F.isnan(c) & (F.abs(c) != float("inf")),
        F.when(c == F.floor(c), whole).otherwise(_plain_decimal(c)),
    )


def text_id(c: Column) -> Column:
    """Identifier as text: no float tail, no exponent, missing tokens become null."""
    text = strip(c)
    value = text.try_cast("double")
    expanded = F.coalesce(
        F.when(value == F.floor(value), value.try_cast("decimal(38,0)").cast("string")),
        _plain_decimal(value),
        text,
    )
    tail = F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"^\+", "")
    return F.when(
        ~is_empty(c, K.EMPTY_TEXT_ID),
        F.when(text.rlike(_SCIENTIFIC), expanded)
        .when(text.rlike(r"^[+-]?\d+\.0+$"), tail)
        .otherwise(text),
    )


def id_token(c: Column) -> Column:
    """Join key form of an identifier; missing tokens become null and match nothing."""
    return F.when(
        ~is_empty(c, K.EMPTY_ID), F.regexp_replace(strip(c), r"^(-?\d+)\.0$", "$1")
    )


def tab_number(c: Column, width: int = K.TAB_NUMBER_WIDTH) -> Column:
    """Employee number: digits only, padded to `width`; null when there is no digit."""
    text = strip(c)
    dotted = F.replace(text, F.lit(","), F.lit("."))
    value = dotted.try_cast("double")
    whole = text.contains(".") & dotted.rlike(_DECIMAL) & (value == F.floor(value))
    # Named once, because a nested expression is computed wherever it is named.
    digits = F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(F.regexp_replace(text, r"[^0-9]", ""))
    padded = F.regexp_replace(F.concat(F.lit("0" * width), digits), rf"^0+(?=.{{{width}}})", "")
    return F.when(~is_empty(c, K.EMPTY_ID) & text.rlike("[0-9]"), padded)


def tab_number_lines(c: Column) -> Column:
    """Employee numbers given one per line, each normalised, empty lines dropped."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda line: tab_number(line)), lambda x: x.isNotNull())
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def person_name(c: Column) -> Column:
    """Name with single spaces; missing tokens become null."""
    text = F.trim(F.regexp_replace(strip(c), r"(?U)\s+", " "))
    return F.when(~is_empty(c, K.EMPTY_NAME), text)


def team_type(c: Column) -> Column:
    """Team type token: 1.0 and 1 are the same; missing becomes the empty string."""
    text = F.lower(strip(c))
    return F.coalesce(F.regexp_replace(text, r"^(\d+)\.0$", "$1"), F.lit(""))


def is_leader(c: Column, words: Sequence[str] = K.LEADER_WORDS) -> Column:
    return F.coalesce(F.lower(strip(c)).isin([w.lower() for w in words]), F.lit(False))


def role_label(prefix: str, role: Column) -> Column:
    """Role of a team leader with the name of the team in front of it."""
    clean = F.trim(F.regexp_replace(F.coalesce(role, F.lit("")), r"(?U)\s+", " "))
    return F.concat(F.lit(prefix), F.when(clean == "", F.lit(K.TEAM_DEFAULT_ROLE)).otherwise(clean))


def source_category(file_name: Column, markers: Sequence[tuple[str, str]], unknown: str) -> Column:
    """Category of a file: the first marker found in its name wins."""
    out = None
    for marker, label in markers:
        hit = file_name.contains(marker)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(unknown) if out is None else out.otherwise(F.lit(unknown))


def client_name(
    c: Column, forms: Sequence[tuple[str, str]] = K.LEGAL_FORMS, enabled: bool = True
) -> Column:
    """Client name with the legal form shortened.

    The name is cut once at every place that holds a form, in brackets or quotes of its own or
    bare, or an abbreviation that is glued to what follows; longer ones are tried first. Each such
    place is looked up and put back as its abbreviation.
    """
    text = strip(c)
    if not enabled:
        return F.when(text != "", text)
    short = {full.strip().lower(): abbreviation.strip() for full, abbreviation in forms if full.strip()}

    def any_of(names) -> str:
        return "|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n)))

    form, glued = f"(?iu:{any_of(short)})", f"(?:{any_of(set(short.values()))})"
    known = F.create_map(*[F.lit(x) for pair in short.items() for x in pair])
    # Looked at first, so that most places of a name are passed by one look.
    begins = "|".join([r"[«\"'(\[]", f"(?iu:{any_of({n[0] for n in short})})", any_of({n[0] for n in short.values() if n})])
    place = rf"(?={begins})(?:[«\"'(\[]\s*{form}\.?\s*[»\"')\]]|{form}\.?|{glued}(?=[A-Za-zА-Яа-яЁё0-9«\"'(\[]))"
    # What lies before a place, and the place; a split by an expression would compile it for every row.
    step = F.lit(rf"([\s\S]*?)({place}|\z)")

    def abbreviation(found: Column) -> Column:
        bare = F.lower(F.regexp_extract(found, form, 0))
        return F.concat(F.coalesce(F.element_at(known, F.nullif(bare, F.lit(""))), found), F.lit(" "))

    steps = F.arrays_zip(
        F.regexp_extract_all(text, step, F.lit(1)).alias("b"), F.regexp_extract_all(text, step, F.lit(2)).alias("f")
    )
    pieces = F.transform(steps, lambda x: F.concat(x["b"], F.when(x["f"] == "", x["f"]).otherwise(abbreviation(x["f"]))))
    return F.get(F.filter(F.array(_tidy(F.array_join(pieces, ""))), lambda name: name != ""), F.lit(0))


def _tidy(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"(?U)\s{2,}", " "), F.lit(" ,;"))


def manager_key(tab: Column, name: Column) -> Column:
    """Key of a manager: the employee number, else the folded name."""
    return F.coalesce(F.concat(F.lit("TN:"), tab), F.concat(F.lit("FIO:"), F.lower(name)))


def territory_manager_key(tb: Column, km: Column) -> Column:
    return F.concat(F.coalesce(tb, F.lit("")), F.lit("|"), F.coalesce(km, F.lit("")))
