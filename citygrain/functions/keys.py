"""Identifiers put together from address, parcel and sale fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citygrain.functions.numbers import bound, zfill
from citygrain.functions.text import extract_digits

# Postal codes that do not follow the "last two digits" rule.
SPECIAL_POSTAL_CODES = {"75116": 16}
DEPARTMENT = "75"
DISTRICTS = (1, 20)


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def not_blank(c: Column) -> Column:
    """'' to NULL."""
    return F.nullif(c, F.lit(""))


def joined(*parts: Column, sep: str = "|") -> Column:
    """Join with a separator; a NULL part keeps its slot, which ``concat_ws`` does not."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(sep), blank(part)]
    return F.concat(*pieces[1:])


def postal_to_district(c: Column) -> Column:
    def of_digits(digits: Column) -> Column:
        last_two = F.right(digits, F.lit(2)).try_cast("int")
        regular = digits.startswith(DEPARTMENT) & (F.length(digits) >= 5) & last_two.between(*DISTRICTS)
        result = F.when(regular, last_two)
        for code, district in SPECIAL_POSTAL_CODES.items():
            result = F.when(digits == code, F.lit(district)).otherwise(result)
        return result

    return bound(extract_digits(c), of_digits)


def district_postal(district: Column) -> Column:
    return F.format_string(DEPARTMENT + "%03d", district.cast("int"))


def code_to_district(code: Column) -> Column:
    """Fourth and fifth characters of a zone code as a number."""
    return F.substring(code, 4, 2).try_cast("int")


def commune_code(department: Column, commune: Column) -> Column:
    return F.concat(extract_digits(department), zfill(extract_digits(commune), 3))


def address_key(commune: Column, number: Column, suffix: Column, street: Column) -> Column:
    return joined(commune, number, suffix, street)


def address_key_no_suffix(commune: Column, number: Column, street: Column) -> Column:
    return joined(commune, number, street)


def parcel_id(
    department: Column, commune: Column, prefix: Column, section: Column, plan: Column
) -> Column:
    """Cadastral parcel; NULL when department, section or plan is missing."""
    dep = extract_digits(department)
    sheet = F.replace(F.upper(blank(section)), F.lit(" "), F.lit(""))
    number = extract_digits(plan)
    whole = F.concat(
        commune_code(department, commune),
        zfill(extract_digits(prefix), 3),
        sheet,
        zfill(number, 4),
    )
    return F.when((dep != "") & (sheet != "") & (number != ""), whole)


def transaction_id(
    date: Column, value: Column, parcel: Column, number: Column, street: Column, kind: Column, surface: Column
) -> Column:
    """Seven raw fields; repeated source lines of one sale share it."""
    return joined(date, value, parcel, number, street, kind, surface)


def street_key(commune: Column, street: Column) -> Column:
    return F.when(blank(street) != "", joined(commune, street))


def building_id(matched: Column, parcel: Column, address: Column) -> Column:
    return F.coalesce(not_blank(matched), not_blank(parcel), not_blank(address))


def building_id_source(matched: Column, parcel: Column, address: Column) -> Column:
    return (
        F.when(blank(matched) != "", "ban_address")
        .when(blank(parcel) != "", "parcel")
        .when(blank(address) != "", "address_key")
    )


def building_label(number: Column, suffix: Column, street: Column, building: Column) -> Column:
    """"number suffix street" with single blanks, or the building id when all are empty."""
    label = F.trim(F.regexp_replace(joined(number, suffix, street, sep=" "), r"\s+", " "))
    return F.coalesce(not_blank(label), building)


def street_raw_name(designation: Column, link: Column, name: Column) -> Column:
    """The three name parts, blank ones skipped."""
    parts = F.array(*[F.trim(blank(part)) for part in (designation, link, name)])
    return F.array_join(F.filter(parts, lambda part: part != ""), " ")


def street_display_name(long_name: Column, raw_name: Column, street: Column) -> Column:
    shown = F.trim(F.coalesce(not_blank(long_name), raw_name))
    return F.coalesce(not_blank(shown), street)


def first_given(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor ''."""
    return F.coalesce(*[not_blank(candidate.cast("string")) for candidate in candidates])


