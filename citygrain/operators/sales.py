"""Sale rows: quality filter, derived keys, and the sales aggregate at every geographic grain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import keys as k
from citygrain.functions.numbers import french_to_double, price_per_m2, round_even, where_once
from citygrain.functions.text import normalize_house_number, normalize_street, normalize_suffix
from citygrain.operators.medians import HOT_GROUP_ROWS, with_medians
from citygrain.roles import SALES, Roles

METRICS = (
    "transactions",
    "median_price_m2",
    "median_sale_value_eur",
    "median_surface_m2",
    "median_rooms",
    "apartment_share_pct",
    "house_share_pct",
)

DISTRICT_KEYS = ("arrondissement", "year")
QUARTIER_KEYS = ("quartier_id", "quartier_name", "arrondissement", "year")
IRIS_KEYS = ("iris_code", "iris_name", "iris_type", "arrondissement", "year")
STREET_KEYS = ("street_key", "street_name", "arrondissement", "commune_insee", "year")
BUILDING_KEYS = (
    "building_id",
    "building_id_source",
    "building_label",
    "arrondissement",
    "commune_insee",
    "street_name",
    "house_number",
    "house_suffix",
    "year",
)


@dataclass(frozen=True)
class QualityRules:
    """Bounds of a usable sale. Surface and value are exclusive, the others inclusive."""

    nature: str = "Vente"
    districts: tuple[int, int] = (1, 20)
    kinds: tuple[str, ...] = ("Appartement", "Maison")
    min_surface: float = 10.0
    min_value: float = 10_000.0
    price_range: tuple[float, float] = (1_000.0, 50_000.0)


def clean_sales(
    df: DataFrame,
    rules: QualityRules = QualityRules(),
    roles: Roles = SALES,
    nature: str = "Nature mutation",
    parsed: bool = False,
) -> DataFrame:
    """Keep usable sales and add the price per square metre. A NULL in any test drops the row.

    ``parsed`` tells that numbers are worked out of texts by the same plan: they are bound once then.
    Typed columns are tested one by one, so that their bounds reach the scan.
    """
    district, value, surface = F.col(roles.district), F.col(roles.value), F.col(roles.surface)
    price = price_per_m2(value, surface)

    def usable(sale: Column) -> Column:
        own = price_per_m2(sale[roles.value], sale[roles.surface])
        large = (sale[roles.surface] > rules.min_surface) & (sale[roles.value] > rules.min_value)
        return sale[roles.district].between(*rules.districts) & large & own.between(*rules.price_range)

    # The tests on raw texts come first and reach the scan.
    sold = df.where(F.col(f"`{nature}`") == rules.nature).where(F.col(f"`{roles.kind}`").isin(*rules.kinds))
    if parsed:
        sold = where_once(sold, [roles.district, roles.value, roles.surface], usable)
    else:
        sold = sold.where(district.between(*rules.districts) & (surface > rules.min_surface) & (value > rules.min_value))
        sold = sold.where(price.between(*rules.price_range))
    return sold.withColumn(roles.price, price)


def type_sales(raw: DataFrame) -> DataFrame:
    """District and numbers out of the raw text columns."""
    return raw.withColumns(
        {
            "arrondissement": k.postal_to_district(F.col("Code postal")),
            "sale_value_eur": french_to_double(F.col("Valeur fonciere")),
            "built_surface_m2": french_to_double(F.col("Surface reelle bati")),
            "rooms": french_to_double(F.col("Nombre pieces principales")),
        }
    )


def add_sale_keys(df: DataFrame) -> DataFrame:
    """Commune, address, parcel and transaction ids of a typed sale."""
    dep, commune = F.col("Code departement"), F.col("Code commune")
    parts = df.withColumns(
        {
            "commune_insee": k.commune_code(dep, commune),
            "house_number": normalize_house_number(F.col("No voie")),
            "house_suffix": normalize_suffix(F.col("`B/T/Q`")),
            "street_name": normalize_street(
                k.joined(F.col("Type de voie"), F.col("Voie"), sep=" ")
            ),
            "parcel_id": k.parcel_id(
                dep, commune, F.col("Prefixe de section"), F.col("Section"), F.col("No plan")
            ),
        }
    )
    c = F.col
    return parts.withColumns(
        {
            "address_key": k.address_key(
                c("commune_insee"), c("house_number"), c("house_suffix"), c("street_name")
            ),
            "address_key_no_suffix": k.address_key_no_suffix(
                c("commune_insee"), c("house_number"), c("street_name")
            ),
            "transaction_id": k.transaction_id(
                c("Date mutation"),
                c("Valeur fonciere"),
                c("parcel_id"),
                c("house_number"),
                c("street_name"),
                c("Type local"),
                c("Surface reelle bati"),
            ),
        }
    )


def sales_from_raw(raw: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Raw source lines to clean, typed and keyed sales."""
    return add_sale_keys(clean_sales(type_sales(raw), rules, parsed=True))


def share_pct(flag: Column) -> Column:
    """Percentage of rows with the flag set; NULL counts as not set."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0)) * 100.0


def sales_metrics(
    df: DataFrame,
    keys: Sequence[str],
    roles: Roles = SALES,
    extra_medians: dict[str, Column] | None = None,
    extra_distinct: dict[str, Column] | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """The sales aggregate for any list of keys; a row with a NULL key belongs to no group."""
    keys = list(keys)
    kind = F.col(f"`{roles.kind}`")
    medians = {
        "median_price_m2": F.col(roles.price),
        "median_sale_value_eur": F.col(roles.value),
        "median_surface_m2": F.col(roles.surface),
        "median_rooms": F.col(roles.rooms),
        **(extra_medians or {}),
    }
    shares = [
        share_pct(kind == roles.apartment).alias("apartment_share_pct"),
        share_pct(kind == roles.house).alias("house_share_pct"),
    ]
    distinct = {"transactions": F.col(roles.id), **(extra_distinct or {})}
    result = with_medians(df, keys, medians, shares, distinct, hot_rows, null_keys=False)
    return result.select(
        *keys,
        *distinct,
        *[round_even(F.col(name), 2).alias(name) for name in METRICS if name.startswith("median_")],
        *[round_even(F.col(name), 1).alias(name) for name in METRICS if name.endswith("_share_pct")],
        *(extra_medians or {}),
    )


def sales_by_district(df: DataFrame, roles: Roles = SALES, **options) -> DataFrame:
    return sales_metrics(df, [roles.district, roles.year], roles, **options)


def sales_by_quartier(df: DataFrame, roles: Roles = SALES, **options) -> DataFrame:
    return sales_metrics(df, QUARTIER_KEYS, roles, **options)


def sales_by_iris(df: DataFrame, roles: Roles = SALES, **options) -> DataFrame:
    return sales_metrics(df, IRIS_KEYS, roles, **options)


def _located(roles: Roles) -> Column:
    return F.when(F.col(roles.longitude).isNotNull(), F.col(roles.id))


def _position(roles: Roles) -> dict[str, Column]:
    return {"longitude": F.col(roles.longitude), "latitude": F.col(roles.latitude)}


def sales_by_street(df: DataFrame, roles: Roles = SALES, **options) -> DataFrame:
    result = sales_metrics(
        df,
        STREET_KEYS,
        roles,
        extra_medians=_position(roles),
        extra_distinct={"buildings": F.col("building_id"), "geocoded_transactions": _located(roles)},
        **options,
    )
    return result.select(
        *STREET_KEYS, "buildings", "geocoded_transactions", "longitude", "latitude", *METRICS
    )


def sales_by_building(df: DataFrame, roles: Roles = SALES, **options) -> DataFrame:
    result = sales_metrics(
        df,
        BUILDING_KEYS,
        roles,
        extra_medians=_position(roles),
        extra_distinct={"geocoded_transactions": _located(roles), "parcel_count": F.col("parcel_id")},
        **options,
    )
    return result.select(
        *BUILDING_KEYS, "geocoded_transactions", "longitude", "latitude", "parcel_count", *METRICS
    )


def union_sales(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows of the yearly frames, matched by column name."""
    for other in rest:
        first = first.unionByName(other)
    return first
