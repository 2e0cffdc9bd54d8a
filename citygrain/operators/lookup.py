"""Address and parcel lookups, and the geocoding cascade over them.

No join here carries a broadcast hint: the references grow with the data, so Spark decides from
measured sizes, and splits a dominant key adaptively where both sides are shuffled. Every lookup
side is unique on its key, so the row count of the sales never changes.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions import keys as k
from citygrain.functions.numbers import to_number
from citygrain.functions.text import normalize_house_number, normalize_street, normalize_suffix
from citygrain.operators.medians import HOT_GROUP_ROWS, with_medians
from citygrain.session import broadcast_limit, estimated_bytes

# Link kinds by preference, and the rank and address count of anything else.
LINK_PRIORITY = {"GEO": 0, "BAN": 1}
OTHER_PRIORITY = 9
UNKNOWN_ADDRESS_COUNT = 999_999

GEOCODE_COLUMNS = ("matched_cle_interop", "longitude", "latitude", "geocode_source")
ADDRESS_SOURCE = "adresses-ban"
PARCEL_SOURCE = "ban-plus"


def type_addresses(raw: DataFrame) -> DataFrame:
    """Address reference lines to keyed addresses; lines without both coordinates are dropped."""
    c = F.col
    typed = raw.select(
        "cle_interop",
        "commune_insee",
        normalize_street(c("voie_nom")).alias("street_name"),
        normalize_house_number(c("numero")).alias("house_number"),
        normalize_suffix(c("suffixe")).alias("house_suffix"),
        to_number(c("long")).alias("long"),
        to_number(c("lat")).alias("lat"),
        F.coalesce(to_number(c("certification_commune")), F.lit(0.0)).alias("certification_commune"),
    ).where(c("long").isNotNull() & c("lat").isNotNull())
    return typed.withColumns(
        {
            "address_key": k.address_key(
                c("commune_insee"), c("house_number"), c("house_suffix"), c("street_name")
            ),
            "address_key_no_suffix": k.address_key_no_suffix(
                c("commune_insee"), c("house_number"), c("street_name")
            ),
        }
    )


def dedupe_reference(
    df: DataFrame,
    key: str,
    id_column: str = "cle_interop",
    longitude: str = "long",
    latitude: str = "lat",
    certification: str = "certification_commune",
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """One row per key: the best certified id, and the median position of all rows of the key."""
    rows = df.where(F.col(key).isNotNull())
    order = F.struct(-F.col(certification), F.col(id_column))
    best = F.min_by(F.col(id_column), F.when(F.col(id_column).isNotNull(), order)).alias("_id")
    grouped = with_medians(
        rows.withColumn("lookup_key", F.col(key)),
        ["lookup_key"],
        {"long": F.col(longitude), "lat": F.col(latitude)},
        [best],
        hot_rows=hot_rows,
    )
    return grouped.select("lookup_key", F.col("_id").alias("cle_interop"), "long", "lat")


def link_priority(kind: Column) -> Column:
    rank = F.lit(OTHER_PRIORITY)
    for name, value in LINK_PRIORITY.items():
        rank = F.when(kind == name, value).otherwise(rank)
    return rank


def best_link(links: DataFrame) -> DataFrame:
    """The preferred address of each parcel. A minimum by rank, combined map-side."""
    valid = links.where(F.col("id_adr").isNotNull() & (F.col("id_adr") != "") & F.col("idu").isNotNull())
    addresses = F.coalesce(to_number(F.col("nb_adr").cast("string")), F.lit(float(UNKNOWN_ADDRESS_COUNT)))
    order = F.struct(link_priority(F.col("type_lien")), addresses, F.col("id_adr"), F.col("type_lien"))
    return valid.groupBy("idu").agg(
        F.min_by("id_adr", order).alias("id_adr"),
        F.min_by("type_lien", F.when(F.col("type_lien").isNotNull(), order)).alias("type_lien"),
    )


def unknown_ids(requested: DataFrame, known: DataFrame, column: str = "idu") -> DataFrame:
    """Distinct requested ids that the known rows lack."""
    wanted = requested.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).dropDuplicates()
    return wanted.join(known.select(column).where(F.col(column).isNotNull()).dropDuplicates(), column, "left_anti")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that comes last in ``order`` per key; NULL keys are equal to each other.

    A limit of one per key is applied before the shuffle, so a key with many rows stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def merge_links(cache: DataFrame, fetched: DataFrame, requested: DataFrame, seq: str = "seq") -> DataFrame:
    """Refresh the parcel-link cache.

    Ids asked for and not yet cached take their fetched rows, or one row of empty fields when
    nothing came back; of equal (idu, id_adr, type_lien) the row added last stays. ``seq`` orders
    the rows of a frame; fetched rows come after cached ones.
    """
    fields = ["idu", "id_adr", "type_lien", "nb_adr", "nb_parc"]
    missing = unknown_ids(requested, cache)
    new = fetched.join(missing, "idu", "left_semi")
    empty = (
        unknown_ids(missing, new)
        .select("idu", *[F.lit("").alias(name) for name in fields[1:]], F.lit(0).cast("bigint").alias(seq))
    )
    rows = (
        cache.select(*fields, F.col(seq).cast("bigint").alias(seq), F.lit(0).alias("_batch"))
        .unionByName(new.select(*fields, F.col(seq).cast("bigint").alias(seq), F.lit(1).alias("_batch")))
        .unionByName(empty.select(*fields, seq, F.lit(1).alias("_batch")))
    )
    return last_per_key(rows, ["idu", "id_adr", "type_lien"], ["_batch", seq]).select(*fields)


def _lookup(reference: DataFrame, key: str, prefix: str) -> DataFrame:
    return reference.select(
        F.col("lookup_key").alias(key),
        F.col("cle_interop").alias(f"{prefix}_id"),
        F.col("long").alias(f"{prefix}_lon"),
        F.col("lat").alias(f"{prefix}_lat"),
    )


def geocode(
    sales: DataFrame,
    with_suffix: DataFrame,
    without_suffix: DataFrame,
    by_id: DataFrame,
    links: DataFrame | None = None,
    by_keys: bool | None = None,
) -> DataFrame:
    """Exact address, then the address without suffix, then the parcel's address.

    The three references come from :func:`dedupe_reference`, ``links`` from :func:`best_link`.
    A later tier only fills rows that still lack a longitude; it replaces their id even by NULL.

    References that Spark can broadcast are joined to the sales directly, without a shuffle, and
    so is the one tier that it can't: the sales are shuffled for that one. Where more tiers are large
    (``by_keys``) they meet the distinct keys of the sales first, so that the sales themselves are
    still shuffled once and not for every tier.
    """
    sides = (with_suffix, without_suffix, by_id, links)
    if by_keys is None:
        limit = broadcast_limit(sales.sparkSession)
        tiers = ([with_suffix], [without_suffix], [] if links is None else [by_id, links])
        by_keys = sum(any(estimated_bytes(side) > limit for side in tier) for tier in tiers) > 1
    if not by_keys:
        return _cascade(sales, *sides)
    keys = ["address_key", "address_key_no_suffix", "parcel_id"]
    resolved = _cascade(sales.select(*keys).dropDuplicates(), *sides)
    same = reduce(and_, [F.col(f"s.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys])
    return sales.alias("s").join(resolved.alias("r"), same, "left").select("s.*", *[f"r.{name}" for name in GEOCODE_COLUMNS])


def _cascade(
    sales: DataFrame,
    with_suffix: DataFrame,
    without_suffix: DataFrame,
    by_id: DataFrame,
    links: DataFrame | None,
) -> DataFrame:
    c = F.col
    rows = sales.join(_lookup(with_suffix, "address_key", "_a"), "address_key", "left").join(
        _lookup(without_suffix, "address_key_no_suffix", "_b"), "address_key_no_suffix", "left"
    )
    retry = c("_a_lon").isNull()
    rows = rows.withColumns(
        {
            "matched_cle_interop": F.when(retry, c("_b_id")).otherwise(c("_a_id")),
            "longitude": F.when(retry, c("_b_lon")).otherwise(c("_a_lon")),
            "latitude": F.when(retry, c("_b_lat")).otherwise(c("_a_lat")),
            "geocode_source": F.when(c("_a_id").isNotNull() | (retry & c("_b_id").isNotNull()), ADDRESS_SOURCE),
        }
    )
    if links is not None:
        # Links take their coordinates on the small side first: one join on the sales, not two.
        parcels = links.select(c("idu").alias("_parcel"), c("id_adr").alias("_c_id")).join(
            _lookup(by_id, "_c_id", "_d").drop("_d_id"), "_c_id", "left"
        )
        # A missing parcel takes its address key, which no parcel equals: NULLs would all land
        # in one partition of a shuffled join.
        spread = F.coalesce(c("parcel_id"), c("address_key"))
        third = c("longitude").isNull() & c("parcel_id").isNotNull()
        rows = rows.withColumn("_parcel", spread).join(parcels, "_parcel", "left")
        rows = rows.withColumns(
            {
                "matched_cle_interop": F.when(third, c("_c_id")).otherwise(c("matched_cle_interop")),
                "longitude": F.when(third, c("_d_lon")).otherwise(c("longitude")),
                "latitude": F.when(third, c("_d_lat")).otherwise(c("latitude")),
                "geocode_source": F.when(third & c("_d_lon").isNotNull(), PARCEL_SOURCE).otherwise(
                    c("geocode_source")
                ),
            }
        )
    return rows.select(*[F.col(f"`{name}`") for name in sales.columns], *GEOCODE_COLUMNS)


def add_micro_keys(df: DataFrame) -> DataFrame:
    """Street key, building id with its source, and building label of geocoded sales."""
    c = F.col
    ids = (c("matched_cle_interop"), c("parcel_id"), c("address_key"))
    return df.withColumns(
        {
            "street_key": k.street_key(c("commune_insee"), c("street_name")),
            "building_id": k.building_id(*ids),
            "building_id_source": k.building_id_source(*ids),
        }
    ).withColumn(
        "building_label",
        k.building_label(c("house_number"), c("house_suffix"), c("street_name"), c("building_id")),
    )


def with_district_name(df: DataFrame, names: DataFrame, district: str = "arrondissement") -> DataFrame:
    """Add ``arrondissement_name``; ``names`` has (district, name)."""
    lookup = names.select(district, F.col("name").alias("arrondissement_name")).dropDuplicates([district])
    return df.join(lookup, district, "left")
