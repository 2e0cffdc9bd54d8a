"""Which physical column plays which part, so that one operator serves many tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Columns of a sale row. The defaults are the names that the cleaning step gives."""

    id: str = "transaction_id"
    price: str = "price_per_m2"
    value: str = "sale_value_eur"
    surface: str = "built_surface_m2"
    rooms: str = "rooms"
    kind: str = "Type local"
    apartment: str = "Appartement"
    house: str = "Maison"
    longitude: str = "longitude"
    latitude: str = "latitude"
    district: str = "arrondissement"
    year: str = "year"


SALES = Roles()
