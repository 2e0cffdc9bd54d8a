"""Fixed vocabulary of the published tables: metrics, levels, table names."""

from __future__ import annotations

from citygrain.operators.sales import METRICS

# Label, unit, and whether a sales year can be chosen.
METRIC_CATALOG = {
    "median_price_m2": ("Prix median au m²", "EUR/m²", True),
    "transactions": ("Transactions retenues", "count", True),
    "median_sale_value_eur": ("Valeur mediane de vente", "EUR", True),
    "median_surface_m2": ("Surface mediane", "m²", True),
    "median_rooms": ("Pieces medianes", "pieces", True),
    "apartment_share_pct": ("Part appartements", "%", True),
    "house_share_pct": ("Part maisons", "%", True),
    "median_income_eur": ("Revenu median", "EUR/an", False),
    "reference_rent_majorated_eur_m2": ("Loyer majore moyen", "EUR/m²", False),
    "social_units_financed": ("Logements sociaux finances", "count", False),
    "social_units_financed_5y": ("Logements sociaux finances sur 5 ans", "count", False),
    "months_income_for_1sqm": ("Mois de revenu pour 1 m²", "months", False),
    "estimated_50m2_rent_effort_pct": ("Effort locatif estime pour 50 m²", "%", False),
    "quality_of_life_score": ("Qualite de vie", "/10", False),
    "environmental_pressure_index": ("Pression environnementale", "/100", False),
    "high_noise_share_pct": ("Part de forte exposition au bruit", "%", False),
    "noise_score": ("Score bruit", "class", False),
    "air_score": ("Score air", "class", False),
}
LEVEL_LABELS = {
    "arrondissement": "Arrondissements",
    "quartier": "Quartiers",
    "street": "Rues",
    "building": "Batiments",
}

#: Levels below the district know the sales only.
LEVEL_METRICS = {
    level: tuple(METRIC_CATALOG) if level == "arrondissement" else METRICS for level in LEVEL_LABELS
}

COMPARED_DISTRICT_METRICS = (
    "median_price_m2",
    "median_income_eur",
    "reference_rent_majorated_eur_m2",
    "social_units_financed",
    "quality_of_life_score",
    "months_income_for_1sqm",
    "estimated_50m2_rent_effort_pct",
)
COMPARED_QUARTIER_METRICS = METRICS

# Published tables; a silver name holds the same rows as its gold one.
TABLES = {
    "silver_sales": "silver_sales_yearly",
    "silver_sales_quartier": "silver_sales_quartier_yearly",
    "silver_sales_iris": "silver_sales_iris_yearly",
    "silver_sales_geocoded": "silver_sales_geocoded",
    "silver_sales_street": "silver_sales_street_yearly",
    "silver_sales_building": "silver_sales_building_yearly",
    "silver_income": "silver_income_arrondissement",
    "silver_rents": "silver_rents_yearly",
    "silver_social": "silver_social_yearly",
    "silver_noise": "silver_noise_arrondissement",
    "gold_summary": "gold_arrondissement_summary",
    "gold_sales": "gold_sales_yearly",
    "gold_sales_quartier": "gold_sales_quartier_yearly",
    "gold_sales_iris": "gold_sales_iris_yearly",
    "gold_sales_geocoded": "gold_sales_geocoded",
    "gold_sales_street": "gold_sales_street_yearly",
    "gold_sales_building": "gold_sales_building_yearly",
    "gold_social": "gold_social_yearly",
    "gold_rents": "gold_rents_yearly",
    "gold_income": "gold_income_arrondissement",
    "gold_noise": "gold_noise_arrondissement",
}
FEATURE_COLLECTIONS = {
    "gold_geojson": "gold_arrondissements_geojson",
    "gold_quartiers_geojson": "gold_quartiers_geojson",
    "gold_streets_geojson": "gold_streets_geojson",
    "gold_iris_geojson": "gold_iris_geojson",
}
DOCUMENTS = {
    "gold_dashboard": "gold_dashboard_metadata",
    "gold_spatial_coverage": "gold_sales_spatial_coverage",
}
