"""Tunable constants. Defaults are the published business rules; tests override the periods."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

MONTH_ABBR = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# --- fixed values: words, codes and weights that results depend on --------------------------
DISTRIBUTORS = (
    "DIST_W_01", "DIST_W_02", "DIST_W_03", "DIST_C_01", "DIST_C_02",
    "DIST_C_03", "DIST_NW_01", "DIST_NW_02", "DIST_S_01", "DIST_S_02",
)
DISTRIBUTOR_PROVINCE = {
    "DIST_W_01": "Western", "DIST_W_02": "Western", "DIST_W_03": "Western",
    "DIST_C_01": "Central", "DIST_C_02": "Central", "DIST_C_03": "Central",
    "DIST_NW_01": "North-Western", "DIST_NW_02": "North-Western",
    "DIST_S_01": "Southern", "DIST_S_02": "Southern",
}
PROVINCE_CENTROID = {
    "Western": (6.9271, 79.8612),
    "Central": (7.2906, 80.6337),
    "North-Western": (7.7102, 80.0078),
    "Southern": (6.0535, 80.2210),
}
FALLBACK_CENTROID = (7.0, 80.0)
SEASON_MULTIPLIER = {"Favorable": 1.20, "Moderate": 1.00, "Un-Favorable": 0.85}
HOLIDAY_TYPES = {"Public": "is_public", "Bank": "is_bank", "Mercantile": "is_mercantile", "Poya Day": "is_poya_day"}
OUTLET_SIZES = ("Small", "Medium", "Large", "Extra Large")
OUTLET_TYPES = ("Grocery", "Bakery", "Eatery", "Pharmacy", "Hotel", "SMMT", "Kiosk")
TYPE_CORRECTIONS = {"Grocry": "Grocery", "Bakry": "Bakery"}
SIZE_BY_COOLERS = {0: "Small", 1: "Small", 2: "Medium", 3: "Large", 4: "Large", 5: "Extra Large"}
COLUMN_ALIASES = {
    "Outlet_ID": ("outlet_id", "outlet id", "outletid", "shop_id"),
    "Distributor_ID": ("distributor_id", "dist_id", "distributor"),
    "Volume_Litres": ("volume_litres", "volume", "litres", "qty", "quantity", "sales_volume", "volume_liters"),
}
# (tag, value) pairs per category, in matching order: the counted set and the distance-decay set
FLAT_POI_RULES = {
    "schools": (("amenity", "school"), ("amenity", "university")),
    "hospitals": (("amenity", "hospital"), ("amenity", "clinic")),
    "transport": (("highway", "bus_stop"), ("railway", "station")),
    "markets": (("shop", "supermarket"), ("amenity", "marketplace")),
    "worship": (("amenity", "place_of_worship"),),
    "hospitality": (("tourism", "hotel"), ("amenity", "restaurant")),
}
GRAVITY_POI_RULES = {
    "school": (("amenity", "school"), ("amenity", "university"), ("amenity", "college")),
    "hospital": (("amenity", "hospital"), ("amenity", "clinic"), ("amenity", "pharmacy")),
    "transport": (("highway", "bus_stop"), ("railway", "station"), ("railway", "halt")),
    "market": (("shop", "supermarket"), ("amenity", "marketplace"), ("shop", "convenience")),
    "worship": (("amenity", "place_of_worship"),),
    "hospitality": (("amenity", "restaurant"), ("amenity", "hotel"), ("tourism", "hotel")),
}
POI_TYPE_TAGS = ("amenity", "shop", "leisure", "tourism", "highway", "public_transport")
FOOTFALL_WEIGHTS = {
    "transport": 3.0, "schools": 2.5, "markets": 2.0, "hospitals": 1.5, "worship": 1.0, "hospitality": 1.0,
}
GRAVITY_WEIGHTS = {
    "transport": 3.0, "school": 3.0, "hospitality": 2.0, "market": 2.0, "hospital": 1.0, "worship": 0.5,
}
# tier -> (cap, floor, litres per unit of spend, spend type)
TIER_PARAMETERS = {
    "High": (12000.0, 2000.0, 0.028, "Cooler Subsidy / Display Rack"),
    "Medium": (3000.0, 500.0, 0.012, "Promotional Discount"),
    "Low": (800.0, 500.0, 0.004, "Light Merchandising"),
    "None": (0.0, 0.0, 0.0, "None"),
}
# --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    lat_min: float = 5.9
    lat_max: float = 9.9
    lon_min: float = 79.5
    lon_max: float = 81.9


@dataclass(frozen=True)
class Budget:
    buckets: dict = field(default_factory=lambda: {"High": 2_500_000.0, "Medium": 1_750_000.0, "Low": 750_000.0})
    cohort: tuple = ("DIST_W_01", "DIST_W_02", "DIST_W_03")
    tier_shares: tuple = (("High", 0.15), ("Medium", 0.35), ("Low", 0.15))
    min_share: float = 0.25
    min_high_medium_share: float = 0.60
    min_funded: int = 1000
    step: float = 50.0

    @property
    def total(self) -> float:
        return float(sum(self.buckets.values()))


@dataclass(frozen=True)
class Config:
    bounds: Bounds = Bounds()
    tx_years: tuple = (2020, 2025)
    season_years: tuple = (2023, 2025)
    target: tuple = (2026, 1)
    manual_holidays: tuple = (
        (dt.date(2026, 1, 2), "Duruthu Full Moon Poya Day", True, True, True, True),
        (dt.date(2026, 1, 14), "Thai Pongal Day", True, True, True, False),
    )
    outlet_id_pattern: str = r"OUT_\d{5}"
    cooler_range: tuple = (0, 5)
    min_volume: float = 0.01
    iqr_factor: float = 5.0
    iqr_min_rows: int = 4
    radii_m: tuple = (500, 1000, 2000)
    decay_epsilon_km: float = 0.05
    gravity_radius_km: float = 2.0
    dbscan_eps_km: float = 1.0
    dbscan_min_points: int = 5
    n_tiles: int = 400
    tile_buffer_deg: float = 0.018
    litres_per_cooler: float = 150.0
    replenishment_days: float = 3.0
    fills_per_cycle: float = 0.85
    working_days: float = 22.0
    seed: int = 42
    folds: int = 5
    latent_rounds: int = 100
    budget: Budget = Budget()

    @property
    def target_label(self) -> str:
        """Month label used in column names, e.g. ``jan_2026``."""
        return f"{MONTH_ABBR[self.target[1] - 1]}_{self.target[0]}"
