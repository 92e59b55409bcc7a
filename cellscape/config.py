"""Experiment configuration: fixed values that results depend on."""

from __future__ import annotations

# City parameters (degrees, metres).
CITIES = {
    "amman": {"longitude": 35.928396, "latitude": 31.963158, "buffer_size": 0.01, "srid": 32236, "buffer_dist": 25000, "country": "jordan"},
    "irbid": {"longitude": 35.851479, "latitude": 32.551445, "buffer_size": 0.01, "srid": 32236, "buffer_dist": 15000, "country": "jordan"},
    "denpasar": {"longitude": 115.216667, "latitude": -8.65, "buffer_size": 0.01, "srid": 23890, "buffer_dist": 15000, "country": "indonesia"},
    "semarang": {"longitude": 110.416664, "latitude": -6.966667, "buffer_size": 0.01, "srid": 23890, "buffer_dist": 15000, "country": "indonesia"},
    "abidjan": {"longitude": -4.024429, "latitude": 5.345317, "buffer_size": 0.01, "srid": 32229, "buffer_dist": 15000, "country": "cote d'ivoire"},
    "mafraq": {"longitude": 36.20516, "latitude": 32.339939, "buffer_size": 0.01, "srid": 32237, "buffer_dist": 8000, "country": "jordan"},
}

# Grid, thresholds, periods, folds.
GRID_SIZE = 125
URBAN = {"built": 40, "population": 75, "cluster": 5000}
DENSE = {"built": 50, "population": 375, "cluster": 50000}
YEARS_TRAIN = [1990, 2000]
YEAR_PREDICT = 2014
N_FOLDS = 5
LABEL_RANGE = [10, 15]

# Data year -> model year of each yearly layer.
YEAR_MAP = {
    "built_lds": {1990: 1990, 2000: 2000, 2014: 2014},
    "city_lights": {1995: 1990, 2000: 2000, 2013: 2014},
    "population": {1990: 1990, 2000: 2000, 2015: 2014},
    "settlements": {1990: 1990, 2000: 2000, 2015: 2014},
}

# Columns a feature table can be asked for, by the layer that provides them.
LAYER_COLUMNS = {
    "highways": ["distance_highways_km"],
    "slope": ["min_slope_pct", "max_slope_pct", "mean_slope_pct", "stddev_slope_pct",
              "min_slope_degrees", "max_slope_degrees", "mean_slope_degrees", "stddev_slope_degrees"],
    "dem": ["min_dem", "max_dem", "mean_dem", "stddev_dem"],
    "geopins": ["worship_distance", "school_distance", "university_distance", "hospital_distance", "aeroway_distance"],
    "water_bodies": ["water_bodies_distance_km", "water_bodies_flag"],
    "city_center": ["city_center_distance_km"],
    "population": ["min_population", "max_population", "mean_population", "stddev_population", "sum_population"],
    "built_lds": ["min_built_lds", "max_built_lds", "mean_built_lds", "stddev_built_lds", "sum_built_lds"],
    "city_lights": ["min_city_lights", "max_city_lights", "mean_city_lights", "stddev_city_lights", "sum_city_lights"],
    "settlements": ["min_settlements", "max_settlements", "mean_settlements", "sum_settlements"],
    "urban_neighbours": ["urban_neighbours"],
}
URBAN_COLUMNS = ["urban_flag", "urban_distance_km", "high_density_distance_km"]
STATIC_LAYERS = ["slope", "dem", "geopins", "water_bodies", "city_center"]
YEARLY_LAYERS = ["built_lds", "city_lights", "settlements"]

# Features switched on by default.
DEFAULT_FEATURES = [
    "max_slope_pct", "mean_city_lights", "max_built_lds",
    "university_distance", "school_distance", "hospital_distance", "worship_distance",
    "aeroway_distance", "distance_highways_km", "mean_population",
    "water_bodies_distance_km", "water_bodies_flag", "city_center_distance_km",
    "urban_flag", "urban_distance_km", "high_density_distance_km",
]

# Models of the experiment and their parameter lists.
PARAMETER_GRIDS = {
    "RandomForest": {
        "n_estimators": [100, 500, 1000, 5000, 10000], "max_depth": [5, 10, 50], "max_features": ["sqrt"],
        "criterion": ["gini"], "min_samples_split": [2, 5, 10], "random_state": [2193]},
    "ExtraTrees": {
        "n_estimators": [100, 500, 1000, 5000, 10000], "max_depth": [5, 10, 50], "max_features": ["sqrt"],
        "criterion": ["gini"], "min_samples_split": [2, 5, 10], "random_state": [2193]},
    "LogisticRegression": {"C_reg": [0.001, 0.01, 1], "penalty": ["l1", "l2"], "random_state": [2193]},
}

# Cutoffs of the evaluation, tag keys that make a node a point of interest, the road
# filter, and the short names of long tag keys.
CUTOFFS = [0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9]
POINT_TAGS = ["amenity", "landuse", "building", "leisure", "natural", "shop", "historic", "tourism",
              "man_made", "bicycle_parking", "cuisine", "power", "office", "aeroway"]
EXCLUDED_AREA = "yes"
EXCLUDED_HIGHWAY = "proposed|construction|abandoned|platform|raceway"
COORDINATE_PATTERN = r"^[-+]?[0-9]*\.?[0-9]+$"
TAG_RENAMES = {
    "addr_country": "country", "addr_housename": "housename", "addr_housenumber": "housenum",
    "addr_postcode": "postcode", "addr_street": "street", "alt_name_en": "name_en",
    "artwork_type": "artwork", "building_levels": "buildlevel", "contact_fax": "fax",
    "contact_phone": "phone", "contact_website": "website", "denomination": "denom",
    "description": "descrip", "description_payment": "payment", "designation": "design",
    "diet_vegetarian": "vegetarian", "drive_through": "drive_thru", "internet_access": "web_access",
    "internet_access_fee": "web_fee", "microbrewery": "micrbrewry", "opening_hours": "open_hrs",
    "osak_municipality_name": "osak_munic", "outdoor_seating": "outseating",
    "social_facility_for": "social", "toilets_wheelchair": "wheelchair",
    "tower_construction": "towerconst", "wheelchair_description": "wheeldesc",
    "communication_antenna": "commantena",
}


def selected_features(switches: dict[str, bool]) -> list[str]:
    """Names whose switch is on, in order."""
    return [name for name, on in switches.items() if on is True]


def split_layers(names: list[str]) -> tuple[list[str], list[str]]:
    """Layer names without and with ``urban`` in them."""
    return [n for n in names if "urban" not in n], [n for n in names if "urban" in n]
