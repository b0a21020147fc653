"""Figures that must agree with the published definitions.

Everything here is data, not logic.
"""

# Columns of an unlabelled postcode unit, in canonical order.
RAW_FEATURES = (
    "postcode",
    "easting",
    "northing",
    "soilType",
    "elevation",
    "nearestWatercourse",
    "distanceToWatercourse",
    "localAuthority",
)

# Column order of a fully prepared unit table.
PREPARED_UNIT_ORDER = (
    "postcode",
    "postcodeDistrict",
    "postcodeSector",
    "easting",
    "northing",
    "longitude",
    "latitude",
    "soilType",
    "elevation",
    "nearestWatercourse",
    "distanceToWatercourse",
    "localAuthority",
    "riskLabel",
    "medianPrice",
    "historicallyFlooded",
)

# Fill values of the constant imputation method, also the last resort for
# categorical columns in the other methods.
IMPUTATION_CONSTANTS = {
    "soilType": "Unsurveyed/Urban",
    "elevation": 60.0,
    "nearestWatercourse": "Unknown",
    "distanceToWatercourse": 80.0,
    "localAuthority": "Unknown",
}

# Annual probability of flooding per risk class.
CLASS_PROBABILITY = {7: 0.05, 6: 0.03, 5: 0.02, 4: 0.01, 3: 0.005, 2: 0.002, 1: 0.001}

RISK_CLASSES = (1, 2, 3, 4, 5, 6, 7)
HUMAN_RISK_FACTOR = 0.1
ECONOMIC_RISK_FACTOR = 0.05

# Score of predicting class i (row) when the truth is class j (column).
CLASS_SCORES = (
    (100, 60, 30, 0, -30, -600, -1800),
    (80, 100, 90, 60, 30, 0, -600),
    (60, 80, 150, 120, 60, 30, -300),
    (40, 60, 120, 150, 120, 90, 0),
    (0, 45, 90, 120, 150, 900, 1200),
    (-40, 0, 60, 90, 120, 1500, 2000),
    (-60, -20, 30, 60, 90, 1200, 3000),
)

ENGLAND_MEDIAN_PRICE = 245000.0
MINIMUM_RISK_CLASS = 1
HISTORIC_THRESHOLD = 0.4
LONDON_EASTING = 530000.0
LONDON_NORTHING = 180000.0
PALETTE_SIZE = 19
RAINFALL_STATION_NAME = "Rainfall station"
NEAR_WATERCOURSE_METRES = 2000.0
NEAR_WATERCOURSE = "UnknownNearbyWatercourse"
NO_WATERCOURSE = "NoWatercourse"

# Housing-age shares of a district and the two predictors used to fill them.
AGE_SHARES = (
    "pre_1900",
    "1900_1929",
    "1930_1945",
    "1945_1964",
    "1965_1982",
    "1983_1999",
    "2000_present",
    "unknown",
)
AGE_PREDICTORS = ("catsPerHousehold", "dogsPerHousehold")

LEVEL_FIELDS = ("maxOnRecord", "minOnRecord", "typicalRangeHigh", "typicalRangeLow")

# Hourly rainfall classes in millimetres per hour: (upper bound, name).
RAIN_CLASSES = ((2.0, "slight"), (4.0, "moderate"), (50.0, "heavy"))
RAIN_TOP_CLASS = "violent"

# Ellipsoids, projection and datum shift. Lengths in metres, angles in degrees
# unless stated.
AIRY_A = 6377563.396
AIRY_B = 6356256.910
AIRY_SCALE = 0.9996012717
GRS_A = 6378137.0
GRS_B = 6356752.3142
GRS_SCALE = 0.9996
ORIGIN_LAT = 49.0
ORIGIN_LON = -2.0
ORIGIN_EASTING = 400000.0
ORIGIN_NORTHING = -100000.0
AIRY_HEIGHT = 24.7
SHIFT_METRES = (-446.448, 125.157, -542.060)
SHIFT_ARCSEC = (-0.1502, -0.2470, -0.8421)
SHIFT_SCALE = 20.4894e-6
EARTH_RADIUS = 6371009.0

# Marker colour per risk number; any other number is black.
RISK_COLOURS = {
    0: "lightgray",
    1: "green",
    2: "yellow",
    3: "orange",
    4: "red",
    5: "darkred",
    6: "purple",
}
OTHER_RISK_COLOUR = "black"

# Keys and display names of the models of each task.
flood_class_from_postcode_models = {
    "all_minimum_risk": "All minimum risk",
    "seven_class_tool": "Seven Class Probability Model",
}
flood_class_from_location_models = {
    "all_minimum_risk": "All minimum risk",
    "seven_class_tool": "Seven Class Probability Model",
    "knn": "K-Nearest Neighbors",
}
historic_flooding_models = {
    "all_false": "All False",
    "random_classification": "Random Classification",
    "historic_rf": "Random Forest Historic Flood Classifier",
}
house_price_models = {
    "house_prices_xgb": "Boosted Trees House Prices",
    "all_england_median": "All England median price",
}
local_authority_models = {
    "modal_local_authority": "Modal Local Authority",
    "knn": "K-Nearest Neighbors",
}
