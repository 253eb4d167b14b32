"""Fixed values the results depend on, stated once.

Everything below is a domain constant (limits, code lists, names, physical
units).  Operators take them as defaults, so another study can pass its own.
"""

# Raw reading columns and their clean names.
RAW_COLUMN_NAMES = {
    "AirQualityStationEoICode": "station_id",
    "AirPollutant": "pollutant",
    "Start": "timestamp_start",
    "End": "timestamp_end",
    "Value": "value",
    "Validity": "validity",
    "Verification": "verification",
}

# Highest credible value per pollutant in ug/m3.
POLLUTANT_BOUNDS = {"PM2.5": 900.0, "PM10": 1500.0, "NO2": 1000.0, "O3": 400.0, "SO2": 2000.0}

# Column prefix per pollutant, in output order.
POLLUTANT_SLUGS = {"PM2.5": "pm25", "PM10": "pm10", "NO2": "no2", "O3": "o3", "SO2": "so2"}

# Verification levels, best first.
VERIFICATION_LEVELS = ("E1a", "E2a")
MIN_VALIDITY = 1

# PM2.5 limits in ug/m3.
EU_DAILY_LIMIT = 25.0
WHO_DAILY_GUIDELINE = 15.0
WHO_ANNUAL_GUIDELINE = 5.0

# Columns that get lags and rolling means, and how far.
FEATURE_POLLUTANTS = ["pm25_mean", "pm10_mean", "no2_mean", "o3_mean", "so2_mean"]
FEATURE_WEATHER = [
    "temp_2m", "wind_speed", "surface_pressure",
    "precipitation", "boundary_layer_height", "low_blh_flag",
]
ROLLING_COLUMNS = FEATURE_POLLUTANTS + ["boundary_layer_height", "temp_2m"]
LAG_DAYS = [1, 2, 7]
ROLLING_DAYS = [7, 14]

# Weather grid.
GRID_STEP = 0.25
GRID_VARIABLES = ["t2m", "u10", "v10", "sp", "tp", "blh"]
LOW_BLH_METRES = 500.0
EUROPE_BOX = {"north": 72.0, "west": -25.0, "south": 34.0, "east": 45.0}

# ICD-10 ranges of interest; the first of each list is the whole chapter.
RESPIRATORY_CODES = ["J00-J99", "J40-J47", "J09-J18"]
CIRCULATORY_CODES = ["I00-I99", "I20-I25", "I60-I69"]

# WHO mortality database country codes.
WHO_COUNTRIES = {"4130": "NO", "4190": "CH", "4210": "TR", "4070": "UA", "4150": "RS"}

# Countries in scope.
COUNTRY_NAMES = {
    "FR": "France", "ES": "Spain", "BE": "Belgium", "NL": "Netherlands", "DE": "Germany",
}

# Raw landing contract.
REQUIRED_READING_COLUMNS = list(RAW_COLUMN_NAMES)
MIN_READING_BYTES = 100_000
MIN_GRID_BYTES = 1_000_000

# Features of the baseline classifier.
BASELINE_FEATURES = [
    "pm25_mean", "pm25_mean_lag1", "pm25_mean_lag2", "pm25_mean_lag7", "pm25_mean_rolling7d",
    "boundary_layer_height", "wind_speed", "temp_2m", "heating_season", "month",
]

# Expected feature-store columns and type families.
EXPECTED_TYPES = {
    "station_id": "string", "country_code": "string", "date": "date",
    "year": "int", "month": "int", "day_of_week": "int",
    "season": "string", "is_weekend": "int", "heating_season": "int",
    "pm25_mean": "float", "pm10_mean": "float", "no2_mean": "float",
    "o3_mean": "float", "so2_mean": "float",
    "temp_2m": "float", "wind_speed": "float", "surface_pressure": "float",
    "precipitation": "float", "boundary_layer_height": "float", "low_blh_flag": "int",
    "pm25_exceedance_t1": "int", "pm25_exceedance_t2": "int",
    "weekly_deaths": "float", "nuts3_code": "string", "week_of_year": "int",
}
