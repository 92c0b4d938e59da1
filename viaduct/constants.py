"""Fixed values of the domain: numbers, codes, keys and column names that must be as they are for right results."""

# Radii, factors, limits and speeds; route types of rail; spellings of no value; days; columns of gold.
EARTH_RADIUS_M = 6_371_000.0
DETOUR = 1.3
RAIL_TYPES = (2, 100, 101, 102, 103, 104, 105, 106, 107, 108, 109, 110, 111, 112, 113, 114, 116, 117)
EXPIRED_BEFORE = 20240101
CITY_CELL_DEG = 0.5
CITY_RADIUS_M = 15_000.0
AIRPORT_RADIUS_M = 100_000.0
MIN_FLIGHT_KM = 10.0
RAIL_SPEED_KMH = 90.0
FLIGHT_SPEED_KMH = 700.0
FLIGHT_GROUND_MIN = 75.0
ACCESS_SPEED_KMH = 40.0

# Energy use by route type (kWh per passenger km), and the type for which diesel plays no part.
EMISSION_ROUTE_TYPES = (2, 100, 101, 102, 103, 105, 106, 109)
ENERGY_USE = {2: 0.050, 100: 0.040, 101: 0.050, 102: 0.040, 103: 0.040, 105: 0.090, 106: 0.080, 109: 0.080}
ENERGY_USE_ELSE = 0.05
ELECTRIC_TYPES = (100, 101, 102, 103, 105)
DIESEL_G_PKM = 65.0
# Share of electrified track by country.
ELECTRIFIED = {
    "CH": 1.00, "LI": 1.00, "BE": 0.88, "SE": 0.75, "NL": 0.74, "AT": 0.73, "IT": 0.72, "VA": 0.72, "PL": 0.64, "ES": 0.64,
    "AD": 0.64, "DE": 0.61, "FR": 0.60, "MC": 0.60, "GB": 0.38, "DK": 0.30, "IE": 0.03, "BA": 0.70, "BG": 0.74, "HR": 0.37,
    "CZ": 0.34, "FI": 0.55, "GR": 0.20, "HU": 0.41, "NO": 0.65, "PT": 0.65, "RO": 0.37, "SK": 0.44, "SI": 0.50,
}
# Time zone by country.
ZONES = {
    "FR": "Europe/Paris", "DE": "Europe/Berlin", "AT": "Europe/Vienna", "CH": "Europe/Zurich", "IT": "Europe/Rome",
    "ES": "Europe/Madrid", "NL": "Europe/Amsterdam", "BE": "Europe/Brussels", "CZ": "Europe/Prague", "PL": "Europe/Warsaw",
    "HU": "Europe/Budapest", "SK": "Europe/Bratislava", "SI": "Europe/Ljubljana", "HR": "Europe/Zagreb", "RS": "Europe/Belgrade",
    "RO": "Europe/Bucharest", "BG": "Europe/Sofia", "GR": "Europe/Athens", "SE": "Europe/Stockholm", "NO": "Europe/Oslo",
    "FI": "Europe/Helsinki", "DK": "Europe/Copenhagen", "EE": "Europe/Tallinn", "LT": "Europe/Vilnius", "LV": "Europe/Riga",
    "PT": "Europe/Lisbon", "IE": "Europe/Dublin", "GB": "Europe/London", "TR": "Europe/Istanbul", "UA": "Europe/Kyiv",
    "MD": "Europe/Chisinau", "MK": "Europe/Skopje", "ME": "Europe/Podgorica", "AL": "Europe/Tirane", "LU": "Europe/Luxembourg",
}
# Alpha-3 to alpha-2 codes of European and neighbouring countries (others stay as they are), and the
# neighbour whose grid value a micro-state takes.
ISO2 = {
    "FRA": "FR", "DEU": "DE", "CHE": "CH", "ITA": "IT", "ESP": "ES", "AUT": "AT", "BEL": "BE", "NLD": "NL", "POL": "PL",
    "GBR": "GB", "SWE": "SE", "DNK": "DK", "IRL": "IE", "BIH": "BA", "BGR": "BG", "HRV": "HR", "CZE": "CZ", "FIN": "FI",
    "GRC": "GR", "HUN": "HU", "NOR": "NO", "PRT": "PT", "ROU": "RO", "SVK": "SK", "SVN": "SI", "LUX": "LU", "EST": "EE",
    "LVA": "LV", "LTU": "LT", "CYP": "CY", "MLT": "MT", "ISL": "IS", "SRB": "RS", "MNE": "ME", "MKD": "MK", "MDA": "MD",
    "UKR": "UA", "BLR": "BY", "RUS": "RU", "ALB": "AL", "GEO": "GE", "AZE": "AZ", "TUR": "TR", "ARM": "AM", "XKX": "XK",
    "SMR": "SM", "AND": "AD",
}
# Names of countries.
COUNTRY_NAMES = {
    "FR": "France", "DE": "Germany", "CH": "Switzerland", "IT": "Italy", "ES": "Spain", "AT": "Austria", "BE": "Belgium",
    "NL": "Netherlands", "PL": "Poland", "GB": "United Kingdom", "SE": "Sweden", "DK": "Denmark", "IE": "Ireland",
    "CZ": "Czechia", "FI": "Finland", "GR": "Greece", "HU": "Hungary", "NO": "Norway", "PT": "Portugal", "RO": "Romania",
    "SK": "Slovakia", "SI": "Slovenia", "HR": "Croatia", "BG": "Bulgaria", "LU": "Luxembourg", "EE": "Estonia",
    "LV": "Latvia", "LT": "Lithuania", "RS": "Serbia", "TR": "Türkiye", "UA": "Ukraine",
}
MICRO_STATES = {"MC": "FR", "VA": "IT", "LI": "CH"}
MICRO_CODES = ("MCO", "VAT", "LIE", "AND")
# Countries whose airports count, and the box that Russian ones must lie in (latitudes, longitudes).
AIR_COUNTRIES = (
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL",
    "PL", "PT", "RO", "SK", "SI", "ES", "SE", "CH", "GB", "NO", "IS", "RS", "BA", "ME", "MK", "MD", "UA", "BY", "RU", "AL",
    "GE", "AZ", "TR", "AM",
)
EUROPE_BOX = (35.0, 71.0, -25.0, 45.0)
# Flight classes with their blends of base factors (seat class, distance class).
AIR_BLENDS = {
    "small_small_1000km": (100, {"small_short": 0.7, "medium_short": 0.3}),
    "small_medium_1000km": (101, {"small_short": 0.5, "medium_short": 0.5}),
    "small_large_1000km": (102, {"small_short": 0.4, "medium_short": 0.6}),
    "medium_medium_5000km": (103, {"small_medium": 0.2, "medium_medium": 0.6, "large_medium": 0.2}),
    "medium_large_unlimited": (104, {"small_medium": 0.1, "medium_long": 0.5, "large_long": 0.4}),
    "large_medium_5000km": (105, {"small_medium": 0.1, "medium_medium": 0.4, "large_medium": 0.5}),
    "large_large_unlimited": (106, {"small_medium": 0.1, "medium_long": 0.3, "large_long": 0.6}),
}
# Words of the labels of flights, by token of the flight class; other distances are long haul.
AIRPORT_LABELS = {"small": "Small airport", "medium": "Medium airport", "large": "Large airport"}
HAUL_LABELS = {"1000km": "Short haul"}
HAUL_ELSE = "Long haul"
# The countries that have a partition of the gold tables of their own.
GOLD_COUNTRIES = tuple(ELECTRIFIED)
OTHER_COUNTRY = "XX"
BLANKS = ("", "---/---", "-/-")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
GOLD_COLUMNS = (
    "source", "trip_id", "mode", "destination", "trip_short_name", "agency_name", "agency_timezone", "service_id", "route_id",
    "route_type", "route_short_name", "route_long_name", "departure_station", "departure_city", "departure_country",
    "departure_time", "departure_parent_station", "arrival_station", "arrival_city", "arrival_country", "arrival_time",
    "arrival_parent_station", "service_start_date", "service_end_date", "days_of_week", "is_night_train", "distance_km",
    "co2_per_pkm", "emissions_co2",
)
