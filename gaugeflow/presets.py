"""Fixed values that results depend on: thresholds, labels, hour ranges, names.

Every operator takes these as parameters; the presets are only defaults.
"""

from __future__ import annotations

# --- fixed values: raw sensor header -> safe column name ---
SENSOR_RENAMES = {
    "CO(GT)": "CO_GT",
    "PT08.S1(CO)": "PT08_S1_CO",
    "NMHC(GT)": "NMHC_GT",
    "C6H6(GT)": "C6H6_GT",
    "PT08.S2(NMHC)": "PT08_S2_NMHC",
    "NOx(GT)": "NOx_GT",
    "PT08.S3(NOx)": "PT08_S3_NOx",
    "NO2(GT)": "NO2_GT",
    "PT08.S4(NO2)": "PT08_S4_NO2",
    "PT08.S5(O3)": "PT08_S5_O3",
}
SENSOR_NUMERIC = [*SENSOR_RENAMES.values(), "T", "RH", "AH"]
SENTINEL = -200.0
SPARSE_THRESHOLD = 0.40

# --- fixed values: rush-hour ranges, inclusive on both ends (three competing definitions) ---
RUSH_PIPELINE = [(7, 9), (17, 19)]
RUSH_SERVICE = [(8, 10), (17, 19)]
RUSH_PANEL = [(7, 9), (17, 19)]

# --- fixed values: pollutant thresholds and weights of the health score ---
POLLUTANT_THRESHOLDS = {"co": 4000.0, "no2": 200.0, "pm25": 75.0, "pm10": 150.0, "o3": 240.0}
HEALTH_WEIGHTS = {"pm25": 0.4, "pm10": 0.2, "no2": 0.2, "o3": 0.1, "co": 0.1}

# --- fixed values: defaults for absent reading fields ---
READING_DEFAULTS = {
    "co_ugm3": 0.0,
    "no2_ugm3": 0.0,
    "temperature": 20.0,
    "humidity": 50.0,
    "hour": 12,
    "aqi": 0.0,
    "pm2_5": 0.0,
    "pm10": 0.0,
    "o3": 0.0,
}

# --- fixed values: label ladders ---
HEALTH_EDGES = [20.0, 40.0, 60.0, 80.0]
HEALTH_LABELS = ["Good", "Moderate", "Unhealthy", "Very Unhealthy", "Hazardous"]
AQI_EDGES = [20.0, 40.0, 60.0, 80.0, 100.0]
AQI_LABELS = ["Good", "Fair", "Moderate", "Poor", "Very Poor", "Extremely Poor"]
RULE_HEALTH_EDGES = [20.0, 50.0, 80.0]
RULE_HEALTH_LABELS = ["Good", "Moderate", "Unhealthy", "Hazardous"]
SEVERITY_LABELS = ["good", "moderate", "unhealthy", "very-unhealthy", "hazardous"]
CLUSTER_NAMES = {0: "Clean", 1: "Moderate", 2: "High", 3: "Severe"}
CLUSTER_EMOJIS = {"Clean": "🌿", "Moderate": "🔵", "High": "🟠", "Severe": "🔴"}
CLUSTER_EMOJI_DEFAULT = "🔘"
RULE_CLUSTER_EDGES = [40.0, 80.0]
RULE_CLUSTER_LABELS = [
    "🌿 Cluster 0 — Clean Air",
    "🚗 Cluster 1 — Traffic",
    "🏭 Cluster 2 — Heavy Pollution",
]
RUSH_LABELS = ("Rush Hour", "Off-Peak")
RUSH_PANEL_LABELS = ("Active Rush Hour", "No Rush Hour")
CO_MODEL_LABELS = ("HIGH CO Risk", "LOW CO Risk")
CO_RULE_LABELS = ("High CO Level", "Normal CO")
CO_RULE_LIMIT = 1000.0
BENZENE_RULE_FACTOR = 0.003

# --- fixed values: proxies of the scoring service (raw CO stands in for a sensor response) ---
CO_TO_MG = 1000.0
NOX_PER_NO2 = 1.3
NMHC_PER_CO = 0.5

# --- fixed values: text patterns ---
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]+"
PHONE_PATTERN = r"\d{10}"
NAME_PATTERN = r"Name:\s(\w+)"
