"""Fixed values that results depend on, in one place."""

# The type in which means are taken that must not depend on the order of rows.
EXACT = "decimal(28,15)"

# Centres of municipalities, (lat, lon).
MUNICIPAL_CENTRES = [
    (18.4655, -66.1057), (18.0099, -66.6140), (18.4279, -66.7177), (18.4906, -67.1414), (18.3990, -65.9732),
    (18.3449, -66.0498), (18.3804, -65.8754), (18.2218, -66.0370), (18.0791, -66.5293), (18.2499, -65.8960),
    (18.4735, -66.9008), (18.1466, -65.9965), (18.3660, -66.4696), (18.2302, -66.3068), (18.4562, -66.5551),
    (18.1306, -66.7327), (18.4284, -66.1617), (18.4014, -66.2956), (18.4449, -66.6188), (18.3002, -65.6340),
    (18.2833, -65.9000), (18.4667, -65.8333), (18.4000, -65.8833), (18.3606, -65.6268), (18.2333, -65.8167),
    (18.2799, -65.7760), (18.1167, -65.8833), (18.1833, -65.7000), (18.2500, -65.8833), (18.3167, -65.8333),
    (18.4500, -65.9833), (18.2267, -65.9702), (18.3333, -65.7333), (18.4667, -66.1167), (18.4167, -66.2500),
    (18.4500, -66.3333), (18.4167, -66.4833), (18.4800, -66.7167), (18.4667, -67.0333), (18.5333, -67.0833),
    (18.4000, -66.7500), (18.3571, -67.1792), (18.3333, -66.8667), (18.3011, -66.6942), (18.3614, -66.9291),
    (18.3005, -66.9217), (18.2833, -66.4833), (18.2500, -66.3333), (18.1833, -66.2833), (18.2000, -66.0333),
    (18.3333, -65.9833), (18.2000, -66.4833), (18.1417, -66.8783), (18.0500, -66.8167), (18.0833, -67.1500),
    (18.0167, -66.8667), (17.9966, -66.6143), (18.0272, -66.3612), (17.9667, -66.3833), (18.0500, -66.1281),
    (17.9999, -66.1000), (18.1167, -66.3833),
]

# Reservoirs, (lat, lon), and how near in degrees counts.
WATER = [
    (18.3517, -66.3200), (18.3333, -66.7167), (18.3667, -65.9833), (18.1167, -66.5333), (18.0500, -66.5667),
    (18.1667, -66.2167), (18.2667, -65.7833), (18.1333, -66.4167), (18.3300, -65.9700), (18.4300, -66.8500),
    (18.3833, -65.9667), (18.1000, -66.4667), (18.0167, -66.2667), (18.3167, -66.5833),
]
WATER_DEGREES = 0.08

# Points of transmission corridors, (lat, lon), and how near in degrees counts.
UTILITY = [
    (18.4373, -66.0018), (18.2600, -66.3000), (18.0083, -66.5632), (18.3700, -66.5500), (18.4948, -67.1294),
    (18.4000, -66.8500), (18.4800, -66.4500), (18.4667, -66.7167), (18.1100, -66.5400), (18.0083, -66.7000),
]
UTILITY_DEGREES = 0.05

# Towns as (min lon, min lat, max lon, max lat), and the box outside which no class is given.
TOWNS = [(-66.20, 18.35, -65.90, 18.50), (-66.68, 17.95, -66.52, 18.07), (-67.20, 18.18, -67.08, 18.28)]
REGION = (-67.30, 17.80, -65.50, 18.60)

# Airport codes that anchor a public record.
AIRPORTS = ["SJU", "BQN", "PSE", "SIG", "NRR", "MAZ", "ARE", "CPX", "VQS"]

# Confidence from which a tier is given, and the tolerance of positional duplicates.
TIER_1, TIER_2, REJECTED = 0.65, 0.40, 0.25
DUPLICATE_DEGREES = 0.00045

# Weights of a place's confidence, and the class weights for nearness to a municipality.
PLACE_WEIGHTS = {"recurrence": 0.30, "loiter": 0.25, "alignment": 0.20, "water": 0.15, "nearness": 0.10}

# What combinations of signals may support, the order of the fallbacks, and the weakest tier.
SIGNAL_SETS = [
    (("sar_amplitude_change",), "radar_change_candidate"),
    (("coherence_loss",), "surface_decorrelation_candidate"),
    (("sar_amplitude_change", "optical_change"), "corroborated_surface_change_candidate"),
    (("coherence_loss", "optical_change"), "corroborated_surface_change_candidate"),
    (("sar_amplitude_change", "optical_change", "terrain_morphology"), "high_confidence_disturbance"),
    (("coherence_loss", "optical_change", "terrain_morphology"), "high_confidence_disturbance"),
    (("multi_epoch_lidar_elevation",), "measured_elevation_or_volume_change"),
    (("field_or_authoritative_record",), "confirmed_classified_event"),
]
SIGNAL_FALLBACK = [
    ("field_or_authoritative_record", "confirmed_classified_event"),
    ("multi_epoch_lidar_elevation", "measured_elevation_or_volume_change"),
    ("sar_amplitude_change", "radar_change_candidate"),
]
SIGNAL_WEAKEST = "surface_decorrelation_candidate"
FIELD_SIGNAL = "field_or_authoritative_record"

# The state that each decision leads to; hold keeps the state.
DECISIONS = {"confirm": "confirmed", "reject": "rejected", "promote": "supported_candidate", "downgrade": "candidate"}

# Tiers of evidence from the weakest on, bases that only discover, and bases that only describe shape.
TIERS = ["UNRESOLVED", "CANDIDATE", "SUPPORTING", "DIRECT", "CONTRADICTED"]
DISCOVERY_BASES = [
    "proximity_only", "nearest_only", "name_only", "normalized_name_only", "same_category", "same_system", "source_absence", "shared_provenance",
    "equal_count", "normalized_coordinates", "graph_reachability", "contract_record", "funding_record", "screenshot_annotation",
]
SHAPE_BASES = ["morphology", "depression_shape", "terrain_derivative", "bathymetric_anomaly", "discovery_score", "hillshade_interpretation", "acoustic_reflector", "backscatter_texture"]

# The ellipsoid of 1984.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563

# Weights, caps and shares of scores; fixed values.
TILE_WEIGHTS = {"water": 0.6, "coast": 0.8}
RANK_WEIGHTS = {"best": 0.5, "risk": 0.3, "nodes": 0.2}
#: Kind of evidence: the most that it adds to a cell's score, its weight, and whether it counts as it is (or by logarithm).
ZONE_CAPS = {
    "cave": (3.0, 3.0, True),
    "groundwater": (2.5, 0.75, False),
    "mine": (2.0, 0.9, False),
    "industrial": (0.75, 0.25, False),
    "utility": (0.5, 0.08, False),
    "history": (0.25, 0.05, False),
}
MISSION_WEIGHTS = {
    "corridor_alignment": 0.20,
    "infrastructure_proximity": 0.18,
    "altitude_profile": 0.15,
    "hover_behavior": 0.12,
    "operator_identity": 0.10,
    "repeat_frequency": 0.08,
    "time_pattern": 0.08,
    "speed_profile": 0.06,
    "duration_profile": 0.03,
}

# Names of the rungs 0 to 4, kinds of evidence that prove identity, bases that only suggest one, bands of confidence.
RUNGS = ["ANOMALY", "FEATURE", "OPENING", "PASSAGE", "CONNECTION"]
IDENTITY_EVIDENCE = ["STABLE_SOURCE_ID", "EXPLICIT_PROVIDER_CROSSWALK", "AUTHORITATIVE_LINEAGE", "EXACT_SOURCE_GEOMETRY_KEY"]
HEURISTIC_BASES = ["proximity_only", "nearest_only", "name_only", "normalized_name_only", "same_category", "source_absence"]
CONFIDENCE_BANDS = [(85, "high_confidence_change"), (70, "corroborated_change"), (50, "supported_candidate"), (30, "candidate")]
CONFIDENCE_LEAST = "weak_signal"

# Flags that keep a shape from more than a candidate, and the weights of a depression's score.
WEAK_SHAPES = ["SEAM_OVERLAP", "MOSTLY_INTERPOLATED", "BELOW_UNCERTAINTY", "UNCERTAINTY_UNKNOWN"]
#: Measure: what counts as full, points for a full one.
DEPRESSION_WEIGHTS = {"significance": (10.0, 35.0), "depth_to_diameter": (0.3, 25.0), "circularity": (1.0, 15.0), "wall_slope": (35.0, 10.0)}
DEPRESSION_INNER = 15.0

# Changes that coarse images can show, and from which resolution on images are coarse.
COARSE_CHANGES = ["EXPANSION", "CONTRACTION", "SURFACE_COVER_CHANGE"]
COARSE_ABOVE_M = 5.0

# Corridors as (name, (lon, lat, lon, lat), width in nautical miles).
CORRIDORS = [
    ("PREPA_SOUTH", (-67.2, 18.0, -65.3, 18.0), 5.0),
    ("MONA_PATROL", (-67.8, 18.5, -67.0, 18.5), 15.0),
    ("CENTRAL_GRID", (-66.5, 18.5, -66.0, 18.0), 8.0),
]
