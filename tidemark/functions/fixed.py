"""Fixed values of the domain: column names, labels, codes, regions and default settings."""

from __future__ import annotations

from dataclasses import dataclass

# The 25 coded fishing columns, in their published order.
FISHING = """recreational_fishing commercial_fishing artisanal_fishing subsistence_fishing bottom_trawling
pelagic_trawling hook_and_line trolling longlining nets purse_seine_rndhaul_surrd_nets gillnetting
gillnets_entangling_nets trammel_nets dip_scoop_nets cast_nets drift_nets other_nets dredges traps_and_pots
spear_fishing underwater_extraction_diving hand_capture fish_aggregating_devices misc_gear""".split()

# The 18 coded activity columns, in their published order.
ACTIVITY = """discharge speed entry diving removal_of_historic_artifacts stopping anchoring mooring dragging
landing dredging dredging_dumping industr_or_mineral_exploration drilling non_fishing_industr_extraction
aquaculture construction overflight_or_drones""".split()

CODED = FISHING + ACTIVITY

# Levels from the strictest on (the rank is the place), and the level of each code.
LEVELS = ["prohibited", "restricted", "allowed", "unknown", "na"]
CODES = {0: "allowed", 1: "prohibited", 2: "restricted", 3: "unknown"}

# Category labels in order of their ids from 1.
CATEGORIES = [
    "Marine Protected Area",
    "Other Effective Area-Based Conservation Area",
    "Fisheries Management Area",
    "Water Quality/Human Health Area",
    "Recreational Area",
    "Vessel Restricted Area",
    "Vessel Reporting Area",
    "Voluntary Conservation Measure Area",
    "Jurisdictional Authority Area",
    "Other",
    "To Be Determined",
]

# Coarse activities and the columns whose strictest level they take.
COARSE = {
    "anchoring": ["anchoring"],
    "mooring": ["mooring"],
    "entry": ["entry"],
    "speed": ["speed"],
    "diving": ["diving"],
    "discharge": ["discharge"],
    "dredging": ["dredging", "dredging_dumping"],
    "removalOfArtifacts": ["removal_of_historic_artifacts"],
    "fishingRecreational": ["recreational_fishing"],
    "fishingCommercial": ["commercial_fishing"],
    "fishingArtisanal": ["artisanal_fishing", "subsistence_fishing"],
    "fishing": FISHING,
}

# Regions in order of precedence, as (name, west, south, east, north).
REGIONS = [
    ("southern-ocean", -180, -90, 180, -50),
    ("mediterranean", -10, 30, 42, 48),
    ("caribbean", -100, 5, -55, 30),
    ("north-europe", -15, 48, 100, 90),
    ("nw-pacific", 100, -10, 180, 90),
    ("sw-pacific", 120, -50, 180, 10),
    ("sw-pacific", -180, -50, -120, 10),
    ("ne-pacific", -180, 10, -100, 90),
    ("se-pacific", -120, -50, -60, 10),
    ("south-atlantic", -70, -50, 20, 10),
    ("nw-atlantic", -100, 10, -30, 90),
    ("ne-atlantic", -30, 10, 15, 90),
    ("indian-ocean", 20, -50, 120, 48),
]
ANTIMERIDIAN, ELSEWHERE = "sw-pacific", "other"

HIGH_SEAS = "High Seas / International"

# Names of the second source that differ, those it alone has, and those it lacks.
RENAMED = {"total_marine_area": "marine_area", "percent_marine_area": "percent_marine", "location_type": "site_location", "tribal_exemptions": "tribal"}
API_ONLY = ["ogc_fid", "regulation_type", "latest_updates", "last_update", "bounds", "site_boundary", "type", "resType"]
DOWNLOAD_ONLY = ["OBJECTID", "other_helpful_links", "version_start_date", "version_end_date", "change_type_legal", "change_type_gis", "coastline_match", "Shape_Length", "Shape_Area"]
NUMERIC = ["lfp", "tribal", "subzone", "site_major_version", "site_minor_version", "modification_level", "total_area", "marine_area", "percent_marine", "site_location", "year_est", *CODED]

# Text columns of a feature that the decoder reads.
IDENTITY = """site_name country state managing_authority designation category_name wdpa_id iucn_cat lfp tribal
purpose restrictions allowed url regulation_source other_helpful_links season effective_from effective_to
site_major_version site_minor_version marine_area""".split()


@dataclass(frozen=True)
class Config:
    """Settings of a build."""

    exclude_categories: tuple[int, ...] = (9,)
    exclude_partitions: tuple[str, ...] = ("HighSeas",)
    max_area_km2: float = 50000.0
    max_span_deg: float = 90.0
    hard_bans: tuple[str, ...] = ("entry", "anchoring")
    tolerance_deg: float = 0.0005
    decimals: int = 5
    baseline_days: int = 60
    census_days: int = 30


DEFAULT = Config()
