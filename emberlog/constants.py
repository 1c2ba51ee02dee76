"""Fixed values of the data contract: domains, bounds, defaults and thresholds.

Everything in this file is a value that results depend on.  No logic lives here.
"""

# --- enumerations of the event contract ------------------------------------
EVENT_TYPES = (
    "combat_damage",
    "heal",
    "player_death",
    "spell_cast",
    "boss_phase",
    "mana_regeneration",
)
PLAYER_ROLES = ("tank", "healer", "dps")
PLAYER_CLASSES = (
    "warrior",
    "paladin",
    "hunter",
    "rogue",
    "priest",
    "shaman",
    "mage",
    "warlock",
    "druid",
    "death_knight",
    "monk",
)
ABILITY_SCHOOLS = (
    "physical",
    "fire",
    "frost",
    "nature",
    "shadow",
    "arcane",
    "holy",
    "chaos",
)
ENTITY_TYPES = ("player", "boss", "add", "interactive")
RESOURCE_TYPES = ("mana", "energy", "rage", "focus", "runic_power")

# --- enumerations of the analytical contracts ------------------------------
RAID_OUTCOMES = ("success", "wipe")
GOLD_ROLES = ("tank", "healer", "dps", "unknown")
DIFFICULTIES = ("Normal", "Heroic", "Mythic")
PLAYER_STYLES = (
    "aggressive_dps",
    "mechanic_dps",
    "utility_dps",
    "tank_healer",
    "raid_healer",
    "rescue_healer",
    "survival_tank",
    "aggressive_tank",
    "unknown",
)

# --- patterns --------------------------------------------------------------
RAID_ID_PATTERN = r"^raid\d{3}$"
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
BATCH_FILE_PATTERN = r"batch_([^/]+?)\.json$"
PLAYER_ID_PREFIX = "player_"

# --- numeric bounds of the event contract: column, lowest, highest ---------
EVENT_BOUNDS = (
    ("encounter_duration_ms", 0, None),
    ("source_player_level", 1, 90),
    ("damage_amount", 0, 1_000_000),
    ("healing_amount", 0, 500_000),
    ("critical_multiplier", 1, 5),
    ("target_entity_health_pct_before", 0, 100),
    ("target_entity_health_pct_after", 0, 100),
    ("resource_amount_before", 0, None),
    ("resource_amount_after", 0, None),
    ("resource_regeneration_rate", 0, None),
    ("server_latency_ms", 0, None),
    ("client_latency_ms", 0, None),
)

# --- string lengths: column, shortest, longest -----------------------------
EVENT_LENGTHS = (
    ("source_player_id", 1, None),
    ("source_player_name", 1, 12),
)

REQUIRED_EVENT_COLUMNS = (
    "event_type",
    "timestamp",
    "raid_id",
    "source_player_id",
    "source_player_name",
)

DEFAULT_SOURCE_SYSTEM = "wow-raid-addon-v1.2"
MAX_EVENTS_PER_BATCH = 10_000
ERRORS_REPORTED_PER_BATCH = 5

# --- thresholds ------------------------------------------------------------
MASSIVE_HIT_DAMAGE = 10_000
OUTCOME_MAX_DURATION_MS = 360_000
OUTCOME_NEAR_KILL_PCT = 10.0
DEFAULT_BOSS_HP_PCT = 100.0
BOSS_PHASE_THRESHOLDS = (70.0, 40.0)
SHARE_TOLERANCE = 0.01

# --- raid dimension placeholders -------------------------------------------
DEFAULT_BOSS_NAME = "Unknown Boss"
DEFAULT_DIFFICULTY = "Normal"
DEFAULT_TARGET_DURATION_MS = 360_000.0

# --- impact score: weights per input, bands from the top -------------------
IMPACT_WEIGHTS = {
    "damage_share": 0.35,
    "healing_share": 0.35,
    "crit_rate": 0.15,
    "player_deaths": -0.10,
}
IMPACT_SCALES = {
    "damage_share": 100.0,
    "healing_share": 100.0,
    "crit_rate": 100.0,
    "player_deaths": 10.0,
}
IMPACT_BANDS = ((80.0, "core"), (60.0, "solid"), (40.0, "average"))
IMPACT_LOWEST_BAND = "low"

# --- dataset checkpoints ---------------------------------------------------
CHECKPOINT_RAIDS = 10
CHECKPOINT_MIN_EVENTS = 490_000
CHECKPOINT_EVENT_TYPE = "combat_damage"
CHECKPOINT_MIN_SHARE = 0.40
CHECKPOINT_MIN_PHASES = 10

# --- class, specialisation, role -------------------------------------------
CLASS_SPEC_ROLES = (
    ("death_knight", "blood", "tank"),
    ("death_knight", "frost", "dps"),
    ("death_knight", "unholy", "dps"),
    ("druid", "balance", "dps"),
    ("druid", "feral", "dps"),
    ("druid", "guardian", "tank"),
    ("druid", "restoration", "healer"),
    ("hunter", "beast_mastery", "dps"),
    ("hunter", "marksmanship", "dps"),
    ("hunter", "survival", "dps"),
    ("mage", "arcane", "dps"),
    ("mage", "fire", "dps"),
    ("mage", "frost", "dps"),
    ("monk", "brewmaster", "tank"),
    ("monk", "mistweaver", "healer"),
    ("monk", "windwalker", "dps"),
    ("paladin", "holy", "healer"),
    ("paladin", "protection", "tank"),
    ("paladin", "retribution", "dps"),
    ("priest", "discipline", "healer"),
    ("priest", "holy", "healer"),
    ("priest", "shadow", "dps"),
    ("rogue", "assassination", "dps"),
    ("rogue", "combat", "dps"),
    ("rogue", "subtlety", "dps"),
    ("shaman", "elemental", "dps"),
    ("shaman", "enhancement", "dps"),
    ("shaman", "restoration", "healer"),
    ("warlock", "affliction", "dps"),
    ("warlock", "demonology", "dps"),
    ("warlock", "destruction", "dps"),
    ("warrior", "arms", "dps"),
    ("warrior", "fury", "dps"),
    ("warrior", "protection", "tank"),
)

# --- snake_case column names and their squashed legacy spelling ------------
LEGACY_NAMES = {
    "raid_id": "raidid",
    "event_date": "eventdate",
    "event_type": "eventtype",
    "source_player_id": "sourceplayerid",
    "source_player_name": "sourceplayername",
    "source_player_class": "sourceplayerclass",
    "source_player_role": "sourceplayerrole",
    "damage_amount": "damageamount",
    "healing_amount": "healingamount",
    "target_entity_type": "targetentitytype",
    "target_entity_id": "targetentityid",
    "target_entity_health_pct_after": "targetentityhealthpctafter",
    "is_critical_hit": "iscriticalhit",
}


# Every white space character, as text trimming understands it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
