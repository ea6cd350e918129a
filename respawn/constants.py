"""Domain constants.

FIXED VALUES — these must equal the telemetry contract the engine mirrors
(event vocabulary, dimension domains, thresholds). Listed plainly, in the
natural order of the source contract.
"""

# Event vocabulary and dimension domains (fixed values).
EVENT_TYPES = ["login", "kill", "death", "purchase", "session_end", "logout"]
GAME_MODES = ["deathmatch", "capture_flag", "ranked", "casual"]
REGIONS = ["NA", "EU", "APAC", "LATAM"]
PLATFORMS = ["PC", "Console", "Mobile"]
WEAPONS = ["sniper_rifle", "assault_rifle", "shotgun", "pistol", "rocket_launcher"]
SKINS = ["dragon_blue", "neon_pink", "gold_warrior", "shadow_assassin", "fire_phoenix"]
PAYMENT_METHODS = ["credit_card", "paypal", "google_play", "apple_pay"]
LOGOUT_REASONS = ["user_quit", "timeout", "connection_lost"]

# Thresholds (fixed values).
CHURN_DAYS = 7                     # no login for >= 7 days -> churned
NEW_PLAYER_DAYS = 30               # first seen < 30 days ago -> new
PREMIUM_TIERS = [                  # total_spend_90d lower bounds, checked in order
    ("platinum", 250.0, ">="),
    ("gold", 100.0, ">="),
    ("silver", 50.0, ">="),
    ("bronze", 0.0, ">"),
]
PREMIUM_TIER_ELSE = "free"
WHALE_SPEND_90D = 250.0
ENGAGEMENT_LAPSED_DAYS = 14
ENGAGEMENT_CORE_LOGINS = 5
ENGAGEMENT_REGULAR_LOGINS = 2
REVENUE_WHALE_30D = 100.0
REVENUE_SPENDER_30D = 20.0
RISK_HIGH = 0.75
RISK_MEDIUM = 0.40

# Model defaults (fixed values).
FEATURE_COLUMNS = [
    "days_since_login",
    "login_count_7d",
    "login_count_30d",
    "avg_session_duration_7d",
    "total_playtime_7d",
    "kill_count_7d",
    "match_count_7d",
    "win_rate_7d",
    "avg_spend_7d",
    "avg_spend_30d",
    "total_spend_30d",
]
CATEGORICAL_COLUMNS = ["platform_primary", "region_primary"]
RF_MAX_DEPTH = 8
RF_NUM_TREES = 80
LR_MAX_ITER = 50
SPLIT_SEED = 42
TRAIN_FRACTION = 0.7

# Raw bronze envelope column order.
RAW_COLUMNS = [
    "event_id", "player_id", "event_type", "timestamp", "game_mode",
    "region", "platform", "payload", "ingest_ts", "ingest_date",
]

# Generator domains (fixed values).
ITEM_PRICES_USD = ["4.99", "9.99", "19.99", "29.99"]
GENERATOR_PLAYERS = 10_000
GENERATOR_DAYS = 30

# Days that an event can plausibly have happened on; calendars and histories are made of no others (100 years at most).
PLAUSIBLE_DAYS = ("2000-01-01", "2099-12-31")
