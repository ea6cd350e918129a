"""Payload (JSON-in-string) parsing and dimension normalisation.

One ``from_json`` call parses every payload key the silver layer needs into a
struct of strings; typed values come from ``try_cast`` so a malformed payload
or a bad number yields NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from respawn.constants import PLATFORMS

# Every payload key read by the silver layer (values kept as text, typed later).
PAYLOAD_KEYS = [
    "opponent_id", "killed_by", "weapon", "headshot", "distance_m",
    "experience_granted", "item_id", "item_name", "item_price_usd", "currency",
    "payment_method", "total_kills", "total_deaths", "total_earned_xp",
    "duration_seconds", "items_purchased", "session_token", "ip_country", "reason",
]

PAYLOAD_SCHEMA = StructType([StructField(k, StringType(), True) for k in PAYLOAD_KEYS])


def parse_payload(payload: Column | str = "payload") -> Column:
    """Struct of payload keys; all fields NULL for malformed JSON."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(p, PAYLOAD_SCHEMA, {"mode": "PERMISSIVE"})


def canonical_platform(c: Column | str) -> Column:
    """Case-insensitive lookup onto the canonical platform spelling.

    ``'pc'``, ``' PC '`` -> ``'PC'``; ``'console'`` -> ``'Console'``. Unknown
    values keep their trimmed text (so the ``known_platform`` rule can flag them).
    """
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    names = F.create_map(*(F.lit(x) for p in PLATFORMS for x in (p.lower(), p)))
    return F.coalesce(F.element_at(names, F.lower(c)), c)


def normalize_event_type(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c))
