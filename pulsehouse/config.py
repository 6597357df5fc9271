"""Thresholds and names of the warehouse.

Every operator takes these as keyword defaults, so a caller can change
any of them; the defaults below are the behaviour the warehouse is
specified to have.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must stay equal to the specified behaviour, or results
# change. Kept together and in their natural order.
# ---------------------------------------------------------------------------

# The 13 event types of the behaviour stream.
EVENT_TYPES = (
    "app_open",
    "enter_item",
    "leave_item",
    "like",
    "fav",
    "share",
    "comment",
    "follow",
    "unfollow",
    "dm",
    "enter_profile",
    "click_tag",
    "dislike",
)

# Interactions counted by the interaction-rate metrics.
INTERACTION_TYPES = ("like", "fav", "share", "comment")

# Category given to events whose item is missing or not in the dimension.
UNKNOWN_CATEGORY = "Unknown"
# content_len given to events whose item is not in the dimension.
UNKNOWN_CONTENT_LEN = 0

# A1 comment flooding, keyed (user_id, item_id).
A1_MIN_COMMENTS = 5          # consecutive comments needed
A1_MAX_GAP_MS = 10_000       # largest gap between neighbouring comments
A1_WINDOW_MS = 60_000        # look-back kept for a comment
A1_DUP_TEXT = 4              # same text this often also satisfies the window clause

# A2 like storm, keyed user_id.
A2_WINDOW_MS = 5_000         # look-back, inclusive
A2_MIN_ITEMS = 15            # distinct items liked inside the look-back

# Watermarks.
DETECTOR_WATERMARK = "30 minutes"
METRIC_WATERMARK = "5 minutes"

# Tumbling windows of the serving metrics.
WINDOW_5M = "5 minutes"
WINDOW_30M = "30 minutes"

# Behaviour tags on leave_item (duration in seconds).
D1_MIN_SEC, D1_MAX_SEC = 0.2, 1.2            # instant exit, both ends inclusive
E1_MAX_SEC, E1_MIN_CONTENT_LEN = 0.8, 2000   # over-fast swipe, both strict
C_MIN_SEC, C_MAX_SEC = 1800.0, 3600.0        # very long stay, both ends inclusive

# Sessions derived from raw events: idle longer than this starts a new one.
SESSION_GAP_SEC = 1800

# Key-value serving rows.
KV_PREFIX = "dws:user_activity"
KV_TTL_SEC = 3600
KV_NULL_VALUE = "0"
KV_GROUP_COLUMNS = ("window", "category", "session_id")

# Names under which results are visible to SQL users.
RESULT_VIEWS = {
    "cheat_a1_result": "dwd/cheat_a1",
    "cheat_a2_result": "dwd/cheat_a2",
    "new_user_result": "dws/new_users",
}

# Event time zone of the source (GMT+8); day cuts follow the session zone.
SOURCE_TIME_ZONE = "Asia/Shanghai"

# Streaming source defaults.
KAFKA_TOPIC = "content_events"
KAFKA_STARTING_OFFSETS = "earliest"

# ---------------------------------------------------------------------------
# Tunables for scale (not part of the specified behaviour).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScaleOptions:
    """Knobs that change the physical plan, never the result."""

    # Largest dimension (rows) that is broadcast; beyond it the join shuffles.
    broadcast_max_rows: int = 2_000_000
    # ... and bytes (fixed-width values plus string lengths).
    broadcast_max_bytes: int = 256 * 1024 * 1024
    # Event-time bucket that splits one hot key into many tasks in the
    # detectors and in sessionization (seconds).
    split_bucket_sec: int = 3600


DEFAULT_SCALE = ScaleOptions()
