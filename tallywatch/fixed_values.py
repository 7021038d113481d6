"""Thresholds, names and texts that results must carry exactly.

Everything here is plain data. Logic lives in the operators.
"""
from __future__ import annotations

# Entities of interest and their contract addresses (public, lower case).
ENTITY_ADDRESSES = {
    "USDT": "0xdac17f958d2ee523a2206206994597c13d831ec7",
    "USDC": "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48",
    "PYUSD": "0x6c3ea9036406852006290770bedfcaba0e23a0e8",
}
UNIT_SCALE = 1e6          # six decimals: raw token units per token
WEI_PER_ETH = 1e18
WEI_PER_GWEI = 1e9

# The zero address, compared on the last 40 characters.
ZERO40 = "0" * 40

# Amount bands as (upper bound, label, order); None is "no upper bound".
AMOUNT_BANDS = [
    (10.0, "under 10", 1),
    (1000.0, "10 to 1k", 2),
    (100000.0, "1k to 100k", 3),
    (None, "100k and over", 4),
]
ROUTES = ("direct", "via contract")
SOURCE_TABLES = ("token_transfers", "transactions", "blocks")

# Lateness, in hours.
LATE_HOURS = 48
DUE_HOURS = 48
OVERDUE_DAY_OF_MONTH = 10

# Freshness limits, in days.
FRESH_WARN_DAYS = 35
FRESH_ERROR_DAYS = 62

# Detection.
METRICS = ("transfers", "volume", "failure_rate")
LOG_FLOOR = {"transfers": 1.0, "volume": 1.0, "failure_rate": 1e-4}
MIN_MOVE = {"transfers": 1.3, "volume": 2.0, "failure_rate": 2.0}
MIN_SCORE = 5.0
MIN_SPREAD = 0.05
MAD_TO_SIGMA = 1.4826
HISTORY_ROWS = 8
MIN_CALLS = 500
CHANCE_MIN_GAP = 50.0
CHANCE_SIGMAS = 4.0
EPISODE_GAP_DAYS = 2
LAG_FACTOR = 2.0

# Planning the comparison days.
WAVE_GAP_DAYS = 30
BASELINE_DAYS = 7
BASELINE_BACK_DAYS = 180
BASELINE_MIN_DAYS = 3
BASELINE_MAX_SCORE = 3.0

# Verdict thresholds.
EXPLAINS = 0.6
RESTORED = 1.5
MOVED_TOGETHER = {"transfers": 1.3, "volume": 1.5, "failure_rate": 1.5}

# Deep-dive thresholds.
SPIKE_FACTOR = 3.0
SPIKE_ROWS = 28
SPIKE_BASELINE_DAYS = 14
OUTLIER_FACTOR = 1000.0
BIG_SUPPLY_AMOUNT = 1e6
REWRITE_SAMPLE = 6

# Verdict families and their labels.
FAMILY_LABELS = {
    "pipeline": "Pipeline",
    "doubt": "Data in doubt",
    "bots": "Bots and automation",
    "few": "A few actors",
    "supply": "Supply event",
    "newcomers": "New senders",
    "broad": "Broad real change",
    "noise": "No clear move",
}

# Verdict titles.
TITLES = {
    "blocks_missing": "Blocks missing",
    "blocks_twice": "Blocks loaded twice",
    "incomplete": "Incomplete day: nothing after %s UTC",
    "rows_twice": "Rows loaded twice",
    "mart_differs": "The model changed the number",
    "units": "Units changed %s: amounts %s× too %s",
    "noise": "No clear move against comparable days",
    "absent_failers": "The senders that usually fail stopped sending",
    "one_program": "One program: failed calls share an exact gas fingerprint (%s gas)",
    "new_failing": "New addresses failing; regular senders unaffected",
    "new_failing_mixed": "New addresses made most of the failures (regular senders were also affected)",
    "over_and_over": "A few addresses failing over and over",
    "ten_failing": "Ten addresses made most of the failures",
    "regular_failing": "Regular senders failed more too: not a new group, but most users",
    "dust_ended": "A dust wave ended: fewer transfers under 1 token",
    "busiest_less": "The busiest senders sent much less",
    "empty_hours": "Whole hours with no transfers at all",
    "dust": "Dust: a wave of transfers under 1 token",
    "ten_sending": "Ten senders made most of the extra transfers",
    "newcomers": "New senders made most of the extra transfers",
    "large_missing": "The usual very large transfers did not happen",
    "supply": "The issuer minted and burned tokens",
    "ten_sent": "Ten addresses sent most of the extra value",
    "ten_received": "Ten addresses received most of the extra value",
    "large": "A few very large transfers",
    "rewritten": "The source rewrote this day, and no group explains the move",
    "market": "Market-wide: the other stablecoins moved the same way",
    "broad": "Many senders moved together; no single group explains it",
}

# The sixteen row rules as (name, table, who is at fault), in report order.
ROW_RULES = [
    ("transfer in a failed transaction", "transfers", "source"),
    ("transfer and its transaction in different blocks", "transfers", "source"),
    ("transfer time differs from its block", "transfers", "source"),
    ("negative amount", "transfers", "source"),
    ("transfer stored under the wrong day", "transfers", "source"),
    ("repeated log index in a block", "transfers", "source"),
    ("fee below the block's base fee", "transactions", "source"),
    ("transaction time differs from its block", "transactions", "source"),
    ("transaction index beyond the block's size", "transactions", "source"),
    ("repeated transaction index in a block", "transactions", "source"),
    ("transaction stored under the wrong day", "transactions", "source"),
    ("direct call labelled with the wrong token", "transactions", "our extract"),
    ("parent hash does not match the previous block", "blocks", "source"),
    ("block time not after the previous block", "blocks", "source"),
    ("block over its gas limit", "blocks", "source"),
    ("block stored under the wrong day", "blocks", "source"),
]

# The seven load checks.
LOAD_CHECKS = [
    "Days present",
    "Duplicate transfers (same hash and log index)",
    "Transfers with a missing amount or address",
    "Transfers whose transaction is missing",
    "Transfers whose block is missing",
    "Missing blocks in the month's range",
    "Duplicate block rows",
]

# Measures compared between two snapshots of a table-day, in report order.
SNAPSHOT_MEASURES = ["rows", "files", "file_names", "min_block", "max_block", "first_written", "last_written",
                     "stable_rows", "stable_amount", "stable_failed"]
PUBLISHED_MEASURES = ["rows", "files", "min_block", "max_block", "first_written", "last_written"]
