"""Table specifications: feeds, silver models, gold marts, thresholds."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

# --- fixed values (must equal the source pipeline for identical results) ---
# Accepted transaction types, after lower-casing (not trimmed).
ACCEPTED_TRANSACTION_TYPES = ("deposit", "withdraw", "bet")
# Accepted affiliate countries, upper-case ISO codes.
ACCEPTED_COUNTRIES = ("AR", "BR", "CL", "CO", "MX")
# Lower bound of every bronze partition range.
PARTITION_FLOOR = "1900-01-01"
# Default lower bound of the incremental watermark when the target is empty.
WATERMARK_FLOOR = "1900-01-01"
# Rows per output file written by the source's landing job, sized for a container
# of 512 MB (give it as ``rows_per_file`` to get the same files).
SOURCE_ROWS_PER_FILE = 1000
# Signal thresholds (declared heuristics, calibratable):
#   high withdraw:  withdraw > deposit * 1.5 and withdraw >= 500
#   high bet:       bet >= deposit * 5 and bet >= 1000
#   shared ip:      some ip of the player seen for >= 5 distinct players
#   many devices:   >= 4 distinct device types
# --------------------------------------------------------------------------

# Most rows of a bronze file, by default.
ROWS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class SignalThresholds:
    withdraw_to_deposit: Decimal = Decimal("1.5")
    min_withdraw: Decimal = Decimal("500")
    bet_to_deposit: Decimal = Decimal("5")
    min_bet: Decimal = Decimal("1000")
    shared_ip_players: int = 5
    many_devices: int = 4


THRESHOLDS = SignalThresholds()


@dataclass(frozen=True)
class FeedSpec:
    """A raw feed: all-string columns in declared order, its partition rule."""

    name: str
    columns: tuple[str, ...]
    default_format: str            # csv | json
    file_name: str
    partition_source: str | None   # column whose date prefix becomes `dt`
    partition_column: str = "dt"   # or ingest_date when there is no event date

    @property
    def string_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType(self.string_schema.fields
                            + [T.StructField(self.partition_column, T.DateType(), True)])


FEEDS: dict[str, FeedSpec] = {
    "players": FeedSpec("players", ("player_id", "email", "city", "created_at"),
                        "json", "players.json", "created_at"),
    "sessions": FeedSpec("sessions", ("session_id", "player_id", "ip", "device", "timestamp"),
                         "json", "sessions.json", "timestamp"),
    "transactions": FeedSpec("transactions",
                             ("transaction_id", "player_id", "type", "amount", "timestamp"),
                             "csv", "transactions.csv", "timestamp"),
    "affiliate_cpa_ftd": FeedSpec("affiliate_cpa_ftd",
                                  ("affiliate_id", "player_id", "country", "clicks",
                                   "registrations", "ftd", "cpa_value"),
                                  "csv", "affiliate_cpa_ftd.csv", None, "ingest_date"),
}


@dataclass(frozen=True)
class SilverSpec:
    """An incremental silver model: one row per unique key, partitioned by date."""

    name: str
    feed: str
    unique_key: str
    event_column: str        # ordering + watermark column
    date_column: str         # partition column of the target
    incremental: bool = True


SILVER: dict[str, SilverSpec] = {
    "slv_players": SilverSpec(
        "slv_players", "players", "player_id", "created_at", "created_at"),
    "slv_sessions": SilverSpec(
        "slv_sessions", "sessions", "session_id", "session_at", "session_date"),
    "slv_transactions": SilverSpec(
        "slv_transactions", "transactions", "transaction_id", "transaction_at",
        "transaction_date"),
    "slv_affiliate_cpa_ftd": SilverSpec(
        "slv_affiliate_cpa_ftd", "affiliate_cpa_ftd", "affiliate_player_country_key",
        "", "", incremental=False),
}

# Decimal type used for every NUMERIC value (amounts, CPA, costs, ratios).
NUMERIC = T.DecimalType(38, 9)

# Typed casts the silver models apply to each feed's string columns.
TYPED_COLUMNS: dict[str, dict[str, str]] = {
    "players": {"created_at": "date"},
    "sessions": {"timestamp": "timestamp"},
    "transactions": {"amount": "decimal(38,9)", "timestamp": "timestamp"},
    "affiliate_cpa_ftd": {"clicks": "bigint", "registrations": "bigint", "ftd": "bigint",
                          "cpa_value": "decimal(38,9)"},
}
