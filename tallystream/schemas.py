"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql.types import ArrayType, StructType


def _struct(**fields) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


# The columns a pick table declares. Settlement time is a long: epoch millis
# do not fit an int.
PICK_TABLE = _struct(
    user_fkey="string",
    type="integer",
    currency_code="integer",
    risk_amount="integer",
    us_coeff="integer",
    expected_payout_amount="integer",
    selections_count="integer",
    stake_category="integer",
    settlement_state="integer",
    settlement_stamp_millis_utc="long",
    settlement_payout_amount="integer",
)

# The keys a totals job reads from a pick message.
PICK_RECORD = _struct(
    user_fkey="string",
    risk_amount="integer",
    settlement_state="integer",
    currency_code="integer",
    created_stamp_millis_utc="long",
)

SELECTION = _struct(
    channel_id="integer",
    channel_name="string",
    created_stamp_millis_utc="long",
    event__away_team_name="string",
    event__home_team_name="string",
    event__is_home_visually_first="boolean",
    event_fkey="string",
    event_info="string",
    event_start_stamp_millis_utc="long",
    fkey="string",
    market_fkey="string",
    market_name="string",
    market_note="string",
    pick_fkey="string",
    proposal__is_inplay="boolean",
    proposal__market_category="integer",
    proposal__market_type="integer",
    proposal__selection_type="integer",
    proposal_fkey="string",
    selection_name="string",
    selection_param_1="string",
    settlement_stamp_millis_utc="long",
    settlement_state="integer",
    sport_id="integer",
    updated_stamp_millis_utc="long",
    us_coeff="integer",
    version="integer",
)

# The whole pick message; jobs declare the subset they need.
PICK_MESSAGE = _struct(
    __class_name="string",
    copied_from_pick_fkey="string",
    created_stamp_millis_utc="long",
    currency_code="integer",
    debug_info_caller="string",
    expected_payout_amount="integer",
    fkey="string",
    risk_amount="integer",
    selections=ArrayType(SELECTION),
    selections_count="integer",
    settlement_payout_amount="integer",
    settlement_stamp_millis_utc="long",
    settlement_state="integer",
    stake_category="integer",
    type="integer",
    updated_stamp_millis_utc="long",
    us_coeff="integer",
    user_fkey="string",
    version="integer",
)

# Rides travel in one column order and are declared in another; names match.
RIDE_MESSAGE = _struct(
    rideId="long",
    isStart="boolean",
    eventTime="string",
    lon="float",
    lat="float",
    psgCnt="integer",
    taxiId="long",
)

RIDE_TABLE = _struct(
    rideId="long",
    taxiId="long",
    isStart="boolean",
    lon="float",
    lat="float",
    psgCnt="integer",
    eventTime="string",
)

RIDE_SINK = _struct(
    rideId="long",
    taxiId="long",
    isStart="boolean",
    lon="float",
    lat="float",
    psgCnt="integer",
    rideTime="string",
)

SENSOR_EVENT = _struct(
    device_id="string",
    co="double",
    humidity="double",
    motion="boolean",
    temp="double",
    ampere_hour="double",
    ts="long",
)

PRINT_SINK = _struct(user_fkey="string", risk_amount="integer")

WINDOW_SINK = _struct(
    user_fkey="string",
    window_start="timestamp",
    window_end="timestamp",
    total_risk_amount="float",
)

# Columns of one record as a topic source delivers it.
RAW_RECORD = _struct(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)
