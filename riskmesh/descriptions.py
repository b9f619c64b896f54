"""What every column and table of the silver and gold layers means."""

from __future__ import annotations

TABLES = {
    "slv_players": "Players, the latest version of each, cleaned.",
    "slv_sessions": "Sessions, the latest version of each, with the device in lower case.",
    "slv_transactions": "Accepted transactions (deposit, withdraw, bet) of non-negative amount, the latest version of each.",
    "slv_affiliate_cpa_ftd": "Affiliate funnel numbers added up by affiliate, player and country as it was received.",
    "gold_financial_signals": "Money in and out of each player with the two signals drawn from it.",
    "gold_affiliate_metrics": "Funnel, cost and anomalies of each affiliate and country.",
    "gold_fraud_overview": "One row per player: activity, money, the five signals and how many of them are on.",
}

# A name means the same in every table that has it, unless OWN says otherwise.
COLUMNS = {
    "player_id": "Player.", "session_id": "Session; unique.", "transaction_id": "Transaction; unique.", "affiliate_id": "Affiliate partner.",
    "email": "E-mail in lower case, without white space around it.", "email_domain": "What follows the first @ of the e-mail.",
    "city": "City, each word capitalised.", "created_at": "Day of registration.", "ip": "IP address as received.",
    "device": "Kind of device, lower case.", "session_at": "When the session took place (UTC).", "session_date": "UTC day of session_at.",
    "transaction_type": "deposit, withdraw or bet.", "amount": "Amount moved, never negative.",
    "transaction_at": "When the transaction took place (UTC).", "transaction_date": "UTC day of transaction_at.",
    "deposit_amount": "The amount of a deposit, else 0.", "withdraw_amount": "The amount of a withdrawal, else 0.",
    "bet_amount": "The amount of a bet, else 0.", "country": "Country code in upper case.", "clicks": "Clicks on the affiliate's links.",
    "registrations": "Registrations that followed.", "ftd": "First deposits that followed.", "cpa_value": "Highest price per first deposit.",
    "affiliate_player_country_key": "MD5 of affiliate, player and country as received; unique.",
    "estimated_cpa_cost": "First deposits times their price, added up.",
    "registration_rate": "Registrations per click; NULL without clicks.", "ftd_rate": "First deposits per registration; NULL without registrations.",
    "has_registration_over_click_anomaly": "More registrations than clicks.", "has_ftd_over_registration_anomaly": "More first deposits than registrations.",
    "transaction_count": "Transactions of the player.", "deposit_count": "Deposits of the player.", "withdraw_count": "Withdrawals of the player.",
    "bet_count": "Bets of the player.", "total_deposit_amount": "All deposits.", "total_withdraw_amount": "All withdrawals.", "total_bet_amount": "All bets.",
    "withdraw_to_deposit_ratio": "Withdrawals per deposited unit.", "bet_to_deposit_ratio": "Bets per deposited unit.",
    "has_high_withdraw_signal": "Withdrawals exceed 1.5 times the deposits and reach 500.",
    "has_high_bet_velocity_signal": "Bets reach 5 times the deposits and 1000.", "last_transaction_at": "Newest transaction (UTC).",
    "attributed_players": "Players that the affiliate brought.", "registration_over_click_rows": "Silver rows with more registrations than clicks.",
    "ftd_over_registration_rows": "Silver rows with more first deposits than registrations.", "has_funnel_anomaly": "Some silver row has a funnel anomaly.",
    "session_count": "Sessions of the player.", "distinct_ip_count": "IP addresses the player used.", "distinct_device_count": "Kinds of device the player used.",
    "max_players_on_same_ip": "Most players seen on one of the player's IP addresses.", "has_shared_ip_signal": "At least 5 players share an IP address with the player.",
    "has_many_devices_signal": "At least 4 kinds of device.", "has_affiliate_funnel_anomaly": "Some affiliate row of the player has a funnel anomaly.",
    "fraud_signal_count": "How many of the five signals are on.", "last_session_at": "Newest session (UTC).",
}
OWN = {
    ("slv_players", "player_id"): "Player; unique.",
    ("gold_financial_signals", "player_id"): "Player; unique.",
    ("gold_fraud_overview", "player_id"): "Player; unique.",
    ("slv_affiliate_cpa_ftd", "player_id"): "Player that the affiliate brought.",
    ("gold_fraud_overview", "withdraw_to_deposit_ratio"): "Withdrawals per deposited unit, 0 if unknown.",
    ("gold_fraud_overview", "bet_to_deposit_ratio"): "Bets per deposited unit, 0 if unknown.",
}


def column(table: str, name: str) -> str:
    return OWN.get((table, name)) or COLUMNS[name]
