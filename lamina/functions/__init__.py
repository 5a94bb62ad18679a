from lamina.functions.money import exact_part, money, money_sum, rest_part
from lamina.functions.text import UNREADABLE, cleaned, missing_event, missing_user, rejection_reason
from lamina.functions.users import OPEN_END, user_bucket, user_key

__all__ = [
    "UNREADABLE",
    "OPEN_END", "cleaned", "exact_part", "missing_event", "missing_user", "money", "money_sum",
    "rejection_reason", "rest_part", "user_bucket", "user_key",
]
