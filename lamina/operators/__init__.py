from lamina.operators.latest import keep_latest
from lamina.operators.profile import column_profile
from lamina.operators.upsert import upsert_by_key

__all__ = ["column_profile", "keep_latest", "upsert_by_key"]
