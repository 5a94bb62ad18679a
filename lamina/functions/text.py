"""Rules for missing and untidy text. NULL counts as the empty string throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text, F.lit(""))))


def missing_event(event_id: Column) -> Column:
    """An event key is taken as it comes, so only the empty one is missing."""
    return F.coalesce(event_id, F.lit("")) == ""


def missing_user(user_name: Column) -> Column:
    """User names are trimmed before use, so one of blanks only is missing too."""
    return cleaned(user_name) == ""


# Fields whose text may be unreadable.
UNREADABLE = ("event_time", "value", "record")


def rejection_reason(
    event_id: Column, user_name: Column, event_time: Column | None = None, unreadable: Column | None = None
) -> Column:
    """Everything that is missing or can't be read, comma separated; empty for a valid row.

    `unreadable` is the JSON of the texts that could not be read, by field.
    """
    reasons = [
        F.when(missing_event(event_id), F.lit("empty_event_id")),
        F.when(missing_user(user_name), F.lit("empty_user_name")),
    ]
    texts = {f: F.get_json_object(unreadable, f"$.{f}") if unreadable is not None else F.lit(None) for f in UNREADABLE}
    if event_time is not None:
        reasons.append(F.when(event_time.isNull() & texts["event_time"].isNull(), F.lit("empty_event_time")))
    if unreadable is not None:
        reasons += [F.when(text.isNotNull(), F.lit(f"unreadable_{f}")) for f, text in texts.items()]
    return F.concat_ws(",", *reasons)
