"""Column -> Column functions (text cleaning, tokens, tags, time parts)."""

from postlytics.functions.text import (  # noqa: F401
    clean_text, count_matches, extract_hashtags, extract_mentions, extract_tickers,
    has_hashtag, remove_hashtags, remove_links, remove_punctuation, remove_users, tokens,
)
from postlytics.functions.timeparts import (  # noqa: F401
    date_part_columns, epoch_micros_of_ntz, epoch_ms_of_ntz, epoch_ms_to_seconds,
    epoch_seconds_of_ntz, ntz_from_epoch_seconds, parse_timestamp_text, to_local_time,
)
