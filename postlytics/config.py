"""Fixed values the results depend on.

Everything in this module is a constant that has to keep exactly this value for
the outputs to match the behaviour being rebuilt (cleaning patterns, the
punctuation set, the report's day list and size, the local time zone, the three
labels).  They are written out plainly, in their natural order.
"""

# --- fixed values: cleaning patterns (Python `re` semantics, written for Java regex) ---

# Python's `\s` on str patterns is Unicode whitespace; Java's plain `\s` is ASCII only.
# This class is Python's `\s` written for Java: ASCII blanks, U+001C..U+001F, U+0085 and
# every Unicode separator (Zs, Zl, Zp).
PY_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
PY_NONSPACE = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"

# links: case-sensitive "http" followed by at least one non-blank character
LINK_PATTERN = "http" + PY_NONSPACE + "+"
# (the classes end in 0-9_- , the same set as 0-9-_ , in the order every regex engine accepts)
# retweet marker with a handle, then any handle (first char a letter, two chars at least)
RETWEET_PATTERN = "RT" + PY_SPACE + "@[A-Za-z]+[A-Za-z0-9_-]+"
HANDLE_PATTERN = "@[A-Za-z]+[A-Za-z0-9_-]+"
# hashtag: '#', a letter, then at least one more letter, digit, '-' or '_'
HASHTAG_PATTERN = "#[A-Za-z]+[A-Za-z0-9_-]+"
# the punctuation set, one run of it becomes one blank; '#' and '\' are not in it:
# ! " $ % & ' ( ) * + , - . / : ; < = > ? [ ] ^ _ ` { | } ~ @
PUNCTUATION_CHARS = "!\"$%&'()*+,-./:;<=>?[]^_`{|}~@"
PUNCTUATION_PATTERN = r"[!\"$%&'()*+,\-./:;<=>?\[\]^_`{|}~@]+"
# ticker symbols, looked for in the raw text: "$", a capital, then capitals and digits, and further
# parts after a dot (BRK.B); of any length, the alias table decides what is an asset
TICKER_PATTERN = r"\$([A-Z][A-Z0-9]*(?:\.[A-Z0-9]+)*)\b"

# tokens for the word-weight scorers: letters only, lower case, split on one blank
TOKEN_NON_LETTERS = "[^A-Za-z]+"

# --- fixed values: time ---
LOCAL_TIME_ZONE = "America/Los_Angeles"   # what the reference's 'PST' resolves to
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- fixed values: reports ---
REPORT_DAYS = [15, 14, 13, 12, 11, 10, 9]   # days of month shown by the daily report
LATEST_POSTS_LIMIT = 20                     # rows of the latest-posts table
REPORT_COLUMNS = [
    "cleaned_tweet_text", "sentiment_score", "username", "retweets",
    "replies", "likes", "sentiment_label", "created_at_date",
]

# --- fixed values: sentiment contract ---
LABEL_NEGATIVE = "Negative"
LABEL_NEUTRAL = "Neutral"
LABEL_POSITIVE = "Positive"
LABELS = [LABEL_NEGATIVE, LABEL_NEUTRAL, LABEL_POSITIVE]

# test lexicon of the fixtures (fixture words, not real sentiment)
FIXTURE_LEXICON = {
    "the": 1.0, "and": 1.0, "le": 1.0, "und": 1.0, "el": 1.0,
    "of": -1.0, "de": -1.0, "der": -1.0, "la": -1.0,
}

# --- fixed values: state defaults ---
PULL_STATE_DEFAULT = 1        # last pulled id when an author has no state
RAW_STATE_DEFAULT = 0         # last appended id when an author has no log row

# --- engine limits (ours) ---
# folders of a landed pull (author buckets); bounded whatever the number of authors
LANDING_AUTHOR_BUCKETS = 16
# low bits of an id that a block of stored ids spans (some hours of ids that hold a time from
# bit 22 up), and the blocks of a batch that a key lookup names one by one
ID_BLOCK_BITS = 46
ID_BLOCKS_NAMED = 512
# a write of so few rows is shuffled into few files; larger ones are written by the tasks that hold
# the rows, with so many files of a task open at once
FEW_ROWS = 20_000
OPEN_WRITERS = 64
# rows of one landed file, which one task reads (compressed files are not split)
LANDING_FILE_ROWS = 20_000
# landed texts: each level above takes longer for a few percent of the bytes (the default level, three
# times as long for a tenth)
LANDING_GZIP_LEVEL = "BEST_SPEED"
# a vocabulary or user table of so many rows goes to the texts, larger ones are joined by a shuffle
BROADCAST_ROWS = 500_000
# pages (of up to 100 posts) that are put together, and shuffled, at a time as they are landed or stored
PART_PAGES = 30_000
