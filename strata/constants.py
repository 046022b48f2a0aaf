"""Behaviour that must equal the source system's for right results.

Kept together, in the order the pipeline applies them.
"""

# Loading the catalogue
MAX_TEXT_LEN = 500                 # names truncated to this many characters
YEAR_RANGE = (1000, 9999)          # a year outside it loads as null

# Validation rules
POPULARITY_RANGE = (0, 100)        # R3, inclusive
UNIT_RANGE = (0.0, 1.0)            # R4 for danceability and energy, inclusive
MIN_DURATION_MS = 30000            # R5, strictly greater

# Silver enrichment
HIGH_POPULARITY = 70               # popularity >= 70 -> "High"
MEDIUM_POPULARITY = 40             # popularity >= 40 -> "Medium", else "Low"
CATEGORY_LABELS = ("High", "Medium", "Low")
ACOUSTIC_THRESHOLD = 0.5           # acousticness >= 0.5 -> is_acoustic

# Gold marts
HITS_PER_GROUP = 10                # rank <= 10 per (genre, year), ties kept

# Serving
TEXT_COLLATION = "UNICODE_CI_AI"   # text filters compare case- and accent-insensitively
DEFAULT_PAGE_SIZE = 50
MAX_PAGE_SIZE = 200
DEFAULT_YEAR_RANGE = (2000, 2023)  # year filter domain of an empty mart
EVOLUTION_MAX_GENRES = 5           # genre x decade series for the first five genres
TOP_HITS_SHOWN = 10
RAW_TRACKS_SHOWN = 100
