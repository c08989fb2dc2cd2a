"""Fixed values and defaults.

The first block must equal the published behaviour for results to match; the
second block holds our own defaults, all of them overridable by parameter.
"""

# --- fixed values -----------------------------------------------------------
TOP_TERMS = 50                 # keywords per article, category track
BODY_TERMS = 20                # keywords per article body, profile track
TITLE_TERMS = 5                # keywords per article title, profile track
CLUSTERS = 10                  # k of k-means
CLUSTER_STEPS = 3              # iterations of k-means
CLUSTER_DELTA = 0.01           # stop when no centre moves further than this
GRAVITY = 1.8                  # exponent of the age decay
GRAVITY_OFFSET_HOURS = 2       # added to the age
LIST_LENGTH = 10               # articles per recommendation list
OVERLAP_EPSILON = 0.000001     # start value of the shared weight
SLOT_BOOST = 1.1               # +10 % for keywords of the current time slot
FIRST_TERMS = 5                # keywords of the short list
PUBLISH_PATTERN = "yyyy年M月d日H:mm"
PUBLISH_PATTERN_OUT = "yyyy年MM月dd日HH:mm"
NULL_TEXT = "NULL"

# --- our defaults -----------------------------------------------------------
HALF_LIFE_HOURS = 24.0
SLOT_HOURS = 4
SMOOTHING = 1.0                # additive smoothing of Naive Bayes
RANK_DIGITS = 9                # digits on which scores are compared
PROFILE_PARTS = 16             # rows that a user profile is dealt over, by term; the same for all users
LIST_BLOCK = 64                # articles that are looked at together for a user's floor
CELLS = 64                     # tasks that pairs of users and articles are dealt over, at least, ...
CELL_ROWS = 20_000             # ... if there are so many keywords for each
PROFILE_ROWS = 3_000_000       # keywords of users that a task holds
CELL_PRODUCTS = 1_000_000      # rows of pairs that a task makes at a time
BLOCK_USERS = 2048             # of a cell that are looked at together
SPARSE = 5                     # a keyword that one of so many users has is a row of a table
FREQUENCY_BUCKETS = 1 << 20    # of terms, in the table that bounds their document frequency
