"""Field names and their order in the output records, and configured numbers.

They are part of the results' definition and stand here together.
"""

# Output records.
TRANSFORMED = ["userID", "count", "fav", "hashtags", "name"]
TOTALS = ["userID", "count", "fav", "hashtags", "name", "mentioned"]
MARIO = ["id", "user_id", "screen_name", "created_at", "text", "medias", "hashtags"]

# The keyword feed.
LANG = "fr"
WORD = "mario"

# Partitions of every topic.
PARTITIONS = 10
# Rows of an exported file and lines of a replayed one.
ROWS_PER_FILE = 100
# One update per changed key and interval: the application's and the SQL feed's.
COMPACTION = {"processingTime": "10 seconds"}
SQL_COMPACTION = {"processingTime": "2 seconds"}
# The replay sends one file per second.
PACED = {"processingTime": "1 second"}
