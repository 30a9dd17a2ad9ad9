"""Parameters of the registered queries.  Cuts split the tables into the
batches a stream would have delivered; they select time ranges, never
row subsets, so every query still reads whole tables."""

# Start log (events cover 2024-01-01 .. 2024-01-30).
DAU_SEEN_CUT = "2024-01-15 12:00:00"       # dau_incremental: seen before, batch from here
DAU_BATCH1_END = "2024-01-20 00:00:00"     # dau_upsert: batch 1 = [start, end)
DAU_BATCH2_START = "2024-01-10 12:00:00"   # dau_upsert: batch 2 = [start, end of data]
LEDGER_CUT_DAY = "2024-01-15"              # offset_ledger: batches (days) up to here
CONSUMER_GROUP = "dau_consumer"

# Orders (cover 1995-01-01 .. 2001-08-01).
STATE_CUT = "1998-01-01 00:00:00"          # state seeded by orders before, batch after
AS_OF = "2024-01-30"                       # age reference date
MISSING_REGION = 4                         # provinces of this region not yet loaded
MISSING_SEGMENT = "HOUSEHOLD"              # users of this segment not yet loaded
CHANGED_SEGMENT = "BUILDING"               # users renamed by the dimension update
UPDATED_STATUS = "O"                       # orders re-sent with a new status ...
NEW_STATUS = "F"                           # ... this one

# Search.
DOC_QUERY = "licensed disgusting"
CONV_QUERY = "nicht thing"
SEARCH_LIMIT = 10
