"""Parameters used by every registered query (see FIXTURES.md)."""

HORIZON_DAYS = 180
MIN_PRIOR = 5
RFM_REFERENCE = "2001-08-01"
TEST_SIZE = 0.25
SEED = 42
TOP_ITEMS = 1000
K_NEIGHBOURS = 40
KNN_WEIGHT = 0.3
DBSCAN_WIDE = (1.2, 3)
DBSCAN_NARROW = (0.6, 3)
SAMPLE_FRACTION = 0.1
