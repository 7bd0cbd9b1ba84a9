"""Parameters of the registered queries over the test tables (FIXTURES.md §2)."""

from adperf.functions.windows import DayWindow
from adperf.sources.fixtures import ANCHOR, EXCLUDED

# Test windows sized for the synthetic tables' density.
LABEL = DayWindow("l", 0, -90)
W1 = DayWindow("w1", 90, 1)
W2 = DayWindow("w2", 180, 91)
V2 = DayWindow("v2", 365, 181)
UNIVERSE = DayWindow("u", 365, 1)
HISTORY = DayWindow("h", 2500, 1)
# The ten ad windows of the source (label, two weeks, seven earlier ones), stretched to the test tables' years.
FEATURE_WINDOWS = [LABEL, W1, W2, V2, DayWindow("v3", 545, 366), DayWindow("v4", 730, 546), DayWindow("v5", 912, 731),
                   DayWindow("v9", 1095, 913), DayWindow("v12", 1460, 1096), DayWindow("v18", 1825, 1461)]
SITE_WINDOWS = [W1, W2]
# Six cuts, five buckets, as in the source.
CLICK_CUTS = [0, 40, 80, 120, 160, 200]
FIRST_N = 40
CATALOG_OFFSET = 14

__all__ = ["ANCHOR", "EXCLUDED", "LABEL", "W1", "W2", "V2", "UNIVERSE", "HISTORY", "FEATURE_WINDOWS",
           "SITE_WINDOWS", "CLICK_CUTS", "FIRST_N", "CATALOG_OFFSET"]
