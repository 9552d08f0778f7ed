"""Fixed parameters of the registered queries (FIXTURES.md §2)."""

# The "now" for 365-day ages, the search day and keyword, page.
AS_OF = "2001-08-02"
SEARCH_DATE = "1997-02-01"
SEARCH_KEYWORD = "widget"
RELEVANCE_KEYWORD = "widget small"
PAGE_NO = 1
PAGE_SIZE = 5
# First row of the second page (a table widget sends a row offset).
PAGE2_OFFSET = 5
SEARCH_LEVEL = "MACHINERY"
# The day of the one-date dashboard queries.
DASH_DATE = "2024-01-15"
# The subscription regex of the change log.
CDC_TABLES = r"^(order_info|order_detail|user_info)$"
# Alert window and slide for the driver's sparse events (6 h / 1 h); the
# upstream job used 30 s / 5 s on live traffic.
ALERT_WINDOW_MS = 6 * 3600 * 1000
ALERT_SLIDE_MS = 3600 * 1000
ALERT_MIN_USERS = 3
# The upstream size, 30 s / 5 s, on event times divided by 720: 6 h of the
# sparse events become 30 s and 1 h becomes 5 s, so windows share minutes.
LIVE_WINDOW_MS = 30 * 1000
LIVE_SLIDE_MS = 5 * 1000
LIVE_DIVISOR = 720
# Day split of the seen-set anti join: start-ups before noon are "seen".
SEEN_BEFORE_HOUR = "12"
