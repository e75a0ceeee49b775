"""Values that must agree with the systems writing and reading the tables."""

# Fixed values.
RATING_PREFIX = "PRODUCT_RATING_PREFIX"
RELAY_KEY = "logProcessor"
LOGIN_WARNING = "该用户在短时间内连续登录失败，怀疑有恶意登录"
RECENT_QUEUE_SIZE = 40
MAX_INT_ID = 2147483647
VISITOR_HASH_SEED = 61
VISITOR_HASH_BITS = 29
