from rankloom.functions.keys import fold_hash, join_key, md5_order, split_key
from rankloom.functions.numbers import fixed_text, indicator, pearson_from_sums, percent_text, safe_ratio

__all__ = [
    "fold_hash", "join_key", "md5_order", "split_key",
    "fixed_text", "indicator", "pearson_from_sums", "percent_text", "safe_ratio",
]
