"""Column expressions used by the operators.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen on the executors; none needs a Python worker.
"""

from changefeed.functions.columns import (
    DATA_PREFIX,
    DEFAULT_KEY,
    HOST_PATTERN,
    JSON_READ_OPTIONS,
    decode_utf8,
    domain_is_not_text,
    epoch_to_string,
    is_data_line,
    json_elements,
    json_object,
    last_value,
    may_name_domain,
    meta_is_text,
    not_an_object,
    only_object,
    partition_key,
    strip_data_prefix,
    url_host,
)

__all__ = [
    "DATA_PREFIX",
    "DEFAULT_KEY",
    "HOST_PATTERN",
    "JSON_READ_OPTIONS",
    "decode_utf8",
    "domain_is_not_text",
    "epoch_to_string",
    "is_data_line",
    "json_elements",
    "json_object",
    "last_value",
    "may_name_domain",
    "meta_is_text",
    "not_an_object",
    "only_object",
    "partition_key",
    "strip_data_prefix",
    "url_host",
]
