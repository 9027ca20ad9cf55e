from eventweave.functions.fields import (date_prefix, field, field_or, has_key, is_object,
                                         iso_text, iso_to_ts, json_text, parse, truncate_to_bigint)

__all__ = ["date_prefix", "field", "field_or", "has_key", "is_object", "iso_text",
           "iso_to_ts", "json_text", "parse", "truncate_to_bigint"]
