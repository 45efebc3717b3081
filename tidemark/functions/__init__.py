from .columns import (
    DURATION_BANDS,
    DURATION_DEFAULT,
    band,
    bucket_of,
    casted_to,
    drop_columns,
    key_struct,
    replace_all,
    typed_literal,
    upper,
    watermark_string,
)

__all__ = [
    "DURATION_BANDS",
    "DURATION_DEFAULT",
    "band",
    "bucket_of",
    "casted_to",
    "drop_columns",
    "key_struct",
    "replace_all",
    "typed_literal",
    "upper",
    "watermark_string",
]
