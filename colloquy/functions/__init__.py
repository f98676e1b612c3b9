"""Column-level building blocks (pure Spark SQL expressions, codegen friendly)."""

from colloquy.functions.text import (  # noqa: F401
    ENGLISH_STOP_WORDS,
    clean_text,
    remove_stop_words,
    tokenize,
)
from colloquy.functions.formats import (  # noqa: F401
    label_text,
    percent_text,
    preview,
    round_half_up,
    round_ratio,
)
