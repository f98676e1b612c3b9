"""Text cleaning, tokenising and stop-word removal as built-in expressions.

These give the same results as the MLlib ``Tokenizer`` and
``StopWordsRemover`` stages on cleaned text, but stay inside whole-stage
codegen so the long-form operators (term frequency, document frequency, word
statistics) never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Cleaning keeps ASCII letters and the plain space only; every other character
# (digits, punctuation, accents, tabs, newlines) is deleted, not replaced.
# It runs on lower-cased text, which holds no A-Z; Java's matcher is several
# times faster on runs of this class than on each character of "[^a-zA-Z ]".
CLEAN_PATTERN = "[^a-z ]+"

# Spark's default English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english"), 181 words, in its order).
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "should", "now", "i'll", "you'll", "he'll",
    "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd",
    "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're",
    "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't",
    "couldn't", "cannot", "could", "here's", "how's", "let's", "ought",
    "that's", "there's", "what's", "when's", "where's", "who's", "why's",
    "would",
)
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """lower-case, then delete everything but ASCII letters (now a-z) and spaces."""
    return F.regexp_replace(F.lower(_col(c)), CLEAN_PATTERN, "")


# Java's \s: the whitespace characters MLlib's Tokenizer splits on.
_JAVA_WHITESPACE = " \t\n\u000b\f\r"


def has_clean_text(c) -> Column:
    """True when ``clean_text(c)`` is non-empty (null for null input), without
    building the cleaned string: a regex *find* that stops at the first
    letter or space.  Used for the training-time empty filter, which
    Catalyst pushes into the scan; the cleaned text itself is then computed
    once, in the projection."""
    return F.lower(_col(c)).rlike("[a-zA-Z ]")


def tokenize(c, clean_input: bool = False) -> Column:
    """Split like MLlib's ``Tokenizer``: lower-case, split on each single
    whitespace character; leading/inner empty tokens are kept, trailing ones
    dropped; ``""`` gives ``[""]`` and whitespace-only text gives ``[]``.
    A null input gives null (the MLlib stage throws instead).

    ``clean_input=True`` promises the text holds only lower-case letters and
    spaces (the output of ``clean_text``): same result, cheaper expression
    (no lower-casing pass, literal-space split without a regex engine)."""
    if clean_input:
        s = _col(c)
        stripped = F.rtrim(s)
        parts = F.split(stripped, " ")
    else:
        s = F.lower(_col(c))
        stripped = F.rtrim(s, F.lit(_JAVA_WHITESPACE))
        parts = F.split(stripped, r"\s")
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(parts)
    )


def is_stop_word(term, stop_words=ENGLISH_STOP_WORDS, case_sensitive: bool = False) -> Column:
    """Row-level stop-word test (an InSet hash lookup inside codegen); use it
    after exploding tokens instead of filtering arrays with a lambda."""
    t = _col(term)
    if case_sensitive:
        return t.isin(list(stop_words))
    return F.lower(t).isin(sorted({w.lower() for w in stop_words}))


def remove_stop_words(c, stop_words=ENGLISH_STOP_WORDS, case_sensitive: bool = False) -> Column:
    """Drop stop words from an array column (hash-set lookup, not a scan)."""
    words = list(stop_words)
    if case_sensitive:
        return F.filter(_col(c), lambda w: ~w.isin(words))
    lowered = sorted({w.lower() for w in words})
    return F.filter(_col(c), lambda w: ~F.lower(w).isin(lowered))
