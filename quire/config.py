"""Parameters of the operators, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    conf_skip: float = 0.35
    conf_review: float = 0.55
    min_height: float = 5.0
    micro_height: float = 1.8
    supplement_height: float = 3.6
    text_layer_overlap: float = 0.55
    duplicate_overlap: float = 0.55
    reading_overlap: float = 0.6
    reading_ratio: float = 0.85
    min_occurrences: int = 3
    sample_ratio: float = 0.10
    force_cap: float = 0.20
    seed: int = 11
    long_sentence: int = 60
    min_words: int = 1000
    drift_length: int = 24
    drift_rows: int = 120
    batch_size: int = 200
    decoration: str = "(?i)^AI\\s*[6OG&]\\s*Z?\\s*GROWTH$"


DEFAULT = Config()

# Word lists of the rules.
STOP_CAPS = ("THE", "AND", "BUT", "FOR", "NOT", "ALL", "NEW", "OUR", "YOU", "WERE", "THIS", "THAT", "WITH", "FROM", "ARE", "HAS", "ITS", "OUT", "PER")
STOP_SHORT = ("the", "and", "for", "with", "from", "that", "this", "are", "was", "has", "have", "not", "but", "all", "you", "our", "its", "out", "per", "see")
STOP_LONG = (
    "the", "and", "for", "with", "from", "that", "this", "are", "was", "were", "has", "have", "had", "not", "but", "all", "you", "our", "its", "out", "per", "see",
    "can", "will", "would", "could", "should", "been", "into", "than", "then", "more", "most", "less", "least", "also", "just", "only", "over", "under", "about", "which",
    "while", "when", "where", "what", "who", "how", "why", "their", "there", "these", "those", "they", "them", "his", "her", "hers", "itself", "very", "much", "many",
    "some", "any", "each", "other", "such",
)
NUMBER_WORDS = {
    "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12",
    "twenty": "20", "thirty": "30", "forty": "40", "fifty": "50", "sixty": "60", "seventy": "70", "eighty": "80", "ninety": "90", "hundred": "100", "thousand": "1000", "million": "1000000",
}
