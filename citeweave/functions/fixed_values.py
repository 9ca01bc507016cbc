"""FIXED VALUES: lists, patterns and constants the results depend on."""

# Prefixes of which exactly one is removed from a DOI, case-sensitive.
DOI_URL_PREFIXES = ("https://doi.org/", "http://doi.org/", "doi.org/")
DOI_LABEL = "DOI:"

# Text that stands for a missing DOI.
NO_DOI_TEXT = "None"

# Titles count as equal enough above this similarity (strictly above).
TITLE_THRESHOLD = 0.5

# Publication year searched for when a record has none.
DEFAULT_YEAR = 2020

# Score cutoff used when none has been tuned.
DEFAULT_CUTOFF = 35.0

# Seeded split of the gold standard, size of the pilot batch.
SPLIT_SEED = 42
TRAIN_SIZE = 300
PILOT_SIZE = 100

# An author entry containing one of these (anywhere, any case) is an affiliation.
AFFILIATION_WORDS = (
    "department", "university", "college", "institute", "laboratory",
    "school", "center", "centre", "hospital", "faculty", "division",
    "china", "usa", "uk", "germany", "france", "japan", "italy",
    "state key", "national", "research",
)
MAX_NAME_LENGTH = 50
MIN_NAME_LENGTH = 3

# Words that are never keywords of an enriched record.
ENRICHED_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from",
    "has", "he", "in", "is", "it", "its", "of", "on", "that", "the",
    "to", "was", "were", "will", "with", "between", "using", "through",
    "this", "these", "those", "their", "them", "than", "when", "where",
    "which", "while", "who", "how", "what", "can", "could", "should",
    "would", "may", "might", "must", "shall", "study", "analysis",
)
MAX_KEYWORDS = 15

# Words that are never keywords of an extracted record.
EXTRACTED_STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from",
)

# Target journal of the extraction.
TARGET_ISSN = "1588-2861"
PRINT_ISSN = "0138-9130"
JOURNAL_NAME = "scientometrics"

# ORCID inside an author entry.
ORCID_PATTERN = r"orcid:([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])"

# Error texts worth another try, and the HTTP codes that may be added to them.
RETRYABLE_ERRORS = ("Timeout", "ConnectionError", "ReadTimeout", "ConnectTimeout")
RETRYABLE_HTTP_CODES = (429, 500, 502, 503, 504)

# Short publication ids.
SHORT_ID_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SHORT_ID_LENGTH = 8

# Normalised author names.
UNKNOWN_NAME = "unknown"
MAX_AUTHOR_KEY = 100

# File formats: required headers and the text written for a failed registry check.
GOLD_COLUMNS = ("DOI", "Cinese_title")
LABELLED_COLUMNS = ("key", "title", "doi", "id_on_crossref")
DUMP_COLUMNS = ("id", "title", "author", "pub_date", "venue")
REGISTRY_FLAG = "ID_on_Crossref"
LOOKUP_ERROR_TEXT = "Errore API"

# Reasons and error texts of the bulk and hold-out reports.
REASON_NO_TITLE = "No title found"
REASON_LOW_SCORE = "Score %s below cutoff %s"
REASON_INVALID = "Metadata validation failed"
ERROR_NO_TITLE = "Titolo mancante"
ERROR_NOT_CACHED = "Chiave non trovata nella cache"
ERROR_EMPTY_ANSWER = "Nessun risultato nella cache"
ERROR_NO_HIT = "Nessun risultato da Crossref"

#: Columns of the file of wrong matches.
WRONG_MATCH_COLUMNS = (
    "key", "title", "gold_doi", "crossref_doi", "score", "on_crossref", "cr_title", "cr_year", "cr_authors", "cr_venue",
    "is_valid_match", "title_similarity", "title_valid", "year_valid", "author_valid",
)
