"""Word lists, markers, names and formats that decide results."""

# --- Fixed values: words that carry no content, for word frequency and sentiment (73).
FREQUENCY_STOPWORDS = (
    "a an the and or but in on at to for "
    "of with by from is was are were be been "
    "being have has had do does did will would "
    "could should may might shall not no nor "
    "so yet both either as if though while "
    "that this these those it its i he she "
    "we they you my his her our their your "
    "me him us them who which what when where"
).split()

# --- Fixed values: words left out of the unique-word set of the syntactic metrics (68).
VOCABULARY_STOPWORDS = (
    "the a an and or but in on at to "
    "for of with by from is was are were "
    "be been being have has had do does did "
    "will would could should may might shall "
    "that this these those it its as if "
    "not no nor so yet both either neither "
    "i he she we they you me him her "
    "us them my his our your their up"
).split()

# --- Fixed values: abbreviations whose full stops do not end a sentence.
ABBREVIATIONS = (
    "Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.",
    "vs.", "etc.", "e.g.", "i.e.", "U.S.", "U.K.",
)

# --- Fixed values: patterns of the lines that enclose the body of a book.
STRICT_START = r"\*\*\* START OF THE PROJECT GUTENBERG EBOOK"
STRICT_END = r"\*\*\* END OF THE PROJECT GUTENBERG EBOOK"
LENIENT_START = r"(?iu)\*\*\* start of (?:the|this) project gutenberg"
LENIENT_END = r"(?iu)\*\*\* end of (?:the|this) project gutenberg"
# What all of them begin with.
MARKER_SIGN = "***"

# --- Fixed values: metric names.
SENTIMENT_METRICS = ("polarity_score", "positive_count", "negative_count", "total_scored_words")
SYNTACTIC_METRICS = (
    "word_count", "sentence_count", "unique_word_count",
    "avg_sentence_length", "avg_word_length", "type_token_ratio",
    "flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog_index",
)
SYNTACTIC_COUNTERS = (
    "sentence_count", "word_count", "char_count", "syllable_count", "complex_word_count",
)
SCALAR_METRICS = SENTIMENT_METRICS + ("total_word_count", "unique_word_count", "type_token_ratio")
METADATA_FIELDS = ("title", "author", "is_bestseller")
REPORT_FIRST = (
    "polarity_score", "positive_count", "negative_count",
    "type_token_ratio", "unique_word_count", "total_word_count",
)

# --- Fixed values: path keywords of each component, tested in this order.
COMPONENT_KEYWORDS = {
    "wordfreq": ("wordfreq", "word_freq", "word-freq", "component1", "comp1"),
    "sentiment": ("sentiment", "component2", "comp2"),
    "syntactic": ("syntactic", "syntax", "component3", "comp3"),
    "metadata": ("metadata", "meta"),
}

# --- Fixed values: cohorts by flag, and the reasons a record line is left out.
COHORTS = {"1": "bestseller", "0": "standard"}
DROP_REASONS = (
    "empty_line", "no_tab_separator", "malformed_json",
    "not_a_json_object", "missing_or_invalid_cohort",
)

# --- Fixed values: limits and tolerance.
TOP_WORDS = 20
COMPLEX_SYLLABLES = 3
TIE_EPSILON = 1e-9
