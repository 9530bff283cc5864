"""Values that results depend on, stated once.

Fixed values: word lists, lookup rows, markers, thresholds and text patterns
below decide what the numbers are, so they are data, not design.  Every
function that uses one takes it as an argument with this value as default.

Patterns are Java regular expressions.  ``(?d)`` keeps ``\\n`` the only line
end for ``^ $ .``.
"""

# --- Fixed values: lexicons ------------------------------------------------

FUNCTION_WORDS = (
    "the", "of", "and", "a", "an", "to", "in", "that", "it", "is",
    "was", "for", "with", "as", "on", "at", "by", "be", "this", "had",
    "not", "but", "from", "or", "which", "they", "you", "his", "her", "their",
    "would", "there", "been", "when", "so", "if", "no", "all", "we", "he",
)

ARCHAIC_WORDS = (
    "thou", "thee", "thy", "thine", "ye", "thyself",
    "hath", "doth", "hast", "dost", "wast", "wert", "shalt", "wilt",
    "ere", "oft", "whilst", "amongst", "betwixt", "amidst", "unto", "upon",
    "hither", "thither", "whither", "hence", "thence", "whence", "yonder",
    "nigh", "naught", "aught", "wrought", "clad", "smote", "slew", "bade",
    "mayhap", "perchance", "verily", "forsooth", "anon", "wherefore",
    "methinks", "prithee", "lo", "behold", "nay", "yea", "spake", "wroth",
)

PUNCTUATION_MARKS = {
    "comma": (",",),
    "semicolon": (";",),
    "colon": (":",),
    "period": (".",),
    "question": ("?",),
    "exclamation": ("!",),
    "dash": ("—", "–", "--"),
    "ellipsis": ("…", "..."),
    "parenthesis": ("(", ")"),
}

CONTRACTION_CLITICS = ("n't", "'re", "'ve", "'ll", "'m", "'d")

OPEN_QUOTE, CLOSE_QUOTE, STRAIGHT_QUOTE = "“", "”", '"'

# --- Fixed values: annotation labels ---------------------------------------

SUBORDINATE_DEPS = ("advcl", "ccomp", "xcomp", "acl", "relcl", "csubj")
CLAUSE_HEAD_POS = ("VERB", "AUX")
CONTENT_POS = ("NOUN", "VERB", "ADJ", "ADV")
SENTENCE_TYPES = ("simple", "compound", "complex")

# --- Fixed values: sizes ---------------------------------------------------

MAX_CHUNK_CHARS = 100_000
BATCH_CAP = 200
MARKER_SCAN_BYTES = 2048
SHORT_STORY_BELOW, NOVELLA_BELOW = 10_000, 40_000
Z_EXCESS_BEYOND = 2.0
CONCEPTS_PER_WORK = 14
FRESHNESS_HOURS = 24
CALENDAR_START, CALENDAR_END = "1970-01-01", "2035-12-31"

# --- Fixed values: catalog classification ----------------------------------

SF_SUBJECT = "(?i)science fiction"
SF_SHELF = "(Science Fiction|Science Fiction by Women|Precursors of Science Fiction)"
FANTASY_SUBJECT = "(?i)fantas"
FANTASY_SHELF = "Fantasy"
SFF_SHELF = "Category: Science-Fiction & Fantasy"
SF_THEME_SUBJECT = (
    "(?i)interplanetary|space flight|time travel|robot|extraterrestrial|outer space"
    "|life on other planets|end of the world|utopia|dystopia"
)
FANTASY_THEME_SUBJECT = (
    "(?i)fairy tal|fairies|magic|mythology|folklore|dragons|witch|wizard"
    "|imaginary places|legends"
)
HORROR_SUBJECT = "(?i)horror tales|gothic fiction"
HORROR_SHELF = "(Horror|Gothic Fiction)"
HORROR_THEME_SUBJECT = (
    r"(?i)ghost stor|paranormal fiction|haunted house|haunted place|frankenstein.s monster"
    r"|(ghosts|supernatural|occultism|demonology|vampires|werewol\w*)\s*--\s*"
    r"(fiction|juvenile fiction|poetry|drama)"
)
ABOUT_SUBJECT = (
    r"(?i)--\s*(history and criticism|authorship|criticism|bibliograph"
    r"|study and teaching|biography|congresses|dictionaries|indexes)"
)
FICTION_SUBJECT = r"(?i)--\s*fiction"
GENRES = ("Sci-Fi", "Fantasy", "Horror", "Undetermined")

FOREIGN_CLASS_CODES = ("PA", "PG", "PH", "PJ", "PK", "PL", "PQ", "PT")
JUVENILE_CLASS_CODE = "PZ"

# --- Fixed values: boilerplate markers of the source texts ------------------

COPYRIGHT_MARKER = "copyrighted project gutenberg ebook"
BODY_START = r"(?md)^\*\*\* ?START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n]*$"
BODY_START_OLD = r"(?md)^\*END\*THE SMALL PRINT![^\n]*$"
BODY_END = (
    r"(?md)^\*\*\* ?END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n]*$"
    r"|^(?i:End of (?:the |this )?Project Gutenberg)"
)
SOURCE_MENTION = r"(?iU)project gutenberg|\be-?texts?\b"

# --- Fixed values: text-preparation patterns --------------------------------

BRACKET_NOTE = r"(?is)\[(?:Illustration|Transcriber)[^\]]*\]"
ETEXT_LINE = r"(?imd)^.*\[e-?text #\d+\].*$\n?"
CONTENTS_HEADING = (
    r"(?i)^(?:table of )?contents\.?$"
    r"|^list of (?:chapters|illustrations|plates|figures)\.?$|^illustrations\.?$"
)
CREDIT_LINE = (
    r"(?i)^(?:produced by|(?:this )?e-?text (?:was )?prepared by|prepared by"
    r"|transcribed|scanned by|proofread|credits?:)"
)
FRONT_CUE_LINE = (
    r"(?iU)^(?:by\b[^\n]{0,40}|illustrated by\b[^\n]*|with illustrations\b[^\n]*"
    r"|copyright\b[^\n]*|all rights reserved[^\n]*|\[?\d{4}\]?|\([^)\n]*\)"
    r"|(?:a |an )?(?:romance|novel|tale|fantasy|story|poem)s?|[^\n]{0,30}\d{4})$"
)
FRONT_STRONG_LINE = (
    r"(?iU)^(?:translated (?:from|by)|illustrated by|with illustrations|copyright"
    r"|all rights reserved|printed in)"
    r"|(?:& co(?:mpany)?\.?|publishers?|press|avenue|street)\W*$"
)
BRACKET_BLOCK = r"(?s)^\[[^\]]*\]$"
DEDICATION = r"(?iU)\bdedicat"
TAIL_BLOCK = r"(?iU)^[*_\s]*(?:the\s+)?end[.!]?[*_\s]*$|^finis\.?$"
CONTENTS_MIN_LINES, CONTENTS_MAX_LINE_CHARS = 3, 65
FRONT_BLOCKS, FRONT_MAX_LINES, FRONT_MAX_CHARS = 8, 3, 300
HEADING_MAX_LINES, HEADING_MAX_CHARS = 2, 60
SUBTITLE_MAX_CHARS, SUBTITLE_NEXT_OVER = 60, 150

HEADING_KEYWORD = (
    r"(?iU)^(?:chapter|book|part|volume|canto|stave|section)\b[^\n]{0,50}$"
)
HEADING_WORD = (
    r"(?iU)^(?:prologue|epilogue|introduction|induction|preface|foreword"
    r"|conclusion|appendix|interlude|dedication|author'?s note)\b[^\n]{0,40}$"
)
HEADING_NUMBER = (
    r"^(?:[IVXLCDM]{1,8}|\d{1,3})"
    r"(?:\.?$|[.:][ \t]+[\"']?[A-Z][^\n]{0,50}(?<![.!?,])$)"
)
EMPHASIS = r"_([^_\n]{1,300}?)_"
SINGLE_QUOTE_OPENING = r"(?U)(?:\A|[\s(—-])'\w"
SINGLE_QUOTE_MIN, SINGLE_QUOTE_TIMES = 30, 3
DIALECT_WORD = r"(?iU)^(?:tis|twas|em|e|im|er|un|ere|ave|ow)\b"

# Markdown to prose, in order: (pattern, replacement)
MARKDOWN_RULES = (
    (r"(?s)\A---\n.*?\n---\n", ""),
    (r"(?md)^[ \t]*\*{1,2}\s*Source:.*$", ""),
    (r"\A(?:[ \t]*#[^\n]*\n)?\s*\*{1,2}[^*\n]+\*{1,2}[ \t]*\n", ""),
    (r"(?md)^[ \t]*#{1,6}[ \t].*$", ""),
    (
        r"(?md)^[ \t]*\*[ \t]*\*[ \t]*\*[* \t]*$"
        r"|^[ \t]*-{3,}[ \t]*$|^[ \t]*_{3,}[ \t]*$",
        "",
    ),
    (r"(?md)^[ \t]*>[ \t]?", ""),
    (r"!\[[^\]]*\]\([^)]*\)", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"\*\*([^*]+)\*\*", "$1"),
    (r"__([^_]+)__", "$1"),
    (r"\*([^*\n]+)\*", "$1"),
    (r"_([^_\n]+)_", "$1"),
    (r"`([^`]+)`", "$1"),
    (r"\n{3,}", "\n\n"),
)

# --- Fixed values: metric concepts (metric lookup rows) ----------------------

METRIC_COLUMNS = (
    "metric_name", "display_name", "category", "unit", "higher_means",
    "description", "formula", "is_multivalue", "additivity",
)
METRIC_ROWS = (
    ("mean_word_length", "Mean word length", "lexical", "chars", "longer/denser diction",
     "Average characters per word over alphabetic tokens.",
     "sum(len(word)) / word_count", False, "non-additive"),
    ("yules_k", "Yule's K", "lexical", "index", "more repetition (poorer vocabulary)",
     "Length-stable lexical richness; repetition raises K.",
     "10^4 * (S2 - N) / N^2 (S2=sum of squared type freqs, N=tokens)", False, "non-additive"),
    ("archaic_word_rate", "% archaic/rare words", "lexical", "ratio", "more archaic diction",
     "Share of words matching a curated archaic/rare-word list.",
     "archaic_words / word_count", False, "non-additive"),
    ("honore_r", "Honoré's R", "lexical", "index", "richer vocabulary",
     "Hapax-based lexical richness; more once-only words raise R.",
     "100 * ln(N) / (1 - V1/V) (V1=hapaxes, V=types)", False, "non-additive"),
    ("function_word_frequency", "Function-word frequency", "lexical", "ratio",
     "more frequent use of the function word",
     "Per-word rate of each common function word (the, of, and); a hard-to-fake fingerprint.",
     "count(word) / word_count", True, "non-additive"),
    ("mean_sentence_length", "Mean sentence length", "syntactic", "words", "longer sentences",
     "Average alphabetic words per sentence; a pacing proxy.",
     "word_count / sentence_count", False, "non-additive"),
    ("sentence_length_stdev", "Sentence-length stdev", "syntactic", "words",
     "burstier rhythm (varied sentence lengths)",
     "Population standard deviation of sentence length in words.",
     "pstdev(words per sentence)", False, "non-additive"),
    ("mean_parse_tree_depth", "Mean parse-tree depth", "syntactic", "levels",
     "more grammatical nesting (hypotactic prose)",
     "Mean over sentences of the deepest token's distance to the dependency ROOT.",
     "mean(max token depth per sentence)", False, "non-additive"),
    ("sentence_type_mix", "Sentence-type mix", "syntactic", "ratio",
     "larger share of that sentence type",
     "Shares of simple, compound, and complex sentences (sum to 1).",
     "count(type) / sentence_count", True, "non-additive"),
    ("punctuation_frequency", "Punctuation frequency", "mechanical", "ratio",
     "heavier use of that mark",
     "Per-word rate of each punctuation group (commas, semicolons, dashes).",
     "count(mark) / word_count", True, "non-additive"),
    ("contraction_rate", "Contraction rate", "mechanical", "ratio",
     "more contractions (informal register)",
     "Contractions per word; excludes the possessive 's.",
     "contractions / word_count", False, "non-additive"),
    ("dialogue_narration_ratio", "Dialogue : narration ratio", "structural", "ratio",
     "more dialogue relative to narration",
     "Fraction of words inside double quotes. Higher means more dialogue.",
     "quoted_words / word_count", False, "non-additive"),
    ("adjective_density", "Adjective density", "structural", "ratio",
     "more adjective-heavy description",
     "ADJ-tagged tokens as a fraction of all words.",
     "adjective_count / word_count", False, "non-additive"),
    ("adverb_density", "Adverb density", "structural", "ratio",
     "more adverb-heavy (a weak-prose tell)",
     "ADV-tagged tokens as a fraction of all words.",
     "adverb_count / word_count", False, "non-additive"),
    ("jaccard", "Jaccard vocab overlap vs you", "distinctive", "ratio",
     "more vocabulary overlap with you",
     "Shared-vocabulary fraction between an author and you, over content-word lemmas.",
     "shared_terms / (size_a + size_b - shared_terms)", False, "non-additive"),
)

# Series family prefix -> the concept its children belong to
SERIES_FAMILIES = {
    "funcword_": "function_word_frequency",
    "punct_": "punctuation_frequency",
    "senttype_": "sentence_type_mix",
}
