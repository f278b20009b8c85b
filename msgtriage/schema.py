"""Input schemas and fixed values that must equal the reference behaviour."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

#: T1 raw messages (CSV)
MESSAGES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("original", T.StringType()),
        T.StructField("genre", T.StringType()),
    ]
)

#: T2 raw packed labels (CSV)
CATEGORIES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("categories", T.StringType()),
    ]
)


def clean_schema(labels: list[str]) -> T.StructType:
    """``id, message, genre`` followed by one INT column per label."""
    fields = [
        T.StructField("id", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("genre", T.StringType()),
    ]
    fields += [T.StructField(name, T.IntegerType()) for name in labels]
    return T.StructType(fields)


# --------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# --------------------------------------------------------------------------

#: URL pattern removed from messages before tokenising (case-sensitive).
URL_PATTERN = (
    r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
)

#: Base English stop-word list: Spark ML's default English list
#: (``StopWordsRemover.loadDefaultStopWords("english")``), frozen here so the
#: same literal list can be used in SQL and in tests without a JVM.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now i'll you'll he'll "
    "she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's "
    "she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought "
    "that's there's what's when's where's who's why's would"
).split()

#: Extra words appended to the base list, per tokenizer variant.
#: ("thank you" has a space and can never equal a single token.)
EXTRA_STOP_WORDS = {
    "base": [],
    "short": ["one", "see", "please", "thank", "thank you", "thanks"],
    "app": ["one", "see", "please", "thank", "thank you", "thanks",
            "we", "us", "you", "me"],
    "train": ["one", "see", "please", "thank", "thank you", "thanks",
              "we", "us", "you", "me", "their", "there", "here"],
}

#: Keywords taken from label names, searched as tokens (33 entries; four of
#: them contain a space or an underscore and so can never match a token).
LABEL_KEYWORDS = [
    "related", "request", "offer", "aid", "medical", "medical products",
    "search", "rescue", "security", "military", "child_alone", "water", "food",
    "shelter", "clothing", "money", "missing people", "refugee", "death",
    "infrastructure", "transport", "building", "electricity", "tool",
    "hospital", "shop", "aid_centers", "weather", "flood", "storm", "fire",
    "earthquake", "cold",
]

#: Part-of-speech tags counted as verbs / nouns, and the starting-verb tags.
VERB_TAGS = ["VB", "VBN", "VBD", "VBP", "VBZ", "VBG"]
NOUN_TAGS = ["NNP", "NN"]
STARTING_VERB_TAGS = ["VB", "VBP"]

#: Named-entity types reported as presence flags, in output order.
ENTITY_TYPES = ["GPE", "PERSON", "ORGANIZATION"]


def contraction_pieces() -> list[str]:
    """Letter runs of the listed contractions (``didn't`` -> ``didn``, ``t``): what is left of
    them once punctuation is removed, so what a letters-only token can equal."""
    return [piece for word in ENGLISH_STOP_WORDS if "'" in word for piece in word.split("'")]


def stop_words(variant: str = "train") -> list[str]:
    """Base list, the pieces of its contractions, the variant's extra words; no repeats."""
    seen: dict[str, None] = {}
    for word in ENGLISH_STOP_WORDS + contraction_pieces() + EXTRA_STOP_WORDS[variant]:
        seen.setdefault(word, None)
    return list(seen)
