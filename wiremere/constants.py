"""Values that take part in results: labels, scores, limits and word lists."""

# Signal categories with their display labels.
CATEGORY_LABELS = {
    "Competitor_Strategy": "Competitor Strategy",
    "Broker_Dynamics": "Broker Dynamics",
    "Emerging_Risks": "Emerging Risks",
}
COMPETITOR = "Competitor_Strategy"
BROKER = "Broker_Dynamics"
RISK = "Emerging_Risks"
CATEGORIES = list(CATEGORY_LABELS)

# Sentiment scores; any other sentiment scores 0.0.
SENTIMENT_SCORES = {"POSITIVE": 1.0, "NEGATIVE": -1.0, "NEUTRAL": 0.0, "MIXED": 0.5}
SENTIMENTS = list(SENTIMENT_SCORES)

# Entity type per category; every other category counts as Risk.
ENTITY_TYPES = {"Competitor_Strategy": "Competitor", "Broker_Dynamics": "Broker"}
OTHER_ENTITY_TYPE = "Risk"

# Limits and thresholds. The contract's are applied always, the usual ones only where
# a caller passes them: by default nothing is cut.
MAX_SUMMARY_CHARS = 1000  # contract: a longer summary breaks it
PREVIEW_CHARS = 200
USUAL_ERROR_CHARS = 500
USUAL_TITLE_CHARS = 30
USUAL_INPUT_CHARS = 3072
USUAL_FEED_ENTRIES = 20
USUAL_RESULTS = 200
USUAL_BATCH = 50
USUAL_PAGE = 50
USUAL_LATEST = 10
ACTION_CONFIDENCE = 0.70
DEFAULT_TITLE = "Untitled"

# Labels of the blocks of a model's input.
HEADLINE_LABEL = "HEADLINE: "
URL_LABEL = "SOURCE URL: "
TEXT_LABEL = "ARTICLE TEXT:\n"

# Code points removed at both ends of a text (Unicode white space and the four
# ASCII information separators).
WHITE_SPACE = "".join(
    map(
        chr,
        [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Companies and topics that place a text in a category.
COMPETITOR_NAMES = [
    "Munich Re",
    "Swiss Re",
    "Hannover Re",
    "Gen Re",
    "Berkshire Hathaway Re",
    "Everest Re",
    "RenaissanceRe",
]
BROKER_NAMES = ["Aon", "Marsh", "Gallagher", "Guy Carpenter", "Willis Towers Watson"]
COMPETITOR_TOPICS = [
    "capital actions",
    "M&A",
    "leadership changes",
    "pricing strategy",
    "product launches",
    "financial results",
]
BROKER_TOPICS = ["capacity changes", "client moves", "market structure"]
RISK_TOPICS = [
    "cyber",
    "climate",
    "nat-cat",
    "pandemic",
    "geopolitical",
    "IAIS",
    "Solvency II",
    "ICS",
    "ESG",
    "parametric",
    "ILS",
    "cat bond",
]
LEXICON = {
    COMPETITOR: COMPETITOR_NAMES + COMPETITOR_TOPICS,
    BROKER: BROKER_NAMES + BROKER_TOPICS,
    RISK: RISK_TOPICS,
}

# Words of the offline model's sentiment.
POSITIVE_WORDS = ["growth", "grows", "profit", "record", "upgraded", "acquires", "strong"]
NEGATIVE_WORDS = ["loss", "losses", "damage", "downgraded", "sanction", "revocation", "darker", "weak"]

# Words and amounts of the action rules. Stems match at the start of a word.
DEAL_STEMS = ["acquir", "acquisition", "merg"]
DEAL_USD = 5e8
PERIL_STEMS = ["hurricane", "earthquake", "flood", "wildfire", "pandemic"]
PERIL_USD = 1e9
REGULATORS = ["Lloyd's", "BaFin", "FINMA", "IAIS"]
SANCTION_STEMS = ["sanction", "suspend", "revoke", "revocation", "intervention"]
SANCTION_TARGETS = ["reinsurer", "syndicate"]
EMERGENCY_PHRASES = ["national emergency", "regional emergency"]
DECLARED_STEMS = ["declar"]
DOWNGRADE_WORDS = ["downgrade", "downgraded"]
RATING_AGENCIES = ["Moody's", "S&P", "Fitch", "AM Best"]
SPECULATIVE_WORDS = ["reportedly", "rumoured", "expected", "may", "could"]
